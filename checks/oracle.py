"""SQL for the oracle: the source tables as CTEs, and one separate query per cohort and measure.

The engine counts everything in one pass; these statements do it window by window, so equal
results show that the one-pass form is right.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

EARLY_CUTOFF, SCHEME_CUTOFF = date(1995, 7, 1), date(2000, 1, 1)
AS_OF, SEED = date(2001, 7, 1), 42
MAP_SIZE = 514


@dataclass(frozen=True)
class Window:
    label: str
    prev_start: date
    start: date
    end: date
    target_end: date | None
    open_date: date


def training_window(label: str, prev_start: date, start: date, end: date) -> Window:
    return Window(label, prev_start, start, end, end, start)


# The windows, 22 years before those of the library.
COHORTS = (
    training_window("1997", date(1995, 4, 1), date(1996, 4, 1), date(1997, 4, 1)),
    training_window("1998", date(1996, 4, 1), date(1997, 4, 1), date(1998, 4, 1)),
    training_window("2000", date(1998, 1, 1), date(1999, 1, 1), date(2000, 1, 1)),
)
FIRST, LAST = COHORTS[0], COHORTS[-1]
YEAR_BEFORE, TWO_BEFORE = AS_OF - timedelta(days=365), AS_OF - timedelta(days=730)
AS_OF_START = Window("2001", TWO_BEFORE, YEAR_BEFORE, AS_OF, None, YEAR_BEFORE)
AS_OF_COHORT = Window("2001", TWO_BEFORE, YEAR_BEFORE, AS_OF, None, AS_OF)

STRATA = [
    (date(year, 1, 1), date(year + 1, 1, 1), levy) for year in range(1995, 2001) for levy in (1, 0)
]

# Fixed values, stated here too so that a wrong one in the library shows.
OCCUPATION_CODES = ("1", "2", "3", "7", "13", "14", "15", "17", "20", "22", "24")
SCHEME_YEARS = {
    (0, "C"): 1990, (0, "F"): 1986, (0, "I"): 1990, (0, "L"): 1985, (0, "P"): 1986,
    (1, "C"): 1982, (1, "E"): 1986, (1, "F"): 1987, (1, "I"): 1979, (1, "L"): 1988,
    (1, "P"): 1977, (1, "S"): 1981,
}
SCHEME_YEARS_ELSE = {0: 1989, 1: 1982}
EMPLOYEES = {
    (0, "C"): 16, (0, "F"): 25, (0, "I"): 8, (0, "L"): 34, (0, "P"): 28.5, (0, "S"): 33,
    (1, "C"): 189, (1, "E"): 259.5, (1, "F"): 156, (1, "I"): 153, (1, "L"): 261,
    (1, "P"): 683, (1, "S"): 579,
}
EMPLOYEES_ELSE = {0: 16, 1: 200}
BANDS = (
    (3, "A"), (9, "B"), (33, "C"), (35, "D"), (39, "E"), (43, "F"), (47, "G"), (53, "H"),
    (56, "I"), (63, "J"), (66, "K"), (68, "L"), (75, "M"), (82, "N"), (84, "O"), (85, "P"),
    (88, "Q"), (93, "R"), (95, "S"), (98, "T"), (99, "U"),
)
UPLIFT = {
    "1999-2": 1.09, "1999-3": 1.21, "1999-4": 1.34, "1999-5": 1.51, "1999-6": 1.71,
    "1999-7": 1.98, "1999-8": 2.36, "1999-9": 2.89, "1999-10": 3.85, "1999-11": 5.81,
    "1999-12": 11.78,
}

SOURCES = f"""
pt_a AS (
  SELECT CASE WHEN c_nationkey % 3 = 0 THEN 0 ELSE 1 END AS a1,
         CAST(DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INT) AS TIMESTAMP) AS a2,
         c_custkey AS a3,
         CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS a7
  FROM customer),
pt_b AS (
  SELECT o.o_custkey AS b10, o.o_orderdate AS b2,
         CASE WHEN p.p_size <= 45 THEN CAST(p.p_size AS VARCHAR) END AS b6,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS b12,
         CASE WHEN o.o_orderstatus = 'P' THEN
           CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 300 AS INT) AS TIMESTAMP) END AS b16,
         CAST(CAST(o.o_orderdate AS DATE) + 365 AS TIMESTAMP) AS b17,
         CASE WHEN o.o_orderstatus = 'F' THEN
           CAST(CAST(o.o_orderdate AS DATE) + CAST(365 + o.o_orderkey % 60 AS INT) AS TIMESTAMP) END AS b20
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey),
pt_d AS (
  SELECT c_name AS d3,
         CASE WHEN c_custkey % 11 <> 0 THEN
           CAST(DATE '1975-01-01' + CAST((c_custkey * 53) % 7000 AS INT) AS TIMESTAMP) END AS d6,
         1 + c_nationkey % 4 AS d8,
         CASE WHEN c_custkey % 5 <> 0 THEN CAST(FLOOR(ABS(c_acctbal) * 3) AS INT) END AS d10,
         ['Company','Friendly','Individual','LLP','Partnership','Sole','Exempt'][1 + c_nationkey % 8] AS d12,
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              WHEN c_custkey % 19 = 0 THEN CAST(-1 AS BIGINT)
              ELSE c_custkey - c_custkey % 2 END AS d15
  FROM customer),
sic_map AS (
  SELECT CAST(r.range AS INT) AS idx,
         lpad(CAST(111 + r.range * 19 AS VARCHAR), 4, '0') AS old_code,
         lpad(CAST(1000 * (1 + (r.range * 193) % 99) + 10 * (r.range % 5) AS VARCHAR), 5, '0') AS new_code
  FROM range({MAP_SIZE}) r),
pt_i AS (
  SELECT c_name AS i1,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_custkey % 3 = 0 THEN m.new_code || ' Trade in ' || c_mktsegment
              ELSE m.old_code || ' Trade in ' || c_mktsegment END AS i4
  FROM customer JOIN sic_map m ON m.idx = c_custkey % {MAP_SIZE})"""


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SOURCES, *ctes]) + "\n" + body


def day(d: date) -> str:
    return f"DATE '{d.isoformat()}'"


def in_days(col: str, start: date, end: date | None) -> str:
    test = f"CAST({col} AS DATE) >= {day(start)}"
    return test if end is None else f"{test} AND CAST({col} AS DATE) < {day(end)}"


def still_open(d: date) -> str:
    return " AND ".join(f"(CAST({c} AS DATE) >= {day(d)} OR {c} IS NULL)" for c in ("b20", "b16"))


def in_target(c: Window) -> str:
    return in_days("b2", c.start, c.target_end)


def in_lookback(c: Window) -> str:
    return in_days("b2", c.prev_start, c.start)


def ending(c: Window) -> str:
    return f"{in_days('b17', c.start, c.end)} AND {still_open(c.start)}"


def live(c: Window) -> str:
    return f"CAST(b2 AS DATE) < {day(c.start)} AND {still_open(c.open_date)}"


def counted(where: str, name: str, source: str = "pt_b") -> str:
    return f"SELECT b10, COUNT(*) AS {name} FROM {source} WHERE {where} GROUP BY b10"


def share_of(test: str, name: str) -> str:
    ratio = f"SUM(CASE WHEN {test} THEN 1.000 ELSE 0 END) / COUNT(*)"
    return f"CAST(CAST({ratio} AS DECIMAL(10,3)) AS DOUBLE) AS {name}"


def share_list(null_test: str = "b6 IS NULL") -> str:
    shares = [share_of(f"b6 = '{code}'", f"occupation_{code}") for code in OCCUPATION_CODES]
    return ", ".join([*shares, share_of(null_test, "occupation_null")])


SHARES = [f"occupation_{code}" for code in (*OCCUPATION_CODES, "null")]


def lookback(c: Window, null_test: str = "b6 IS NULL") -> str:
    return (
        "SELECT b10, COUNT(*) AS prev_12m_new_commitments,"
        " CAST(SUM(CASE WHEN b12 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS prev_12m_new_levy_transfers,"
        f" {share_list(null_test)} FROM pt_b WHERE {in_lookback(c)} GROUP BY b10"
    )


def part_one(c: Window) -> str:
    """Levy accounts created before the window, with target and look-back."""
    return (
        f"SELECT a.a3, '{c.label}' AS cohort, t.total_commitments, "
        + ", ".join(f"p.{s}" for s in SHARES)
        + ", p.prev_12m_new_commitments, p.prev_12m_new_levy_transfers,"
        " a.a7 AS levy_sending_company"
        f" FROM (SELECT a3, a7 FROM pt_a WHERE a1 = 1 AND CAST(a2 AS DATE) < {day(c.start)}) a"
        f" LEFT JOIN ({counted(in_target(c), 'total_commitments')}) t ON a.a3 = t.b10"
        f" LEFT JOIN ({lookback(c)}) p ON a.a3 = p.b10"
    )


def part_two(c: Window) -> str:
    """The same accounts with commitments ending and live."""
    return (
        "SELECT a.a3, e.commitments_ending_12m, l.current_live_commitments"
        f" FROM (SELECT a3 FROM pt_a WHERE a1 = 1 AND CAST(a2 AS DATE) < {day(c.start)}) a"
        f" LEFT JOIN ({counted(ending(c), 'commitments_ending_12m')}) e ON a.a3 = e.b10"
        f" LEFT JOIN ({counted(live(c), 'current_live_commitments')}) l ON a.a3 = l.b10"
    )


COUNTS = [
    "total_commitments",
    "prev_12m_new_commitments",
    "prev_12m_new_levy_transfers",
    "commitments_ending_12m",
    "current_live_commitments",
    "levy_sending_company",
]


def zeroed(columns: list[str], alias: str) -> str:
    return ", ".join(f"COALESCE({alias}.{c}, 0) AS {c}" for c in columns)


def both_parts(c: Window) -> str:
    return (
        "SELECT x.*, y.commitments_ending_12m, y.current_live_commitments"
        f" FROM ({part_one(c)}) x LEFT JOIN ({part_two(c)}) y ON x.a3 = y.a3"
    )


def months(anchor: date, created: str = "a2") -> str:
    return f"(epoch(TIMESTAMP '{anchor} 00:00:00') - epoch({created})) / 2629746.0"


MEMBERS = "members AS (" + " UNION ALL ".join(
    f"SELECT a1, a2, a3, '{c.label}' AS cohort, {months(c.end)} AS months_since_sign_up"
    f" FROM pt_a WHERE CAST(a2 AS DATE) < {day(c.end)}"
    for c in COHORTS
) + ")"

# Accounts of any sampling stratum, the whole population of the training frame.
IN_STRATA = " OR ".join(
    f"(a2 BETWEEN TIMESTAMP '{low} 00:00:00' AND TIMESTAMP '{high} 00:00:00' AND a1 = {levy})"
    for low, high, levy in STRATA
)

FEATURES = "features AS (" + " UNION ALL ".join(both_parts(c) for c in COHORTS) + ")"
AS_OF_FEATURES = f"as_of_features AS ({both_parts(AS_OF_COHORT)})"


def case_rule(value: str, known: dict, otherwise: dict) -> str:
    by_type = "".join(
        f" WHEN a1 = {flag} AND company_type = '{letter}' THEN {number}"
        for (flag, letter), number in known.items()
    )
    by_flag = "".join(f" WHEN a1 = {flag} THEN {number}" for flag, number in otherwise.items())
    return f"CASE WHEN {value} IS NOT NULL THEN {value}{by_type}{by_flag} ELSE NULL END"


PROFILE = f"""scheme_profile AS (
  SELECT a3, a1, MAX(d10) AS employees, MIN(YEAR(d6)) AS scheme_start_year,
         MAX(SUBSTRING(d12, 1, 1)) AS company_type, MAX(d8) AS company_status
  FROM (SELECT a3, a1 FROM pt_a WHERE CAST(a2 AS DATE) < {day(SCHEME_CUTOFF)}) a
  LEFT JOIN pt_d ON a3 = d15
  GROUP BY a3, a1)"""

TPR = f"""tpr AS (
  SELECT a3, CASE WHEN employees IS NULL THEN 0 ELSE 1 END AS tpr_match,
         CAST({case_rule('scheme_start_year', SCHEME_YEARS, SCHEME_YEARS_ELSE)} AS INT) AS scheme_start_year,
         CAST({case_rule('employees', EMPLOYEES, EMPLOYEES_ELSE)} AS DOUBLE) AS employees,
         COALESCE(company_type, 'X') AS company_type, company_status
  FROM scheme_profile)"""

OWNER = """company_owner AS (
  SELECT d3, MAX(d15) AS d15 FROM pt_d WHERE d15 IS NOT NULL AND d15 > -1 GROUP BY d3)"""


def token(col: str) -> str:
    return f"SUBSTRING({col}, 1, INSTR({col}, ' ') - 1)"


CODE = f"""account_code AS (
  SELECT d15, MAX({token('i4')}) AS sic_code
  FROM company_owner JOIN pt_i ON d3 = i1 GROUP BY d15)"""


def section(division: str) -> str:
    chain = "".join(
        f" WHEN TRY_CAST({division} AS INT) <= {upper} THEN '{letter}'"
        for upper, letter in BANDS
    )
    return f"CASE{chain} ELSE 'Z' END"


SIC = f"""sic AS (
  SELECT d15, new_sic_code, SUBSTRING(new_sic_code, 1, 2) AS sic_division,
         {section('SUBSTRING(new_sic_code, 1, 2)')} AS sic_section
  FROM (SELECT d15, COALESCE(new_code, sic_code) AS new_sic_code
        FROM account_code LEFT JOIN sic_map ON sic_code = old_code))"""

SCHEME_CTES = (PROFILE, TPR)
INDUSTRY_CTES = (OWNER, CODE, SIC)


def ranked_hash(seed: int, key: str = "a3") -> str:
    return f"md5('{seed}-' || {key})"


def in_test(seed: int, key: str, percent: int = 25) -> str:
    head = f"CAST('0x' || SUBSTRING(md5('{seed}-' || {key}), 1, 8) AS BIGINT)"
    return f"{head} % 10000 < {percent * 100}"


def stratified(n: int, seed: int, columns: str) -> str:
    """First n of every stratum by seeded hash, stratum by stratum, accounts once."""
    return " UNION ".join(
        f"SELECT {columns} FROM (SELECT * FROM pt_a WHERE a1 = {levy}"
        f" AND a2 BETWEEN TIMESTAMP '{low} 00:00:00' AND TIMESTAMP '{high} 00:00:00'"
        f" ORDER BY {ranked_hash(seed)}, a3 LIMIT {n})"
        for low, high, levy in STRATA
    )


# The training frame before one-hot columns: every stratum's accounts, all eligible rows.
TRAINING_NUMERIC = f"""training AS (
  SELECT m.a3 AS account_id, m.cohort, m.a1 AS levy_non_levy,
         CASE WHEN CAST(m.a2 AS DATE) < {day(EARLY_CUTOFF)} THEN 1 ELSE 0 END AS early_adopter,
         CAST(FLOOR(months_since_sign_up) AS INT) AS as_months_since_sign_up,
         {zeroed(SHARES, 'f')}, {zeroed(COUNTS, 'f')},
         t.company_type, t.company_status, t.employees, t.tpr_match, t.scheme_start_year,
         CAST(m.cohort AS INT) - t.scheme_start_year AS years_since_tpr_signup,
         CASE WHEN FLOOR(months_since_sign_up) <= 6 THEN 1 ELSE 0 END AS new_company,
         ROUND(LOG2(t.employees + 1), 9) AS log_employees,
         ROUND(LN(COALESCE(f.total_commitments, 0) + 1), 9) AS log_adjusted_commitments
  FROM members m
  LEFT JOIN features f ON m.a3 = f.a3 AND m.cohort = f.cohort
  LEFT JOIN tpr t ON m.a3 = t.a3
  WHERE {IN_STRATA.replace('a2', 'm.a2').replace('a1', 'm.a1')})"""

TRAINING_CTES = (MEMBERS, FEATURES, *SCHEME_CTES, TRAINING_NUMERIC)
