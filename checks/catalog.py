"""Registered queries, each next to the SQL that must give the same rows.

Every query runs over whole tables. Doubles are rounded to 9 digits and decimal shares cast to
double on both sides, so that values compare by equality.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as DT

from checks import oracle as O
from checks import tables as T
from checks.refit import refit
from cohortloom.cohorts import Cohort
from cohortloom.functions import predicates as P
from cohortloom.functions import scalars as S
from cohortloom.operators import accounts as A
from cohortloom.operators import commitments as C
from cohortloom.operators import contributions as X
from cohortloom.operators import encoding as E
from cohortloom.operators import industry as I
from cohortloom.operators import learning as L
from cohortloom.operators import sampling as M
from cohortloom.operators import schemes as H
from cohortloom.operators import sweep as W
from cohortloom.plans import features as PF
from cohortloom.plans import scoring as PS
from cohortloom.plans import training as PT
from cohortloom.session import cut_lineage, shared_dir
from cohortloom.sources import (
    load_model,
    model_versions,
    read_bucketed,
    store_bucketed,
    write_day,
    write_predictions,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

FIRST, LAST = T.COHORTS[0], T.COHORTS[-1]
MEASURES = [*O.SHARES, *O.COUNTS]
TYPES = ["C", "E", "F", "I", "L", "P", "S", "X"]
DIVISIONS = [f"{number:02d}" for number in range(1, 100)]
# New codes of the map the checks use (see T.code_pairs).
CODES = sorted({f"{1000 * (1 + i * 193 % 99) + 10 * (i % 5):05d}" for i in range(T.MAP_SIZE)})
SECTIONS = [letter for _, letter in O.BANDS] + ["Z"]
SAMPLE_N, SAMPLE_LARGE, SCORE_N = 2, 200, 7


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and doubles at 9 digits, for comparison."""

    def cell(field: DT.StructField) -> str:
        if isinstance(field.dataType, DT.DecimalType):
            return f"CAST(`{field.name}` AS DOUBLE) AS `{field.name}`"
        if isinstance(field.dataType, DT.DoubleType):
            return f"round(`{field.name}`, 9) AS `{field.name}`"
        return f"`{field.name}`"

    return df.selectExpr(*[cell(f) for f in df.schema])


def settings(spark: SparkSession, industry: bool = False, null_share: str = "is_null"):
    return PF.FeatureSettings(
        early_cutoff=T.EARLY_CUTOFF,
        scheme_cutoff=T.SCHEME_CUTOFF,
        rules=T.RULES,
        code_map=T.code_pairs(spark) if industry else None,
        null_share=null_share,
    )


def scratch(spark: SparkSession) -> str:
    """A new folder name in the cluster's shared folder; a local one only on a local master."""
    root = shared_dir(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"


# --- sources ---------------------------------------------------------------------------------


@query("src_accounts", O.sql("SELECT a1, a2, a3, a7 FROM pt_a"))
def src_accounts(spark, sf):
    return T.accounts(spark, sf)


@query("src_commitments", O.sql("SELECT b2, b6, b10, b12, b16, b17, b20 FROM pt_b"))
def src_commitments(spark, sf):
    return T.commitments(spark, sf)


@query("src_schemes", O.sql("SELECT d3, d6, d8, d10, d12, d15 FROM pt_d"))
def src_schemes(spark, sf):
    return T.schemes(spark, sf)


@query("src_register", O.sql("SELECT i1, i4 FROM pt_i"))
def src_register(spark, sf):
    return T.register(spark, sf)


# --- projections and scalar functions --------------------------------------------------------


@query(
    "early_adopter",
    O.sql(
        f"SELECT a3, CASE WHEN CAST(a2 AS DATE) < {O.day(O.EARLY_CUTOFF)} THEN 1 ELSE 0 END"
        " AS early_adopter FROM pt_a"
    ),
)
def early_adopter(spark, sf):
    return A.early_adopter(T.accounts(spark, sf), T.EARLY_CUTOFF).select("a3", "early_adopter")


@query(
    "created_yearmon",
    O.sql("SELECT a3, CONCAT(YEAR(a2), '-', MONTH(a2)) AS yearmon_created FROM pt_a"),
)
def created_yearmon(spark, sf):
    return T.accounts(spark, sf).selectExpr("a3", f"{S.yearmon('a2')} AS yearmon_created")


@query(
    "cohort_literal",
    O.sql("SELECT cohort, COUNT(*) AS accounts FROM members GROUP BY cohort", O.MEMBERS),
)
def cohort_literal(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS)
    return grown.groupBy("cohort").agg(F.count("*").alias("accounts"))


@query(
    "months_since_signup",
    O.sql(
        "SELECT a3, cohort, ROUND(months_since_sign_up, 9) AS months_since_sign_up FROM members",
        O.MEMBERS,
    ),
)
def months_since_signup(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS)
    return plain(grown.select("a3", "cohort", "months_since_sign_up"))


@query(
    "months_floor",
    O.sql(
        "SELECT a3, cohort, CAST(FLOOR(months_since_sign_up) AS INT) AS months_since_sign_up2"
        " FROM members",
        O.MEMBERS,
    ),
)
def months_floor(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS)
    return grown.select("a3", "cohort", "months_since_sign_up2")


@query(
    "new_company",
    O.sql(
        "SELECT a3, cohort, CASE WHEN FLOOR(months_since_sign_up) <= 6 THEN 1 ELSE 0 END"
        " AS new_company FROM members",
        O.MEMBERS,
    ),
)
def new_company(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS)
    return A.new_company(grown).select("a3", "cohort", "new_company")


def scheme_features_of(spark, sf, accounts=None):
    accounts = T.accounts(spark, sf) if accounts is None else accounts
    return H.scheme_features(accounts, T.schemes(spark, sf), T.RULES, T.SCHEME_CUTOFF)


@query(
    "years_since_scheme",
    O.sql(
        "SELECT m.a3, m.cohort, CAST(m.cohort AS INT) - scheme_start_year AS years_train,"
        f" {O.AS_OF.year} - scheme_start_year AS years_score"
        " FROM members m LEFT JOIN tpr ON m.a3 = tpr.a3",
        O.MEMBERS,
        *O.SCHEME_CTES,
    ),
)
def years_since_scheme(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS)
    return A.attach(grown, scheme_features_of(spark, sf), on="a3").selectExpr(
        "a3",
        "cohort",
        f"{S.years_since('CAST(cohort AS INT)', 'scheme_start_year')} AS years_train",
        f"{S.years_since(T.AS_OF.year, 'scheme_start_year')} AS years_score",
    )


@query(
    "log_employees",
    O.sql(
        "SELECT a3, ROUND(LOG2(employees + 1), 9) AS log_employees FROM tpr", *O.SCHEME_CTES
    ),
)
def log_employees(spark, sf):
    features = scheme_features_of(spark, sf)
    return plain(features.selectExpr("a3", f"{S.log2p1('employees')} AS log_employees"))


TARGETS = " UNION ALL ".join(
    f"SELECT b10, '{c.label}' AS cohort, total_commitments"
    f" FROM ({O.counted(O.in_target(c), 'total_commitments')})"
    for c in O.COHORTS
)


@query(
    "log_target",
    O.sql(
        "SELECT b10, cohort, ROUND(LN(total_commitments + 1), 9) AS log_adjusted_commitments"
        f" FROM ({TARGETS})"
    ),
)
def log_target(spark, sf):
    counts = target_counts(spark, sf)
    log = S.log_target("total_commitments")
    return plain(counts.selectExpr("b10", "cohort", f"{log} AS log_adjusted_commitments"))


def target_counts(spark, sf):
    return C.count_in_window(
        T.commitments(spark, sf), T.COHORTS, "start", "target_end", name="total_commitments"
    )


@query(
    "inverse_target",
    O.sql(
        "SELECT b10, cohort, ROUND(EXP(p) - 1, 6) AS natural, ROUND(POW(2, p) - 1, 6) AS base_two"
        f" FROM (SELECT b10, cohort, LN(total_commitments + 1) AS p FROM ({TARGETS}))"
    ),
)
def inverse_target(spark, sf):
    p = S.log_target("total_commitments")
    return target_counts(spark, sf).selectExpr(
        "b10",
        "cohort",
        f"round({S.inverse_target(p)}, 6) AS natural",
        f"round({S.inverse_target(p, 2)}, 6) AS base_two",
    )


@query(
    "type_letter",
    O.sql("SELECT d3, UPPER(SUBSTRING(LOWER(d12), 1, 1)) AS type_letter FROM pt_d"),
)
def type_letter(spark, sf):
    """From types in lower case."""
    letter = S.type_letter("lower(d12)")
    return T.schemes(spark, sf).selectExpr("d3", f"{letter} AS type_letter")


@query(
    "type_default",
    O.sql("SELECT a3, COALESCE(company_type, 'X') AS company_type FROM scheme_profile", O.PROFILE),
)
def type_default(spark, sf):
    return scheme_features_of(spark, sf).select("a3", "company_type")


@query("code_token", O.sql(f"SELECT i1, {O.token('i4')} AS sic_code FROM pt_i"))
def code_token(spark, sf):
    return T.register(spark, sf).selectExpr("i1", f"{S.leading_token('i4')} AS sic_code")


def codes_of(spark, sf):
    return I.account_code(I.company_owner(T.schemes(spark, sf)), T.register(spark, sf))


@query(
    "industry_recode",
    O.sql(
        "SELECT d15, sic_code, COALESCE(new_code, sic_code) AS new_sic_code"
        " FROM account_code LEFT JOIN sic_map ON sic_code = old_code",
        O.OWNER,
        O.CODE,
    ),
)
def industry_recode(spark, sf):
    return I.recode(codes_of(spark, sf), T.code_pairs(spark))


def industry_of(spark, sf):
    return I.industry_features(
        T.schemes(spark, sf), T.register(spark, sf), T.code_pairs(spark), T.RULES.bands
    )


@query("industry_division", O.sql("SELECT d15, sic_division FROM sic", *O.INDUSTRY_CTES))
def industry_division(spark, sf):
    return industry_of(spark, sf).select("d15", "sic_division")


@query(
    "industry_section",
    O.sql("SELECT d15, sic_division, sic_section FROM sic", *O.INDUSTRY_CTES),
)
def industry_section(spark, sf):
    return industry_of(spark, sf).select("d15", "sic_division", "sic_section")


@query(
    "impute_scheme_year", O.sql("SELECT a3, scheme_start_year FROM tpr", *O.SCHEME_CTES)
)
def impute_scheme_year(spark, sf):
    return scheme_features_of(spark, sf).select("a3", "scheme_start_year")


@query("impute_employees", O.sql("SELECT a3, employees FROM tpr", *O.SCHEME_CTES))
def impute_employees(spark, sf):
    return scheme_features_of(spark, sf).select("a3", "employees")


@query("scheme_match", O.sql("SELECT a3, tpr_match FROM tpr", *O.SCHEME_CTES))
def scheme_match(spark, sf):
    return scheme_features_of(spark, sf).select("a3", "tpr_match")


UPLIFT_CASE = "".join(
    f" WHEN ym = '{month}' THEN total_commitments * {factor}"
    for month, factor in O.UPLIFT.items()
)


@query(
    "maturity_uplift",
    O.sql(
        "SELECT a3, total_commitments,"
        f" ROUND(CAST(CASE{UPLIFT_CASE} ELSE total_commitments END AS DOUBLE), 6)"
        " AS adjusted_commitments FROM"
        " (SELECT a.a3, t.total_commitments, CONCAT(YEAR(a2), '-', MONTH(a2)) AS ym FROM pt_a a"
        f" LEFT JOIN ({O.counted(O.in_target(O.AS_OF_COHORT), 'total_commitments')}) t"
        " ON a.a3 = t.b10"
        f" WHERE a1 = 1 AND CAST(a2 AS DATE) < {O.day(O.AS_OF_COHORT.start)})"
    ),
)
def maturity_uplift(spark, sf):
    """Every levy account created before the window; without commitments both are NULL."""
    counts = C.count_in_window(
        T.commitments(spark, sf),
        [T.AS_OF_COHORT],
        "start",
        "target_end",
        name="total_commitments",
    )
    accounts = A.created_before(A.levy_only(T.accounts(spark, sf)), T.AS_OF_COHORT.start)
    joined = A.attach(accounts, counts, left="a3", right="b10")
    return C.uplift(joined, T.RULES.uplift).select(
        "a3", "total_commitments", F.round("adjusted_commitments", 6).alias("adjusted_commitments")
    )


@query(
    "sending_flag",
    O.sql("SELECT a3, a7 AS levy_sending_company FROM pt_a WHERE a1 = 1"),
)
def sending_flag(spark, sf):
    accounts = A.levy_only(T.accounts(spark, sf))
    return accounts.select("a3", F.col("a7").alias("levy_sending_company"))


@query(
    "rename_features",
    O.sql(
        "SELECT a3 AS account_id, a1 AS levy_non_levy, cohort,"
        " CAST(FLOOR(months_since_sign_up) AS INT) AS as_months_since_sign_up FROM members",
        O.MEMBERS,
    ),
)
def rename_features(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS)
    return A.rename_features(grown).select(
        "account_id", "levy_non_levy", "cohort", "as_months_since_sign_up"
    )


@query(
    "drop_columns",
    O.sql(
        "SELECT a1, m.a3, m.cohort, CAST(FLOOR(months_since_sign_up) AS INT)"
        " AS months_since_sign_up2 FROM members m LEFT JOIN tpr ON m.a3 = tpr.a3",
        O.MEMBERS,
        *O.SCHEME_CTES,
    ),
)
def drop_columns(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS).drop("a7")
    return A.drop_columns(A.attach(grown, scheme_features_of(spark, sf), on="a3"))


# --- filters and predicates ------------------------------------------------------------------


@query(
    "created_before",
    O.sql(f"SELECT a3, a2 FROM pt_a WHERE a2 < TIMESTAMP '{O.FIRST.start} 00:00:00'"),
)
def created_before(spark, sf):
    return A.created_before(T.accounts(spark, sf), FIRST.start).select("a3", "a2")


@query("levy_only", O.sql("SELECT a3, a1 FROM pt_a WHERE a1 = 1"))
def levy_only(spark, sf):
    return A.levy_only(T.accounts(spark, sf)).select("a3", "a1")


@query(
    "between_incl",
    O.sql(
        "SELECT a3, a2 FROM pt_a WHERE a2 BETWEEN TIMESTAMP '1996-01-01 00:00:00'"
        " AND TIMESTAMP '1997-01-01 00:00:00'"
    ),
)
def between_incl(spark, sf):
    inside = P.between_incl("a2", date(1996, 1, 1), date(1997, 1, 1))
    return T.accounts(spark, sf).where(inside).select("a3", "a2")


@query("half_open_window", O.sql(f"SELECT b10, b2 FROM pt_b WHERE {O.in_lookback(O.FIRST)}"))
def half_open_window(spark, sf):
    inside = P.in_window("b2", FIRST.prev_start, FIRST.start)
    return T.commitments(spark, sf).where(inside).select("b10", "b2")


@query(
    "open_at",
    O.sql(f"SELECT b10, b2, b16, b20 FROM pt_b WHERE {O.still_open(O.LAST.start)}"),
)
def open_at(spark, sf):
    kept = P.open_at(LAST.start, "b16", "b20")
    return T.commitments(spark, sf).where(kept).select("b10", "b2", "b16", "b20")


@query(
    "rolling_window",
    O.sql(
        f"SELECT b10, COUNT(*) AS commitments FROM pt_b WHERE CAST(b2 AS DATE) >="
        f" {O.day(O.AS_OF)} - 730 AND CAST(b2 AS DATE) < {O.day(O.AS_OF)} - 365 GROUP BY b10"
    ),
)
def rolling_window(spark, sf):
    counts = C.count_in_window(T.commitments(spark, sf), [T.AS_OF_COHORT], "prev_start", "start")
    return counts.select("b10", "commitments")


def sampled(spark, sf, n=SAMPLE_N):
    return M.sample_stratified(T.accounts(spark, sf), T.STRATA, n, T.SEED)


SAMPLE_IDS = f"ids AS ({O.stratified(SAMPLE_N, O.SEED, 'a3')})"


@query(
    "account_set",
    O.sql("SELECT b10, b2, b6, b12 FROM pt_b WHERE b10 IN (SELECT a3 FROM ids)", SAMPLE_IDS),
)
def account_set(spark, sf):
    ids = sampled(spark, sf).select("a3")
    rows = A.restrict(T.commitments(spark, sf), ids, "b10")
    return rows.select("b10", "b2", "b6", "b12")


@query("sentinel_filter", O.sql("SELECT d3, d15 FROM pt_d WHERE d15 IS NOT NULL AND d15 > -1"))
def sentinel_filter(spark, sf):
    return I.valid_owner(T.schemes(spark, sf)).select("d3", "d15")


@query(
    "eligible",
    O.sql(
        "SELECT a3, employees, CASE WHEN company_status = 3 THEN 1 ELSE 0 END AS with_industry"
        " FROM tpr WHERE employees <= 20000 AND tpr_match = 1",
        *O.SCHEME_CTES,
    ),
)
def eligible(spark, sf):
    """Both forms: eligible rows, flagged where the industry path would keep them too."""
    kept = A.eligible(scheme_features_of(spark, sf)).select("a3", "employees", "company_status")
    strict = F.col("company_status").eqNullSafe(PT.ELIGIBLE_STATUS)
    return kept.select("a3", "employees", strict.cast("int").alias("with_industry"))


LOOKBACK_FILLED = " UNION ALL ".join(
    f"SELECT a.a3, '{c.label}' AS cohort,"
    " COALESCE(p.prev_12m_new_commitments, 0) AS prev_12m_new_commitments,"
    f" {O.zeroed(O.SHARES, 'p')} FROM pt_a a LEFT JOIN ({O.lookback(c)}) p ON a.a3 = p.b10"
    for c in O.COHORTS
)


@query("fill_zero", O.sql(LOOKBACK_FILLED))
def fill_zero(spark, sf):
    """Look-back counts and shares of every account and cohort, 0 where there are none."""
    columns = ["prev_12m_new_commitments", *O.SHARES]
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS, members_only=False)
    features = C.commitment_features(T.commitments(spark, sf), T.COHORTS)
    found = features.where(F.col("prev_12m_new_commitments") > 0).select("a3", "cohort", *columns)
    joined = A.attach(grown.select("a3", "cohort"), found, on=["a3", "cohort"])
    return plain(A.fill_zero(joined, columns))


@query(
    "drop_missing",
    O.sql(
        "SELECT * FROM pt_d WHERE d3 IS NOT NULL AND d6 IS NOT NULL AND d8 IS NOT NULL"
        " AND d10 IS NOT NULL AND d12 IS NOT NULL AND d15 IS NOT NULL"
    ),
)
def drop_missing(spark, sf):
    return A.drop_missing(T.schemes(spark, sf))


# --- joins -----------------------------------------------------------------------------------


@query(
    "join_accounts_aggs",
    O.sql(" UNION ALL ".join(O.both_parts(c) for c in O.COHORTS)),
)
def join_accounts_aggs(spark, sf):
    """Aggregates joined as they are: NULL where an account has no row in the window."""
    return plain(PF.raw_features(T.accounts(spark, sf), T.commitments(spark, sf), T.COHORTS))


JOINED_PARTS = " UNION ALL ".join(
    "SELECT a3, cohort, COALESCE(total_commitments, 0) AS total_commitments,"
    " COALESCE(commitments_ending_12m, 0) AS commitments_ending_12m,"
    " COALESCE(current_live_commitments, 0) AS current_live_commitments"
    f" FROM ({O.both_parts(c)})"
    for c in O.COHORTS
)
CREATED_IN_TIME = P.any_of(
    f"(cohort = {S.text(c.label)} AND {P.before('a2', c.start)})" for c in T.COHORTS
)


@query("join_parts", O.sql(JOINED_PARTS))
def join_parts(spark, sf):
    """Both parts of one aggregation, left joined to the accounts of each cohort."""
    parts = ["total_commitments", "commitments_ending_12m", "current_live_commitments"]
    grown = A.expand_cohorts(A.levy_only(T.accounts(spark, sf)), T.COHORTS)
    accounts = grown.where(CREATED_IN_TIME).select("a3", "cohort")
    features = C.commitment_features(T.commitments(spark, sf), T.COHORTS)
    joined = A.attach(accounts, features.select("a3", "cohort", *parts), on=["a3", "cohort"])
    return A.fill_zero(joined, parts)


ALL_MEASURES_ORACLE = (
    f"SELECT m.a3, m.cohort, {O.zeroed(MEASURES, 'f')}"
    " FROM members m LEFT JOIN features f ON m.a3 = f.a3 AND m.cohort = f.cohort"
)


@query("join_cohort_features", O.sql(ALL_MEASURES_ORACLE, O.MEMBERS, O.FEATURES))
def join_cohort_features(spark, sf):
    """Accounts by cohort left joined to features on both keys."""
    accounts = T.accounts(spark, sf)
    grown = A.expand_cohorts(accounts, T.COHORTS)
    features = C.commitment_features(T.commitments(spark, sf), T.COHORTS)
    sent = A.stack(
        [
            A.created_before(A.levy_only(accounts), c.start).select(
                "a3",
                F.lit(c.label).alias("cohort"),
                F.col("a7").alias("levy_sending_company"),
            )
            for c in T.COHORTS
        ]
    )
    known = A.attach(sent, features, on=["a3", "cohort"])
    joined = A.attach(grown.select("a3", "cohort"), known, on=["a3", "cohort"])
    return plain(A.fill_zero(joined.select("a3", "cohort", *MEASURES), MEASURES))


TPR_COLUMNS = "tpr_match, scheme_start_year, employees, company_type, company_status"


@query(
    "join_schemes",
    O.sql(
        f"SELECT m.a3, m.cohort, {TPR_COLUMNS} FROM members m LEFT JOIN tpr ON m.a3 = tpr.a3",
        O.MEMBERS,
        *O.SCHEME_CTES,
    ),
)
def join_schemes(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS).select("a3", "cohort")
    return A.attach(grown, scheme_features_of(spark, sf), on="a3")


@query(
    "join_schemes_raw",
    O.sql(
        "SELECT a3, a1, d3, d6, d8, d10, d12 FROM pt_a LEFT JOIN pt_d ON a3 = d15"
        f" WHERE CAST(a2 AS DATE) < {O.day(O.SCHEME_CUTOFF)}"
    ),
)
def join_schemes_raw(spark, sf):
    """Accounts left joined to their schemes as they are: a row for each."""
    accounts = A.created_before(T.accounts(spark, sf), T.SCHEME_CUTOFF).select("a3", "a1")
    joined = A.attach(accounts, T.schemes(spark, sf), left="a3", right="d15")
    return joined.select("a3", "a1", "d3", "d6", "d8", "d10", "d12")


@query("scheme_profile", O.sql("SELECT * FROM scheme_profile", O.PROFILE))
def scheme_profile(spark, sf):
    return H.scheme_profile(T.accounts(spark, sf), T.schemes(spark, sf), T.SCHEME_CUTOFF)


@query(
    "join_industry",
    O.sql(
        "SELECT a3, cohort, new_sic_code, sic_division, sic_section"
        " FROM members LEFT JOIN sic ON a3 = d15",
        O.MEMBERS,
        *O.INDUSTRY_CTES,
    ),
)
def join_industry(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS).select("a3", "cohort")
    return A.attach(grown, industry_of(spark, sf), left="a3", right="d15").drop("d15")


@query(
    "join_register",
    O.sql(
        f"SELECT d15, d3, MAX({O.token('i4')}) AS sic_code FROM company_owner"
        " JOIN pt_i ON d3 = i1 GROUP BY d15, d3",
        O.OWNER,
    ),
)
def join_register(spark, sf):
    return I.owners_with_code(I.company_owner(T.schemes(spark, sf)), T.register(spark, sf))


# --- aggregations ----------------------------------------------------------------------------


def per_cohort(parts: Callable[..., str], cohorts=O.COHORTS) -> str:
    return O.sql(
        " UNION ALL ".join(
            f"SELECT b10, '{c.label}' AS cohort, * EXCLUDE (b10) FROM ({parts(c)})" for c in cohorts
        )
    )


@query(
    "total_commitments",
    per_cohort(lambda c: O.counted(O.in_target(c), "total_commitments")),
)
def total_commitments(spark, sf):
    return C.count_in_window(
        T.commitments(spark, sf), T.COHORTS, "start", "target_end", name="total_commitments"
    )


@query(
    "prev_12m_new_commitments",
    per_cohort(lambda c: O.counted(O.in_lookback(c), "prev_12m_new_commitments")),
)
def prev_12m_new_commitments(spark, sf):
    return C.count_in_window(
        T.commitments(spark, sf), T.COHORTS, "prev_start", "start", name="prev_12m_new_commitments"
    )


@query(
    "prev_12m_new_levy_transfers",
    per_cohort(
        lambda c: O.counted(f"{O.in_lookback(c)} AND b12 = 1", "prev_12m_new_levy_transfers")
    ),
)
def prev_12m_new_levy_transfers(spark, sf):
    return C.count_in_window(
        T.commitments(spark, sf),
        T.COHORTS,
        "prev_start",
        "start",
        "b12 = 1",
        "prev_12m_new_levy_transfers",
    )


def share_query(null_test: str) -> str:
    return per_cohort(
        lambda c: f"SELECT b10, {O.share_list(null_test)} FROM pt_b"
        f" WHERE {O.in_lookback(c)} GROUP BY b10"
    )


@query("occupation_share", share_query("b6 IS NULL"))
def occupation_share(spark, sf):
    return plain(C.mix_share(T.commitments(spark, sf), T.COHORTS))


@query(
    "occupation_null_share",
    per_cohort(
        lambda c: f"SELECT b10, {O.share_of('b6 IS NULL', 'intended')},"
        f" {O.share_of('b6 = NULL', 'as_run')} FROM pt_b WHERE {O.in_lookback(c)} GROUP BY b10"
    ),
)
def occupation_null_share(spark, sf):
    """Share of missing codes as intended, and as the comparison with NULL gives it."""
    return plain(C.null_shares(T.commitments(spark, sf), T.COHORTS))


@query(
    "commitments_ending_12m",
    per_cohort(lambda c: O.counted(O.ending(c), "commitments_ending_12m")),
)
def commitments_ending_12m(spark, sf):
    return C.ending_in_window(T.commitments(spark, sf), T.COHORTS)


@query(
    "current_live_commitments",
    per_cohort(
        lambda c: O.counted(O.live(c), "current_live_commitments"),
        (*O.COHORTS, O.AS_OF_COHORT),
    ),
)
def current_live_commitments(spark, sf):
    return C.live_at(T.commitments(spark, sf), (*T.COHORTS, T.AS_OF_COHORT))


@query("cohort_features", O.sql(ALL_MEASURES_ORACLE, O.MEMBERS, O.FEATURES))
def cohort_features(spark, sf):
    """Every commitment feature of every cohort in one scan of the commitments."""
    frame = PF.cohort_frame(T.accounts(spark, sf), T.commitments(spark, sf), T.COHORTS)
    return plain(frame.select("a3", "cohort", *MEASURES))


# 120 windows of a year, each a month after the one before.
MONTHS = tuple(
    Cohort.fixed(str(10_000 + i), *(date(1992 + (i // 12) + y, i % 12 + 1, 1) for y in (-1, 0, 1)))
    for i in range(120)
)


def swept_sql(windows) -> str:
    """Every commitment beside every window that counts it."""
    rows = ", ".join(
        f"('{c.label}', {O.day(c.prev_start)}, {O.day(c.start)}, {O.day(c.end)})" for c in windows
    )
    back, new = "b2 >= prev_start AND b2 < start", "b2 >= start AND b2 < stop"
    open_ = "(b16 >= start OR b16 IS NULL) AND (b20 >= start OR b20 IS NULL)"
    due, live = f"b17 >= start AND b17 < stop AND {open_}", f"b2 < start AND {open_}"

    def share(test: str, name: str) -> str:
        return (
            f"CAST(CAST(COUNT(*) FILTER ({back} AND {test}) AS DECIMAL(10,3))"
            f" / NULLIF(COUNT(*) FILTER ({back}), 0) AS DECIMAL(10,3))::DOUBLE AS {name}"
        )

    shares = [share(f"b6 = '{code}'", f"occupation_{code}") for code in O.OCCUPATION_CODES]
    shares.append(share("b6 IS NULL", "occupation_null"))
    return O.sql(
        f"SELECT b10 AS a3, cohort, COUNT(*) FILTER ({new}) AS total_commitments,"
        f" {', '.join(shares)}, COUNT(*) FILTER ({back}) AS prev_12m_new_commitments,"
        f" COUNT(*) FILTER ({back} AND b12 = 1) AS prev_12m_new_levy_transfers,"
        f" COUNT(*) FILTER ({due}) AS commitments_ending_12m,"
        f" COUNT(*) FILTER ({live}) AS current_live_commitments"
        " FROM days JOIN spans"
        f" ON ({new}) OR ({back}) OR ({due}) OR ({live}) GROUP BY b10, cohort",
        "days AS (SELECT CAST(b2 AS DATE) AS b2, b6, b10, b12, CAST(b16 AS DATE) AS b16,"
        " CAST(b17 AS DATE) AS b17, CAST(b20 AS DATE) AS b20 FROM pt_b)",
        f"spans(cohort, prev_start, start, stop) AS (VALUES {rows})",
    )


@query("cohort_features_monthly", swept_sql(MONTHS))
def cohort_features_monthly(spark, sf):
    """120 monthly cohorts by a sweep: events where a commitment starts and stops to count."""
    return plain(W.swept_features(W.day_rows(T.commitments(spark, sf)), MONTHS))


@query("cohort_features_rolled_up", swept_sql(T.COHORTS))
def cohort_features_rolled_up(spark, sf):
    """From a roll-up appended in batches, the first of them twice: commitments are not read."""
    path, b = scratch(spark), T.commitments(spark, sf)
    early = F.coalesce(F.col("b2") < F.lit("1996-01-01").cast("timestamp_ntz"), F.lit(False))
    for batch, rows in (("1", b.where(early)), ("2", b.where(~early)), ("1", b.where(early))):
        W.append_batch(rows, path, batch)
    return plain(W.swept_features(W.read_roll_up(spark, path), T.COHORTS))


@query("cohort_features_bucketed", O.sql(ALL_MEASURES_ORACLE, O.MEMBERS, O.FEATURES))
def cohort_features_bucketed(spark, sf):
    """The cohort frame from tables stored by account, so that nothing is shuffled."""
    root = scratch(spark)
    store_bucketed(T.tables(spark, sf), root, 8)
    stored = read_bucketed(spark, root, 8)
    frame = PF.cohort_frame(stored.accounts, stored.commitments, T.COHORTS)
    return plain(frame.select("a3", "cohort", *MEASURES))


@query(
    "asof_features",
    O.sql(
        f"SELECT a.a3, {O.zeroed(MEASURES, 'f')} FROM pt_a a"
        " LEFT JOIN as_of_features f ON a.a3 = f.a3 WHERE a.a1 = 1",
        O.AS_OF_FEATURES,
    ),
)
def asof_features(spark, sf):
    accounts, _ = PS.score_accounts(T.accounts(spark, sf))
    frame = PF.cohort_frame(
        accounts, T.commitments(spark, sf), [T.AS_OF_COHORT], members_only=False
    )
    return plain(frame.select("a3", *MEASURES))


@query(
    "asof_features_open_at_start",
    O.sql(
        f"SELECT a.a3, {O.zeroed(MEASURES, 'f')} FROM pt_a a"
        f" LEFT JOIN ({O.both_parts(O.AS_OF_START)}) f ON a.a3 = f.a3 WHERE a.a1 = 1"
    ),
)
def asof_features_open_at_start(spark, sf):
    """As-of features with live counted at the window's start, as training does."""
    accounts, _ = PS.score_accounts(T.accounts(spark, sf))
    frame = PF.cohort_frame(
        accounts, T.commitments(spark, sf), [T.AS_OF_START], members_only=False
    )
    return plain(frame.select("a3", *MEASURES))


@query("scheme_features", O.sql("SELECT * FROM tpr", *O.SCHEME_CTES))
def scheme_features(spark, sf):
    return scheme_features_of(spark, sf)


@query("company_owner", O.sql("SELECT d3, d15 FROM company_owner", O.OWNER))
def company_owner(spark, sf):
    return I.company_owner(T.schemes(spark, sf))


@query("account_industry", O.sql("SELECT d15, sic_code FROM account_code", O.OWNER, O.CODE))
def account_industry(spark, sf):
    return codes_of(spark, sf)


@query(
    "industry_features",
    O.sql("SELECT d15, new_sic_code, sic_division, sic_section FROM sic", *O.INDUSTRY_CTES),
)
def industry_features(spark, sf):
    return industry_of(spark, sf)


@query(
    "column_profile",
    O.sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c})"
            f" + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_values FROM pt_d"
            for c in ("d3", "d6", "d8", "d10", "d12", "d15")
        )
    ),
)
def column_profile(spark, sf):
    return E.column_profile(T.schemes(spark, sf))


LETTERS = [chr(code) for code in range(ord("A"), ord("Z") + 1)]


@query(
    "drop_constant_columns",
    O.sql(
        "SELECT a3, feature, value FROM long WHERE feature IN"
        " (SELECT feature FROM long GROUP BY feature HAVING COUNT(DISTINCT value) > 1)",
        *O.SCHEME_CTES,
        "wide AS (SELECT a3, "
        + ", ".join(f"CASE WHEN company_type = '{v}' THEN 1 ELSE 0 END AS t_{v}" for v in LETTERS)
        + ", 1 AS one, tpr_match, tpr_match * 0 AS none FROM tpr)",
        "long AS (FROM (UNPIVOT wide ON COLUMNS(* EXCLUDE (a3)) INTO NAME feature VALUE value))",
    ),
)
def drop_constant_columns(spark, sf):
    """Of 29 columns of every account those that vary, a row for each value."""
    hot = E.one_hot(scheme_features_of(spark, sf), "company_type", "t", LETTERS)
    names = [*[f"t_{v}" for v in LETTERS], "one", "tpr_match", "none"]
    wide = hot.selectExpr("*", "1 AS one", "tpr_match * 0 AS none").select("a3", *names)
    left = E.drop_constant(cut_lineage(wide), protect=["a3"])
    kept = [c for c in left.columns if c != "a3"]
    pairs = ", ".join(f"'{c}', CAST({c} AS INT)" for c in kept)
    return left.selectExpr("a3", f"stack({len(kept)}, {pairs}) AS (feature, value)")


# --- samples, splits, set operations ---------------------------------------------------------


@query(
    "sample_top_n",
    O.sql(
        f"SELECT a1, a2, a3, a7 FROM pt_a WHERE a1 = 1 ORDER BY {O.ranked_hash(O.SEED)}, a3"
        f" LIMIT {SCORE_N}"
    ),
)
def sample_top_n(spark, sf):
    return M.sample_top_n(A.levy_only(T.accounts(spark, sf)), SCORE_N, T.SEED)


@query("sample_stratified", O.sql(O.stratified(SAMPLE_N, O.SEED, "a1, a2, a3, a7")))
def sample_stratified(spark, sf):
    return sampled(spark, sf)


@query("sample_stratified_large", O.sql(O.stratified(SAMPLE_LARGE, O.SEED, "a1, a2, a3, a7")))
def sample_stratified_large(spark, sf):
    """A sample large enough to be ranked inside hash ranges."""
    return sampled(spark, sf, SAMPLE_LARGE)


@query(
    "union_distinct",
    O.sql(
        f"SELECT a1, COUNT(*) AS accounts FROM ({O.stratified(SAMPLE_LARGE, O.SEED, 'a1, a3')})"
        " GROUP BY a1"
    ),
)
def union_distinct(spark, sf):
    """An account of two strata (created on 1 January) counts once."""
    return sampled(spark, sf, SAMPLE_LARGE).groupBy("a1").agg(F.count("*").alias("accounts"))


ROW_KEY = "a3 || '-' || cohort"


@query(
    "train_test_split",
    O.sql(
        f"SELECT a3 AS account_id, cohort, CASE WHEN {O.in_test(7, ROW_KEY)}"
        " THEN 'test' ELSE 'train' END AS side FROM members",
        O.MEMBERS,
    ),
)
def train_test_split(spark, sf):
    grown = A.rename_features(A.expand_cohorts(T.accounts(spark, sf), T.COHORTS))
    train, test = M.hash_split(grown.select("account_id", "cohort"), seed=7)
    return A.stack(
        [train.withColumn("side", F.lit("train")), test.withColumn("side", F.lit("test"))]
    )


@query("union_accounts", O.sql("SELECT a1, a2, a3, cohort FROM members", O.MEMBERS))
def union_accounts(spark, sf):
    grown = A.expand_cohorts(T.accounts(spark, sf), T.COHORTS)
    return grown.select("a1", "a2", "a3", "cohort")


@query("union_features", O.sql(f"SELECT a3, cohort, {O.zeroed(MEASURES, 'f')} FROM features f", O.FEATURES))
def union_features(spark, sf):
    """Features of all cohorts from one aggregation, for accounts created before each."""
    accounts = A.levy_only(T.accounts(spark, sf))
    frame = PF.cohort_frame(accounts, T.commitments(spark, sf), T.COHORTS)
    return plain(frame.where(CREATED_IN_TIME).select("a3", "cohort", *MEASURES))


# --- encoding and model ----------------------------------------------------------------------


def hot_sql(col: str, prefix: str, values: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS {prefix}_{v}" for v in values
    )


@query(
    "one_hot_type",
    O.sql(f"SELECT a3, {hot_sql('company_type', 'comp_type', TYPES)} FROM tpr", *O.SCHEME_CTES),
)
def one_hot_type(spark, sf):
    hot = E.one_hot(scheme_features_of(spark, sf), "company_type", PT.TYPE_PREFIX, TYPES)
    return hot.select("a3", *[f"{PT.TYPE_PREFIX}_{v}" for v in TYPES])


@query(
    "one_hot_industry",
    O.sql(
        f"SELECT a3, {hot_sql('sic_section', 'sic_section', SECTIONS)},"
        f" {hot_sql('sic_division', 'sic_division', DIVISIONS)},"
        f" {hot_sql('new_sic_code', 'sic_code', CODES)}"
        " FROM pt_a LEFT JOIN sic ON a3 = d15",
        *O.INDUSTRY_CTES,
    ),
)
def one_hot_industry(spark, sf):
    joined = A.attach(
        T.accounts(spark, sf).select("a3"), industry_of(spark, sf), left="a3", right="d15"
    )
    hot = E.one_hot(joined, "sic_section", PT.SECTION_PREFIX, SECTIONS)
    hot = E.one_hot(hot, "sic_division", PT.DIVISION_PREFIX, DIVISIONS)
    hot = E.one_hot(hot, "new_sic_code", "sic_code", CODES)
    return hot.drop("d15", "new_sic_code", "sic_section", "sic_division")


MODEL_FEATURES = ["comp_type_Q", "employees", "comp_type_C", "scheme_start_year", "not_there"]


@query(
    "align_features",
    O.sql(
        "SELECT a3, 0 AS comp_type_Q, employees,"
        " CASE WHEN company_type = 'C' THEN 1 ELSE 0 END AS comp_type_C, scheme_start_year,"
        " 0 AS not_there FROM tpr",
        *O.SCHEME_CTES,
    ),
)
def align_features(spark, sf):
    hot = E.one_hot(scheme_features_of(spark, sf), "company_type", PT.TYPE_PREFIX, TYPES)
    return E.align(hot, MODEL_FEATURES, keep=["a3"]).frame


def raw_frame(spark, sf, industry=False, n=None):
    return PT.raw_training_frame(
        T.tables(spark, sf), T.COHORTS, T.STRATA, n, T.SEED, settings(spark, industry)
    )


def model_frame(spark, sf):
    """The encoded training frame with fixed type letters, complete rows only."""
    return A.drop_missing(PT.encoded(raw_frame(spark, sf), settings(spark), types=TYPES))


def model_features(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in (*PT.KEYS, L.TARGET)]


HOT_TYPES = hot_sql("company_type", "comp_type", TYPES)
ELIGIBLE = "employees <= 20000 AND tpr_match = 1"
FRAME_COLUMNS = (
    "account_id, cohort, early_adopter, levy_non_levy, as_months_since_sign_up, "
    + ", ".join(MEASURES).replace("total_commitments, ", "")
    + f", {HOT_TYPES}, years_since_tpr_signup, new_company, log_employees,"
    " log_adjusted_commitments"
)


@query(
    "training_frame_encoded",
    O.sql(f"SELECT {FRAME_COLUMNS} FROM training WHERE {ELIGIBLE}", *O.TRAINING_CTES),
)
def training_frame_encoded(spark, sf):
    """The whole training frame up to encoding, for every account of any stratum."""
    return plain(model_frame(spark, sf))


LONG_FRAME = (
    "UNPIVOT (SELECT account_id, cohort, CAST(COLUMNS(* EXCLUDE (account_id, cohort)) AS DOUBLE)"
    f" FROM (SELECT {FRAME_COLUMNS} FROM training WHERE {ELIGIBLE}))"
    " ON COLUMNS(* EXCLUDE (account_id, cohort)) INTO NAME feature VALUE value"
)


@query(
    "training_frame",
    O.sql(
        "SELECT account_id, cohort, feature, value FROM long WHERE feature IN (SELECT feature"
        f" FROM long GROUP BY feature HAVING COUNT(DISTINCT value) > 1 OR feature = '{L.TARGET}')",
        *O.TRAINING_CTES,
        f"long AS (FROM ({LONG_FRAME}))",
    ),
)
def training_frame(spark, sf):
    """The frame as fitted (letters looked up, constant columns gone), a row for each value."""
    frame = plain(
        PT.training_frame(T.tables(spark, sf), T.COHORTS, T.STRATA, settings=settings(spark))
    )
    values = [c for c in frame.columns if c not in PT.KEYS]
    pairs = ", ".join(f"{S.text(c)}, CAST(`{c}` AS DOUBLE)" for c in values)
    long = f"stack({len(values)}, {pairs}) AS (feature, value)"
    return frame.selectExpr(*PT.KEYS, long)


@query(
    "training_frame_sampled",
    O.sql(
        f"SELECT {FRAME_COLUMNS} FROM training WHERE {ELIGIBLE}"
        " AND account_id IN (SELECT a3 FROM ids)",
        *O.TRAINING_CTES,
        f"ids AS ({O.stratified(SAMPLE_LARGE, O.SEED, 'a3')})",
    ),
)
def training_frame_sampled(spark, sf):
    """The training frame of a stratified sample."""
    raw = raw_frame(spark, sf, n=SAMPLE_LARGE)
    return plain(A.drop_missing(PT.encoded(raw, settings(spark), types=TYPES)))


@query(
    "training_frame_industry",
    O.sql(
        f"SELECT {FRAME_COLUMNS}, {hot_sql('sic_section', 'sic_section', SECTIONS)},"
        f" {hot_sql('sic_division', 'sic_division', DIVISIONS)},"
        " new_sic_code FROM training LEFT JOIN sic ON account_id = d15"
        f" WHERE {ELIGIBLE} AND company_status = 3",
        *O.TRAINING_CTES,
        *O.INDUSTRY_CTES,
    ),
)
def training_frame_industry(spark, sf):
    """With sections and divisions, complete rows; codes stay one column for the model."""
    frame = PT.encoded(
        raw_frame(spark, sf, industry=True),
        settings(spark, industry=True),
        types=TYPES,
        sections=SECTIONS,
        divisions=DIVISIONS,
    )
    return plain(A.drop_missing(frame, [c for c in frame.columns if c != PT.CODE_COLUMN]))


MODEL_ORDER = [
    *("early_adopter", "levy_non_levy", "as_months_since_sign_up"),
    *O.SHARES,
    *("prev_12m_new_commitments", "prev_12m_new_levy_transfers", "levy_sending_company"),
    *("commitments_ending_12m", "current_live_commitments"),
    *(f"comp_type_{v}" for v in TYPES),
    *("years_since_tpr_signup", "new_company", "log_employees"),
]
FRAME = f"frame AS (SELECT {FRAME_COLUMNS} FROM training WHERE {ELIGIBLE})"


@query(
    "assemble",
    O.sql(
        "SELECT account_id, cohort, ROUND(CAST("
        + " + ".join(f"{i} * {name}" for i, name in enumerate(MODEL_ORDER, 1))
        + " AS DOUBLE), 4) AS weighted_sum FROM frame",
        *O.TRAINING_CTES,
        FRAME,
    ),
)
def assemble(spark, sf):
    """Feature vectors, reduced to a sum that weighs every value by its position."""
    frame = model_frame(spark, sf)
    values = vector_to_array(F.col("features"))
    weighted = F.transform(values, lambda x, i: x * (i + 1))
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)
    return L.assemble(frame, model_features(frame)).select(
        "account_id", "cohort", F.round(total, 4).alias("weighted_sum")
    )


# Every distinct value is a cut, as in the SQL.
EXACT = L.BoostParams(max_bins=2**16 - 1)
FITTED: dict[tuple[str, str], tuple[DataFrame, PT.Trained, str]] = {}


def fitted(spark, sf):
    """The model of default size, fitted once in a session and stored."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in FITTED:
        frame, path = cut_lineage(model_frame(spark, sf)), scratch(spark)
        FITTED[key] = frame, PT.train_pipeline(frame, EXACT, path), path
    return FITTED[key]


BASE = (
    "base AS MATERIALIZED (SELECT account_id || '-' || cohort AS rid, account_id, cohort,"
    f" NOT ({O.in_test(7, ROW_KEY.replace('a3', 'account_id'))}) AS fit,"
    f" LN(total_commitments + 1) AS y, {', '.join(MODEL_ORDER)}"
    f" FROM (SELECT {FRAME_COLUMNS}, total_commitments FROM training WHERE {ELIGIBLE}))"
)


def refitted(body: str, *ctes: str) -> str:
    """SQL over the trees and predictions of a fit in SQL on the rows of ``base``."""
    ctes = (*(ctes or (*O.TRAINING_CTES, BASE)), *refit(MODEL_ORDER))
    return O.sql(body, *ctes).replace("WITH", "WITH RECURSIVE", 1)


def metrics_sql(columns: str = "") -> str:
    """Metrics of predictions p, to 6 digits."""
    unexplained = "SUM(POW(y - margin, 2)) / (VAR_POP(y) * COUNT(*))"
    return (
        f"SELECT {columns} COUNT(*) AS rows, ROUND(1 - {unexplained}, 6) AS r2,"
        f" ROUND(1 - {unexplained} * (COUNT(*) - 1) / (COUNT(*) - {len(MODEL_ORDER)} - 1), 6)"
        " AS adjusted_r2, ROUND(SQRT(AVG(POW(y - margin, 2))), 6) AS rmse"
        " FROM base JOIN predicted USING (rid)"
    )


NAMES = ", ".join(f"({i}, '{name}')" for i, name in enumerate(MODEL_ORDER))
FEATURE_LIST = f"SELECT position, feature FROM (VALUES {NAMES}) AS v(position, feature)"


def digits(df: DataFrame) -> DataFrame:
    """Doubles at 6 digits."""
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def evaluated(trained: PT.Trained, part: DataFrame) -> DataFrame:
    return L.evaluate(L.predict(part, trained.model), len(trained.features))


@query(
    "train_regressor",
    refitted(metrics_sql("CASE WHEN fit THEN 'fit' ELSE 'test' END AS part,") + " GROUP BY fit"),
)
def train_regressor(spark, sf):
    """The regressor's error on the rows it did not see and on those it did."""
    frame, trained, _ = fitted(spark, sf)
    parts = dict(zip(("fit", "test"), M.hash_split(frame, PT.KEYS, seed=7)))
    rows = [evaluated(trained, df).withColumn("part", F.lit(part)) for part, df in parts.items()]
    return digits(rows[0].unionByName(rows[1]))


@query(
    "predict",
    refitted(
        "SELECT account_id, cohort, ROUND(margin, 6) AS prediction"
        " FROM base JOIN predicted USING (rid)"
    ),
)
def predict(spark, sf):
    frame, trained, _ = fitted(spark, sf)
    return digits(L.predict(frame, trained.model).select(*PT.KEYS, L.PREDICTION))


@query(
    "evaluate",
    O.sql(
        "SELECT COUNT(*) AS rows, ROUND(1 - SUM(POW(y - p, 2)) / (VAR_POP(y) * COUNT(*)), 9) AS r2,"
        " ROUND(1 - (SUM(POW(y - p, 2)) / (VAR_POP(y) * COUNT(*))) * (COUNT(*) - 1)"
        " / (COUNT(*) - 3 - 1), 9) AS adjusted_r2,"
        " ROUND(SQRT(AVG(POW(y - p, 2))), 9) AS rmse FROM"
        " (SELECT log_adjusted_commitments AS y, LN(prev_12m_new_commitments + 1) AS p"
        f" FROM training WHERE {ELIGIBLE})",
        *O.TRAINING_CTES,
    ),
)
def evaluate(spark, sf):
    """Last year's count as the prediction for the next."""
    stand_in = F.log1p("prev_12m_new_commitments").alias(L.PREDICTION)
    frame = raw_frame(spark, sf).select(F.round(L.TARGET, 9).alias(L.TARGET), stand_in)
    return plain(L.evaluate(frame, 3))


@query(
    "feature_importance",
    refitted(
        "SELECT feature, ROUND(COALESCE(SUM(gain), 0) / (SELECT SUM(gain) FROM grown), 6)"
        f" AS importance FROM ({FEATURE_LIST}) v LEFT JOIN (SELECT * FROM grown WHERE rid IS NULL) g"
        " ON g.f = v.position + 1 GROUP BY feature"
    ),
)
def feature_importance(spark, sf):
    """Every feature's share of the total gain."""
    return digits(fitted(spark, sf)[1].importance)


@query(
    "feature_contributions",
    refitted(
        "SELECT account_id, cohort, ROUND(margin, 6) AS total FROM base JOIN predicted USING (rid)"
    ),
)
def feature_contributions(spark, sf):
    """What the features add to a prediction, with what it is without any: the prediction."""
    frame, trained, _ = fitted(spark, sf)
    rows = X.contribution_rows(frame, trained.model)
    added = F.aggregate("contributions", F.col("expected"), lambda a, b: a + b)
    return digits(rows.select(*PT.KEYS, added.alias("total")))


@query("mean_contributions")
def mean_contributions(spark, sf):
    """Features by their mean absolute contribution over the whole frame."""
    frame, trained, _ = fitted(spark, sf)
    return X.mean_contributions(frame, trained.model)


@query(
    "tree_nodes",
    refitted(
        f"SELECT ((step - 1) // 6)::INT AS tree, node, feature, ROUND(gain, 6) AS gain FROM grown"
        f" JOIN ({FEATURE_LIST}) v ON f = position + 1 WHERE rid IS NULL"
    ),
)
def tree_nodes(spark, sf):
    """The stored splits of all trees."""
    path = fitted(spark, sf)[2]
    version = model_versions(spark, path).agg(F.max("version")).first()[0]
    nodes = spark.read.parquet(f"{path}/versions/{version}").where("feature IS NOT NULL")
    return digits(nodes.select("tree", "node", "feature", "gain"))


@query("model_save", FEATURE_LIST)
def model_save(spark, sf):
    """The feature list as stored with the model."""
    features = F.posexplode("features").alias("position", "feature")
    return model_versions(spark, fitted(spark, sf)[2]).select(features)


@query(
    "model_load",
    O.sql("SELECT account_id, cohort, TRUE AS equal FROM frame", *O.TRAINING_CTES, FRAME),
)
def model_load(spark, sf):
    """Predictions of a model that went through storage equal those of the fitted one."""
    frame, trained, path = fitted(spark, sf)
    loaded, names = load_model(path)
    before = L.predict(frame, trained.model).withColumnRenamed(L.PREDICTION, "before")
    kept = [*PT.KEYS, "before"]
    aligned = E.align(before, names, keep=kept).frame
    equal = (F.col("before") == F.col(L.PREDICTION)).alias("equal")
    return L.predict(aligned, loaded).select(*PT.KEYS, equal)


@query("train_pipeline", refitted(metrics_sql() + " WHERE NOT fit"))
def train_pipeline(spark, sf):
    """The metrics of the whole job, from source tables to the stored model."""
    return digits(fitted(spark, sf)[1].metrics)


def score_frame_body(features: str) -> str:
    return (
        "SELECT a.a3 AS account_id, a1 AS levy_non_levy,"
        f" CAST(FLOOR({O.months(O.AS_OF)}) AS INT) AS as_months_since_sign_up,"
        f" {O.zeroed(MEASURES, 'f')}, {O.AS_OF.year} - scheme_start_year AS years_since_tpr_signup,"
        f" CASE WHEN FLOOR({O.months(O.AS_OF)}) <= 6 THEN 1 ELSE 0 END AS new_company,"
        " ROUND(LOG2(employees + 1), 9) AS log_employees"
        f" FROM pt_a a LEFT JOIN ({features}) f ON a.a3 = f.a3 LEFT JOIN tpr ON a.a3 = tpr.a3"
        " WHERE a1 = 1"
    )


def score_frame_sql(features: str) -> str:
    return O.sql(score_frame_body(features), *O.SCHEME_CTES)


def scored_features(spark, sf, compat: bool) -> DataFrame:
    frame = PS.score_frame(T.tables(spark, sf), T.AS_OF, settings=settings(spark), compat=compat)
    return plain(
        frame.select(
            "account_id",
            "levy_non_levy",
            "as_months_since_sign_up",
            *MEASURES,
            "years_since_tpr_signup",
            "new_company",
            "log_employees",
        )
    )


@query("score_frame", score_frame_sql(O.both_parts(O.AS_OF_START)))
def score_frame(spark, sf):
    """Every levy account's features as of a day, as score_pipeline takes them."""
    return scored_features(spark, sf, compat=False)


@query("score_frame_compat", score_frame_sql(O.both_parts(O.AS_OF_COHORT)))
def score_frame_compat(spark, sf):
    """The same with commitments live as of the day itself."""
    return scored_features(spark, sf, compat=True)


def scored(spark, sf, ids: DataFrame | None = None) -> DataFrame:
    """Predictions as written."""
    path, out = fitted(spark, sf)[2], scratch(spark)
    PS.score_pipeline(
        T.tables(spark, sf), T.AS_OF, path, out, settings=settings(spark), fmt="parquet", ids=ids
    )
    return digits(spark.read.parquet(out))


# The rows to score beside those to fit on. Without scheme data, three features have no value.
SCORED = (
    f"scored AS (SELECT s.*, {HOT_TYPES},"
    f" CASE WHEN CAST(a2 AS DATE) < {O.day(O.EARLY_CUTOFF)} THEN 1 ELSE 0 END AS early_adopter, a7"
    f" FROM ({score_frame_body(O.both_parts(O.AS_OF_START))}) s JOIN pt_a ON a3 = account_id"
    " LEFT JOIN (SELECT a3 AS owner, company_type FROM tpr) ON owner = account_id)"
)
BOTH = BASE[:-1] + (
    " UNION ALL BY NAME SELECT 's-' || account_id AS rid, account_id, FALSE AS fit, a7,"
    f" {', '.join(MODEL_ORDER)} FROM scored)"
)


def predictions_sql(where: str = "TRUE") -> str:
    return refitted(
        "SELECT account_id, ROUND(EXP(margin) - 1, 6) AS levy_model_prediction"
        f" FROM base JOIN predicted USING (rid) WHERE starts_with(rid, 's-') AND {where}",
        *O.TRAINING_CTES,
        SCORED,
        BOTH,
    )


@query("score_pipeline", predictions_sql())
def score_pipeline(spark, sf):
    """A model trained on the cohorts and saved scores every levy account as of a day."""
    return scored(spark, sf)


@query("score_pipeline_listed", predictions_sql("a7 = 1"))
def score_pipeline_listed(spark, sf):
    """The same for a list of accounts: here those that send."""
    return scored(spark, sf, T.accounts(spark, sf).where("a7 = 1").select("a3"))


@query(
    "sink_predictions",
    O.sql(
        "SELECT b10 AS account_id, ROUND(LN(total_commitments + 1), 9) AS levy_model_prediction"
        f" FROM ({TARGETS})"
    ),
)
def sink_predictions(spark, sf):
    """Written as CSV and read back."""
    value = f"round({S.log_target('total_commitments')}, 9) AS {PS.PREDICTED}"
    out = scratch(spark)
    write_predictions(target_counts(spark, sf).selectExpr("b10 AS account_id", value), out)
    schema = f"account_id bigint, {PS.PREDICTED} double"
    return spark.read.option("header", True).schema(schema).csv(out)


@query(
    "sink_predictions_by_day",
    O.sql(
        "SELECT b10 AS account_id, ROUND(LN(total_commitments + 1), 9) AS levy_model_prediction,"
        f" as_of FROM ({TARGETS}), (VALUES (DATE '2001-07-01'), (DATE '2001-07-02')) v(as_of)"
    ),
)
def sink_predictions_by_day(spark, sf):
    """Two scoring days, the first written twice."""
    value = f"round({S.log_target('total_commitments')}, 9) AS {PS.PREDICTED}"
    rows, out = target_counts(spark, sf).selectExpr("b10 AS account_id", value), scratch(spark)
    for day in (date(2001, 7, 1), date(2001, 7, 2), date(2001, 7, 1)):
        write_day(rows, out, day)
    return spark.read.parquet(out)
