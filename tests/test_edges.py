"""Hand-written rows at the edges of windows, rules and keys."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortloom.cohorts import Cohort, rolling_cohort
from cohortloom.functions import scalars as S
from cohortloom.operators import accounts as A
from cohortloom.operators import commitments as C
from cohortloom.operators import encoding as E
from cohortloom.operators import industry as I
from cohortloom.operators import sampling as M
from cohortloom.operators import schemes as H
from cohortloom.plans import features as PF
from cohortloom.rules import SECTION_BANDS, Rules, code_map, code_map_digest
from tests import frames as T

YEAR = Cohort.fixed("2019", date(2017, 4, 1), date(2018, 4, 1), date(2019, 4, 1))


def one_value(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.selectExpr(expression).collect()]


def test_window_ends(spark):
    rows = [
        (1, "2017-03-31 23:59:59", "1", 0, None, "2018-03-31 23:00:00", None),
        (1, "2017-04-01 00:00:00", "1", 0, None, "2018-04-01 00:00:00", None),
        (1, "2018-03-31 23:59:59", "1", 1, None, "2019-03-31 23:59:59", None),
        (1, "2018-04-01 00:00:00", "1", 1, None, "2019-04-01 00:00:00", None),
        (1, "2019-03-31 23:59:59", "1", 0, None, "2020-03-31 00:00:00", None),
        (1, "2019-04-01 00:00:00", "1", 0, None, "2020-04-01 00:00:00", None),
    ]
    row = C.commitment_features(T.commitments(spark, rows), [YEAR]).first()
    assert row.prev_12m_new_commitments == 2
    assert row.prev_12m_new_levy_transfers == 1
    assert row.total_commitments == 2
    assert row.commitments_ending_12m == 2
    assert row.current_live_commitments == 3


def test_closed_before_start_is_not_live(spark):
    def row(account, closed_one, closed_two):
        return (account, "2017-06-01", None, None, closed_one, "2018-09-01", closed_two)

    rows = [
        row(1, None, None),
        row(2, "2018-04-01", None),
        row(3, "2018-03-31 23:00:00", None),
        row(4, None, "2018-03-31"),
        row(5, "2018-05-01", "2018-03-01"),
    ]
    got = T.by_key(C.commitment_features(T.commitments(spark, rows), [YEAR]), "a3")
    live = {key[0]: r.current_live_commitments for key, r in got.items()}
    assert live == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
    assert {k[0]: r.commitments_ending_12m for k, r in got.items()} == live


def test_share_tie_rounds_up_and_nulls(spark):
    """1 of 16 is 0.0625; a NULL transfer flag or code is not counted as a match."""
    rows = [(1, "2017-06-01", "1", None, None, None, None)]
    rows += [(1, "2017-06-01", None if i < 4 else "99", 1, None, None, None) for i in range(15)]
    row = C.commitment_features(T.commitments(spark, rows), [YEAR]).first()
    assert row.occupation_1 == Decimal("0.063")
    assert row.occupation_null == Decimal("0.250")
    assert row.prev_12m_new_levy_transfers == 15


@pytest.mark.parametrize("total", [3, 7, 80, 2000, 999999])
def test_share_rounds_half_up_exactly(spark, total):
    from decimal import ROUND_HALF_UP

    parts = sorted({0, 1, 2, 3, total // 3, total // 2, total - 1, total})
    df = spark.createDataFrame([(p, total) for p in parts], "p bigint, t bigint")
    got = [r[0] for r in df.selectExpr(S.share("p", "t")).collect()]
    exact = [
        (Decimal(p) / Decimal(total)).quantize(Decimal("0.001"), ROUND_HALF_UP) for p in parts
    ]
    assert got == exact


def test_account_rules_of_features(spark):
    """Non-levy accounts and accounts newer than the window have zeros; members stay."""
    accounts = T.accounts(
        spark,
        [
            (1, "2017-01-01", 1, 1),
            (0, "2017-01-01", 2, 1),
            (1, "2018-04-01", 3, 1),
            (1, "2019-04-01", 4, 1),
            (1, "2016-01-01", 5, None),
        ],
    )
    rows = [(a, "2018-06-01", "1", 0, None, None, None) for a in (1, 2, 3, 4)]
    got = T.by_key(PF.cohort_frame(accounts, T.commitments(spark, rows), [YEAR]), "a3")
    assert {k[0]: (r.total_commitments, r.levy_sending_company) for k, r in got.items()} == {
        1: (1, 1),
        2: (0, 0),
        3: (0, 0),
        5: (0, 0),
    }


def test_open_ended_target_of_scoring(spark):
    """Rows after the as-of day still count towards the target; live is as of either day."""
    rows = [
        (1, "2020-07-02", None, None, None, None, None),
        (1, "2025-01-01", None, None, None, None, None),
        (1, "2020-01-01", None, None, "2020-09-01", None, None),
    ]
    b = T.commitments(spark, rows)
    start_live = C.commitment_features(b, [rolling_cohort(date(2021, 7, 1))]).first()
    today_live = C.commitment_features(b, [rolling_cohort(date(2021, 7, 1), compat=True)]).first()
    assert start_live.total_commitments == today_live.total_commitments == 2
    assert (start_live.current_live_commitments, today_live.current_live_commitments) == (1, 0)


def test_new_year_accounts_are_in_two_strata(spark):
    accounts = T.accounts(
        spark,
        [(1, "2018-01-01", 1, 0), (1, "2018-01-01 00:00:01", 2, 0), (1, "2017-05-05", 3, 0)],
    )
    strata = M.year_strata(2017, 2018)
    assigned = M.assign_strata(accounts, strata).groupBy("a3").count()
    assert {r.a3: r["count"] for r in assigned.collect()} == {1: 2, 2: 1, 3: 1}
    assert M.sample_stratified(accounts, strata, 5, seed=1).count() == 3


@pytest.mark.parametrize("n", [1, 3, 150, 600])
def test_large_sample_equals_sorting(spark, n):
    """Both ways of taking the first n per stratum against a sort of all rows."""
    import hashlib

    rows = [(i % 2, f"201{7 + i % 3}-0{1 + i % 9}-11", i, 0) for i in range(3000)]
    accounts = T.accounts(spark, rows)
    strata = M.year_strata(2017, 2019)
    expected = set()
    for s in strata:
        inside = [
            i
            for flag, day, i, _ in rows
            if flag == s.levy and str(s.low) <= day <= str(s.high)
        ]
        inside.sort(key=lambda i: (hashlib.md5(f"5-{i}".encode()).hexdigest(), i))
        expected |= set(inside[:n])
    got = [r.a3 for r in M.sample_stratified(accounts, strata, n, seed=5).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected


@pytest.mark.parametrize("n", [7, 250, 10_000])
def test_top_n_equals_sorting(spark, n):
    import hashlib

    accounts = T.accounts(spark, [(1, "2018-01-01", i, 0) for i in range(1000)])
    order = sorted(range(1000), key=lambda i: (hashlib.md5(f"3-{i}".encode()).hexdigest(), i))
    got = [r.a3 for r in M.sample_top_n(accounts, n, seed=3).collect()]
    assert sorted(got) == sorted(order[:n])


def test_scheme_profile_keeps_both_levy_flags_and_unmatched(spark):
    accounts = T.accounts(
        spark,
        [(0, "2017-01-01", 1, 0), (1, "2017-01-01", 1, 0), (1, "2017-01-01", 2, 0),
         (1, "2022-01-01", 3, 0)],
    )
    schemes = T.schemes(
        spark,
        [("A", "2005-05-05", 1, 10, "company", 1), ("B", "2001-01-01", 3, None, "Sole", 1),
         ("C", "2001-01-01", 3, 5, "Sole", 3), ("D", None, None, 5, None, None)],
    )
    got = T.by_key(H.scheme_profile(accounts, schemes), "a3", "a1")
    assert set(got) == {(1, 0), (1, 1), (2, 1)}
    assert tuple(got[1, 0])[2:] == (10, 2001, "S", 3)
    assert tuple(got[2, 1])[2:] == (None, None, None, None)


def test_scheme_features_impute(spark):
    accounts = T.accounts(spark, [(f, "2017-01-01", 10 * f + k, 0) for f in (0, 1) for k in range(4)])
    schemes = T.schemes(
        spark,
        [(f"N{i}", None, 1, None, kind, i)
         for f in (0, 1) for i, kind in ((10 * f, "partnership"), (10 * f + 1, "Exempt"),
                                         (10 * f + 2, None))],
    )
    got = T.by_key(H.scheme_features(accounts, schemes), "a3")
    values = {k[0]: (r.scheme_start_year, r.employees, r.company_type) for k, r in got.items()}
    assert values == {
        0: (2008, 28.5, "P"),
        1: (2011, 16.0, "E"),
        2: (2011, 16.0, "X"),
        3: (2011, 16.0, "X"),
        10: (1999, 683.0, "P"),
        11: (2008, 259.5, "E"),
        12: (2004, 200.0, "X"),
        13: (2004, 200.0, "X"),
    }
    assert {r.tpr_match for r in got.values()} == {0}


def test_code_token(spark):
    got = one_value(spark, S.leading_token("x"), ["0111 Growing", "Growing", " lead", "", None])
    assert got == ["0111", "Growing", "", "", None]


def test_section_bands(spark):
    codes = ["03", "04", "33", "34", "99", "00", "5", "", "  ", "ab", None]
    got = one_value(spark, S.band("x", SECTION_BANDS, "Z"), codes)
    assert got == ["A", "B", "C", "D", "U", "A", "B", "A", "A", "Z", "Z"]


def test_industry_with_repeated_companies(spark):
    """A company's owner is its largest account; an account's code is its largest code."""
    schemes = T.schemes(
        spark,
        [("A", None, 1, 1, None, 1), ("A", None, 1, 1, None, 2), ("B", None, 1, 1, None, 2),
         ("C", None, 1, 1, None, -1), ("D", None, 1, 1, None, None), (None, None, 1, 1, None, 9)],
    )
    register = T.register(
        spark, [("A", "0111 x"), ("A", "0112 y"), ("B", "9999 z"), ("C", "0111 x"), ("B", None)]
    )
    pairs = spark.createDataFrame([("0112", "01110"), ("9999", "abc")], "old_code string, new_code string")
    rows = I.industry_features(schemes, register, pairs).collect()
    assert [tuple(r) for r in rows] == [(2, "abc", "ab", "Z")]
    owned = I.owners_with_code(I.company_owner(schemes), register)
    assert {tuple(r) for r in owned.collect()} == {(2, "A", "0112"), (2, "B", "9999")}


def test_owner_restriction_comes_first(spark):
    """Within an account set, a company belongs to its largest account of the set."""
    schemes = T.schemes(spark, [("A", None, 1, 1, None, 1), ("A", None, 1, 1, None, 2)])
    ids = spark.createDataFrame([(1,)], "a3 bigint")
    assert [tuple(r) for r in I.company_owner(schemes, ids).collect()] == [("A", 1)]


PAIRS = [("0112", "01110"), ("0111", "01110")]


def test_code_map_keeps_every_pair(spark):
    pairs = spark.createDataFrame(PAIRS, "old_code string, new_code string")
    assert {tuple(r) for r in code_map(pairs).collect()} == set(PAIRS)
    import hashlib

    expected = hashlib.sha256(b"0111,01110\n0112,01110").hexdigest()
    assert code_map_digest(pairs).first().digest == expected


@pytest.mark.parametrize(
    "bad", [("12345", "1"), ("abcd", "1"), ("111", "1"), ("0111", "09999"), (None, "1"), ("1", None)]
)
def test_code_map_drops_nothing(spark, bad):
    pairs = spark.createDataFrame([*PAIRS, bad], "old_code string, new_code string")
    with pytest.raises(Exception, match="not one new code"):
        code_map(pairs).collect()


def test_tenure_uses_average_months(spark):
    anchor = datetime(2020, 4, 1, 12, 0, 0)
    df = T.accounts(spark, [(1, "2019-10-01 06:30:15.250000", 1, 0)])
    months = df.selectExpr(S.tenure_months("a2", anchor)).first()[0]
    exact = (anchor - datetime(2019, 10, 1, 6, 30, 15, 250000)).total_seconds() / 2629746.0
    assert months == pytest.approx(exact, abs=1e-12)


def test_new_company_missing_is_zero(spark):
    df = spark.createDataFrame([(6,), (7,), (None,), (-1,)], "months_since_sign_up2 int")
    assert [r.new_company for r in A.new_company(df).collect()] == [1, 0, 0, 1]


def test_yearmon_is_not_padded(spark):
    df = T.accounts(spark, [(1, "2021-09-30", 1, 0), (1, "2021-12-01", 2, 0)])
    assert [r[0] for r in df.selectExpr(S.yearmon("a2")).collect()] == ["2021-9", "2021-12"]


def test_uplift_only_for_levy_accounts_of_its_months(spark):
    df = T.accounts(
        spark, [(1, "2021-12-05", 1, 0), (0, "2021-12-05", 2, 0), (1, "2022-01-05", 3, 0)]
    ).withColumn("total_commitments", F.lit(10))
    got = C.uplift(df, Rules().uplift)
    assert [r.adjusted_commitments for r in got.orderBy("a3").collect()] == [
        pytest.approx(117.8),
        10.0,
        10.0,
    ]


def test_constant_columns(spark):
    df = spark.createDataFrame(
        [(1, 5, None, "a", None), (2, 5, None, None, 1.0), (3, 5, None, "a", 1.0)],
        "k int, same int, missing int, mixed string, partly double",
    )
    assert E.drop_constant(df, protect=["k"]).columns == ["k", "mixed", "partly"]
    profile = {r["column"]: r.distinct_values for r in E.column_profile(df).collect()}
    assert profile == {"k": 3, "same": 1, "missing": 1, "mixed": 2, "partly": 2}


def test_one_hot_of_any_text(spark):
    quoted = spark.createDataFrame([("it's",), ("b\\c",), (None,)], "v string")
    hot = E.one_hot(quoted, "v", "v")
    assert [tuple(r)[1:] for r in hot.collect()] == [(0, 1), (1, 0), (0, 0)]


def test_restriction_to_ids(spark):
    rows = [(a, "2018-06-01", "1", 0, None, None, None) for a in range(50)]
    b = T.commitments(spark, rows)
    ids = spark.createDataFrame([(i,) for i in range(0, 50, 7)], "a3 bigint")
    few = C.commitment_features(b, [YEAR], ids)
    every = C.commitment_features(b, [YEAR]).where("a3 % 7 = 0")
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, every.collect()))
    assert few.count() == 8
