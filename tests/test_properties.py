"""Properties that hold whatever the data."""

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from checks.oracle import SHARES
from cohortloom.functions import scalars as S
from cohortloom.operators import accounts as A
from cohortloom.operators import commitments as C
from cohortloom.operators import encoding as E
from cohortloom.operators import sampling as M
from cohortloom.plans import features as PF


def test_sample_is_bounded_and_repeats(spark, sf_dir):
    accounts = T.accounts(spark, sf_dir)
    first = {r.a3 for r in M.sample_stratified(accounts, T.STRATA, 3, 1).collect()}
    again = {r.a3 for r in M.sample_stratified(accounts.repartition(5), T.STRATA, 3, 1).collect()}
    other = {r.a3 for r in M.sample_stratified(accounts, T.STRATA, 3, 2).collect()}
    assert first == again != other
    assert len(first) <= 3 * len(T.STRATA)
    picked = accounts.where(F.col("a3").isin(list(first)))
    per_stratum = Counter(r._stratum for r in M.assign_strata(picked, T.STRATA).collect())
    assert set(per_stratum) == set(range(len(T.STRATA)))


def test_shares_sum_to_at_most_one(spark, sf_dir):
    shares = C.mix_share(T.commitments(spark, sf_dir), T.COHORTS)
    total = sum((F.col(c) for c in SHARES[1:]), F.col(SHARES[0]))
    highest = shares.agg(F.max(total)).first()[0]
    assert 0 < float(highest) <= 1.001 + 0.001 * len(SHARES)


@pytest.mark.parametrize("base", ["e"])
def test_inverse_undoes_the_target(spark, base):
    df = spark.range(0, 100_000, 997)
    back = S.inverse_target(S.log_target("id"), base)
    assert df.selectExpr(f"max(abs({back} - id)) AS gap").first().gap < 1e-6


def test_one_hot_rows_sum_to_one_or_zero(spark, sf_dir):
    letters = T.schemes(spark, sf_dir).selectExpr("d3", f"{S.type_letter('d12')} AS letter")
    hot = E.one_hot(letters, "letter", "h")
    added = [c for c in hot.columns if c.startswith("h_")]
    sums = hot.selectExpr("letter", f"{' + '.join(added)} AS total").distinct().collect()
    assert {(r.letter is None, r.total) for r in sums} <= {(False, 1), (True, 0)}


def test_aligned_columns_equal_the_list(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int")
    aligned = E.align(df, ["z", "b", "a"], keep=["a"])
    assert aligned.frame.columns == ["a", "z", "b", "a"]
    assert aligned.filled == ["z"]
    assert tuple(aligned.frame.first()) == (1, 0, 2, 1)


def test_lookback_features_never_use_later_rows(spark, sf_dir):
    """Moving every row dated on or after a window's start leaves its look-back as it was."""
    cohort = T.COHORTS[1]
    b = T.commitments(spark, sf_dir)
    later = F.col("b2") >= F.lit(cohort.start)
    moved = b.withColumn(
        "b2", F.when(later, F.col("b2") + F.lit(timedelta(days=91))).otherwise(F.col("b2"))
    )
    columns = ["a3", *SHARES, "prev_12m_new_commitments", "prev_12m_new_levy_transfers",
               "current_live_commitments"]

    def lookback(rows):
        features = C.commitment_features(rows, [cohort]).select(columns)
        return Counter(map(tuple, features.where("prev_12m_new_commitments > 0").collect()))

    assert lookback(b) == lookback(moved)


def test_cohorts_do_not_depend_on_each_other(spark, sf_dir):
    """Twelve cohorts in one pass give what each gives alone."""
    b = T.commitments(spark, sf_dir)
    many = [c.shift(k) for c in T.COHORTS for k in (0,)] + [T.COHORTS[0].shift(k) for k in (2, 4)]
    together = C.commitment_features(b, many).cache()
    for cohort in many:
        alone = C.commitment_features(b, [cohort])
        counted = "total_commitments + prev_12m_new_commitments + commitments_ending_12m > 0"
        left = together.where(F.col("cohort") == cohort.label).where(counted)
        assert Counter(map(tuple, left.collect())) == Counter(
            map(tuple, alone.where(counted).collect())
        )


def test_split_shares_and_account_key(spark, sf_dir):
    grown = A.rename_features(A.expand_cohorts(T.accounts(spark, sf_dir), T.COHORTS))
    train, test = M.hash_split(grown, seed=3)
    assert train.count() + test.count() == grown.count()
    assert 0.1 < test.count() / grown.count() < 0.4
    train, test = M.hash_split(grown, ["account_id"], seed=3)
    assert train.join(test, "account_id").isEmpty()


def test_hot_account_gives_the_same_features(spark, sf_dir):
    """One account with a third of all rows."""
    b = T.commitments(spark, sf_dir)
    hot = b.withColumn("b10", F.when(F.rand(1) < 0.33, F.lit(7)).otherwise(F.col("b10"))).cache()
    frame = PF.cohort_frame(T.accounts(spark, sf_dir), hot, T.COHORTS)
    got = {r.cohort: r.total_commitments for r in frame.where("a3 = 7").collect()}
    for cohort in T.COHORTS:
        counted = hot.where("b10 = 7").where(C.in_target(cohort)).count()
        account = T.accounts(spark, sf_dir).where("a3 = 7").first()
        if account.a1 == 1 and account.a2.date() < cohort.start:
            assert got[cohort.label] == counted
