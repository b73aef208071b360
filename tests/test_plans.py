"""Physical plans: scans, shuffles, joins and filters that must stay as they are."""

import re

import pytest

from checks import catalog
from checks import tables as T
from checks.catalog import MONTHS
from cohortloom.operators import commitments as C
from cohortloom.operators import sampling as M
from cohortloom.operators import sweep as W
from cohortloom.plans import features as PF
from cohortloom.plans import scoring as PS
from cohortloom.plans import training as PT
from cohortloom.sources import ParquetSource, read_bucketed, read_tables, store_bucketed


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """The source tables as Parquet, so that plans show their scans."""
    root = str(tmp_path_factory.mktemp("tables"))
    derived = T.tables(spark, sf_dir)
    derived.accounts.write.parquet(f"{root}/pt_a")
    derived.commitments.write.parquet(f"{root}/pt_b")
    derived.schemes.write.parquet(f"{root}/pt_d")
    derived.register.write.parquet(f"{root}/pt_i")
    return read_tables(spark, ParquetSource(root))


@pytest.fixture
def static_plans(spark):
    """Plans as for large inputs: nothing small enough to be broadcast by its size."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, table):
    return len(re.findall(rf"FileScan parquet \[[^\]]*\][^\n]*/{table}\]", text))


def test_commitments_are_scanned_and_shuffled_once(static_plans, tables):
    text = plan(C.commitment_features(tables.commitments, T.COHORTS))
    assert scans(text, "pt_b") == 1
    assert text.count("Exchange") == 1
    assert "partial_count" in text
    assert "SortAggregate" not in text


def test_cohort_frame_shuffles_each_side_once(static_plans, tables):
    text = plan(PF.cohort_frame(tables.accounts, tables.commitments, T.COHORTS))
    assert scans(text, "pt_b") == 1 and scans(text, "pt_a") == 1
    assert text.count("Exchange") == 2


def test_filters_and_columns_reach_the_scan(static_plans, tables):
    text = plan(C.count_in_window(tables.commitments, T.COHORTS[:1], "prev_start", "start"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(b2,1995-04-01T00:00)" in scan
    assert "LessThan(b2,1996-04-01T00:00)" in scan
    assert "b17" not in scan.split("ReadSchema")[1]


@pytest.mark.parametrize("n", [2, 5000])
def test_sample_ranks_inside_ranges(static_plans, tables, n):
    text = plan(M.sample_stratified(tables.accounts, T.STRATA, n, 1))
    assert "hashpartitioning(_stratum#" in text and "_range#" in text
    ranking = next(line for line in text.splitlines() if "row_number()" in line)
    assert re.search(r"\[_stratum#\d+, _range#\d+\]", ranking)


def test_training_frame_plan(spark, static_plans, tables):
    frame = PT.raw_training_frame(
        tables, T.COHORTS, T.STRATA, settings=catalog.settings(spark, industry=True)
    )
    text = plan(frame)
    assert scans(text, "pt_b") == 1 and scans(text, "pt_a") == 1
    # Only the code map (four-digit keys) is broadcast when tables are large.
    assert text.count("BroadcastExchange") == 1
    assert text.count("BroadcastHashJoin") == 1


def test_small_sample_is_broadcast_to_the_scan(spark, static_plans, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    frame = PT.raw_training_frame(
        tables, T.COHORTS, T.STRATA, n=2, settings=catalog.settings(spark)
    )
    text = plan(frame)
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert scans(text, "pt_b") == 1


def test_scoring_frame_plan(spark, static_plans, tables):
    text = plan(PS.score_frame(tables, T.AS_OF, settings=catalog.settings(spark)))
    assert scans(text, "pt_b") == 1 and scans(text, "pt_a") == 1
    assert "BroadcastExchange" not in text


CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("PythonUDF", "EvalPython", "InPandas", "InArrow")
LAZY = sorted(set(catalog.ORACLES) - {"sink_predictions", "drop_constant_columns"})
# Trees are walked in Arrow batches.
MODEL = {"train_regressor", "predict", "train_pipeline", "feature_contributions", "model_load"}


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_or_python(spark, static_plans, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    forbidden = CROSS if name in MODEL else CROSS + PYTHON
    assert not [word for word in forbidden if word in text]


def test_bucketed_tables_are_joined_without_a_shuffle(spark, static_plans, sf_dir, tmp_path):
    store_bucketed(T.tables(spark, sf_dir), str(tmp_path), 8)
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    try:
        stored = read_bucketed(spark, str(tmp_path), 8)
        frame = PF.cohort_frame(stored.accounts, stored.commitments, T.COHORTS)
        both = PF.account_features(
            stored, stored.accounts, T.COHORTS, settings=catalog.settings(spark)
        )
        for df in (frame, both):
            text = plan(df)
            assert "Exchange" not in text and "SortMergeJoin" in text and "Batched: true" in text
        plain = PF.account_features(
            T.tables(spark, sf_dir), T.accounts(spark, sf_dir), T.COHORTS,
            settings=catalog.settings(spark),
        )
        assert both.exceptAll(plain).isEmpty() and plain.exceptAll(both).isEmpty()
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", before)


def test_sweep_shuffles_events_whatever_the_cohorts(spark, static_plans, tables):
    for cohorts in (T.COHORTS, MONTHS):
        text = plan(W.swept_features(W.day_rows(tables.commitments), cohorts))
        assert scans(text, "pt_b") == 1 and "partial_sum" in text
        assert text.count("Exchange hashpartitioning") == 2  # by account and cohort, by account
        assert text.count("BroadcastExchange") == 2  # the calendar, by days of the span
