"""The sweep and the kept roll-up give what the scan gives; a scoring day replaces itself."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import catalog
from checks import tables as T
from cohortloom.cohorts import rolling_cohort
from cohortloom.operators import commitments as C
from cohortloom.operators import sweep as W
from cohortloom.sources import write_day

LIVE_NOW = [rolling_cohort(date(1996 + i, 3, 2), compat=True) for i in range(3)]
SCHEMA = (
    "b2 timestamp_ntz, b6 string, b10 bigint, b12 int, b16 timestamp_ntz, b17 timestamp_ntz,"
    " b20 timestamp_ntz"
)


def rows_of(df):
    names = ["a3", "cohort", *C.feature_columns()]
    return sorted(map(tuple, df.select(*names).collect()))


def scanned(b, cohorts, **kw):
    found = C.commitment_features(b, cohorts, **kw)
    return rows_of(found.withColumnRenamed(found.columns[0], "a3"))


@pytest.mark.parametrize(
    "cohorts",
    [T.COHORTS, catalog.MONTHS, LIVE_NOW, [*T.COHORTS, T.AS_OF_COHORT, *LIVE_NOW]],
    ids=["three", "months", "live at another day", "bounds that move back"],
)
def test_equal_to_the_scan(spark, sf_dir, cohorts):
    b = T.commitments(spark, sf_dir)
    # labels differ, so that rows of equal windows stay apart
    expected = scanned(b, cohorts)
    assert expected and rows_of(W.swept_features(W.day_rows(b), cohorts)) == expected
    assert rows_of(W.swept_features(W.roll_up(b), cohorts)) == expected


def test_switches(spark, sf_dir):
    b = T.commitments(spark, sf_dir)
    ids = T.accounts(spark, sf_dir).where("a3 % 3 = 0").select("a3")
    kw = {"ids": ids, "codes": ("1", "2"), "null_share": "equals_null"}
    names = ["a3", "cohort", *C.feature_columns(("1", "2"))]
    swept = W.swept_features(W.day_rows(b), T.COHORTS, **kw).select(*names)
    plain = C.commitment_features(b, T.COHORTS, **kw)
    plain = plain.withColumnRenamed(plain.columns[0], "a3").select(*names)
    assert sorted(swept.collect()) == sorted(plain.collect()) != []


def edge_rows():
    """Days on every bound and beside it, missing days, closed before created, repeats."""
    bounds = [d for c in T.COHORTS for d in (c.prev_start, c.start, c.end)]
    days = [None, date(1980, 1, 1), date(2030, 1, 1)]
    days += [date.fromordinal(d.toordinal() + k) for d in bounds for k in (-1, 0, 1)]
    times = [d and datetime(d.year, d.month, d.day, 13) for d in days]
    out = []
    for i, created in enumerate(times):
        for j, closed in enumerate(times):
            planned = times[(i + 5 * j) % len(times)]
            other = times[(3 * i + j) % len(times)] if i % 3 else None
            code = [None, "1", "24", "x"][(i + j) % 4]
            out.append((created, code, (i * j) % 4, [None, 0, 1][j % 3], closed, planned, other))
    return [*out, *out[:40], (None, None, None, None, None, None, None)]


def test_edges(spark):
    b = spark.createDataFrame(edge_rows(), SCHEMA)
    cohorts = [*T.COHORTS, T.AS_OF_COHORT]
    assert rows_of(W.swept_features(W.day_rows(b.where("b10 IS NOT NULL")), cohorts)) == scanned(
        b.where("b10 IS NOT NULL"), cohorts
    )
    assert rows_of(W.swept_features(W.day_rows(b.limit(0)), cohorts)) == []


def test_batches(spark, sf_dir, tmp_path):
    """Late rows, a batch that is written again, and commitments that have changed."""
    b, path = T.commitments(spark, sf_dir), str(tmp_path / "rolled")
    part = F.pmod(F.xxhash64("b10", "b2"), F.lit(3))
    W.append_batch(b.where(part == 0), path, "monday")
    W.append_batch(b.where(part == 1), path, "tuesday")
    assert rows_of(W.swept_features(W.read_roll_up(spark, path), T.COHORTS)) == scanned(
        b.where(part < 2), T.COHORTS
    )
    for _ in range(2):
        W.append_batch(b.where(part != 1), path, "monday")  # again, with rows that came late
    assert rows_of(W.swept_features(W.read_roll_up(spark, path), T.COHORTS)) == scanned(b, T.COHORTS)

    W.append_batch(b.limit(0), path, "tuesday")  # again, and empty
    assert rows_of(W.swept_features(W.read_roll_up(spark, path), T.COHORTS)) == scanned(
        b.where(part != 1), T.COHORTS
    )
    W.append_batch(b.where(part == 1), path, "tuesday")

    closing = F.lit(datetime(1997, 1, 1)).cast("timestamp_ntz")
    open_ = F.coalesce((part == 0) & F.col("b16").isNull(), F.lit(False))
    changed = b.withColumn("b16", F.when(open_, closing).otherwise(F.col("b16")))
    W.append_batch(b.where(open_), path, "wednesday, out", sign=-1)
    W.append_batch(changed.where(open_ | (F.lit(False))).limit(0), path, "none")
    W.append_batch(b.where(open_).withColumn("b16", closing), path, "wednesday")
    found = W.swept_features(W.read_roll_up(spark, path), T.COHORTS)
    assert rows_of(found) == scanned(changed, T.COHORTS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rolled" in plan and "pt_b" not in plan and "lineitem" not in plan


def test_roll_up_is_smaller_than_its_rows(spark):
    row = (datetime(1996, 5, 1, 9), "1", 7, 0, None, None, None)
    b = spark.createDataFrame([row] * 500, SCHEMA)
    assert W.roll_up(b).count() == 2  # as created, and as live
    assert W.roll_up(b).agg(F.max("n")).first()[0] == 500


def test_chains_keep_bounds_in_order():
    runs = W.chains([*T.COHORTS, T.AS_OF_COHORT, *LIVE_NOW])
    assert sum(map(len, runs)) == 7
    for run in runs:
        for a, b in zip(run, run[1:]):
            assert all((getattr(a, n) or date.max) <= (getattr(b, n) or date.max) for n in W.BOUNDS)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_scoring_days(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    schema = "account_id bigint, levy_model_prediction double"

    def predictions(*values):
        return spark.createDataFrame(list(enumerate(values)), schema)

    def stored():
        df = spark.read.schema(f"{schema}, as_of date").option("header", True).format(fmt).load(path)
        return sorted((r.as_of.day, r.account_id, r.levy_model_prediction) for r in df.collect())

    write_day(predictions(1.0, 2.0, 3.0), path, date(2001, 7, 1), fmt)
    assert stored() == [(1, 0, 1.0), (1, 1, 2.0), (1, 2, 3.0)]
    write_day(predictions(4.0), path, date(2001, 7, 1), fmt)
    assert stored() == [(1, 0, 4.0)]
    write_day(predictions(5.0), path, date(2001, 7, 2), fmt)
    assert stored() == [(1, 0, 4.0), (2, 0, 5.0)]
    torn = predictions(6.0, 7.0).withColumn(
        "levy_model_prediction",
        F.when(F.col("account_id") == 1, F.raise_error(F.lit("lost")).cast("double")).otherwise(8.0),
    )
    with pytest.raises(Exception, match="lost"):
        write_day(torn, path, date(2001, 7, 1), fmt)
    assert stored() == [(1, 0, 4.0), (2, 0, 5.0)]
    with pytest.raises(ValueError, match="unknown format"):
        write_day(predictions(1.0), path, date(2001, 7, 1), "xml")


def test_tasks_grow_with_the_rows(spark, sf_dir, monkeypatch):
    b = T.commitments(spark, sf_dir).where("b10 < 40")
    expected = scanned(b, T.COHORTS)
    rows = W.day_rows(b)
    n = rows.count()
    monkeypatch.setattr(W, "TASK_ROWS", n // 9, raising=False)
    rolled = W.roll_up(b)
    assert rolled.rdd.getNumPartitions() >= 9
    # an account's rows are counted by many tasks
    owners = rolled.withColumn("task", F.spark_partition_id()).groupBy("b10")
    assert all(r[1] > 1 for r in owners.agg(F.count_distinct("task")).collect())
    swept = W.swept_features(rows, T.COHORTS)
    assert swept.rdd.getNumPartitions() >= 9
    assert rows_of(swept) == expected != []
