"""The command-line jobs over source tables with the library's own dates."""

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from cohortloom.__main__ import run


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """The derived tables moved to the years the defaults are for."""
    root = str(tmp_path_factory.mktemp("source"))
    tables = T.tables(spark, "/root/testdata/sf0.01")

    def moved(df):
        dates = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns(
            {c: F.expr(f"{c} + make_ym_interval({-T.YEARS}, 0)") for c in dates}
        )

    for name, df in (
        ("pt_a", tables.accounts),
        ("pt_b", tables.commitments),
        ("pt_d", tables.schemes),
        ("pt_i", tables.register),
    ):
        moved(df).write.parquet(f"{root}/{name}")
    return root


@pytest.mark.parametrize("industry", [False, True])
def test_train_then_score(spark, source, tmp_path, industry):
    model, out = str(tmp_path / "model"), str(tmp_path / "out")
    extra = []
    if industry:
        path = tmp_path / "codes"
        T.code_pairs(spark).drop("idx").coalesce(1).write.option("header", True).csv(str(path))
        extra = ["--code-map", str(path)]
    base = ["--tables", source, "--model", model, *extra]
    trained = run(spark, ["train", *base, "--trees", "3", "--split-key", "account"])
    assert trained["rows"] > 0 and trained["features"] > 20
    done = run(spark, ["score", *base, "--as-of", "2023-07-01", "--out", out])
    assert done == {"out": out, "filled": []}
    scored = spark.read.option("header", True).csv(out)
    assert scored.count() == spark.read.parquet(f"{source}/pt_a").where("a1 = 1").count()
    few = str(tmp_path / "few")
    run(spark, ["score", *base, "--as-of", "2023-07-01", "--out", few, "--sample", "7",
                "--format", "parquet", "--compat"])
    assert spark.read.parquet(few).count() == 7
