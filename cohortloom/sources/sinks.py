"""Predictions and models on shared storage."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.boosting import BoostedModel, Column, from_nodes, stored_nodes

MODELS = (
    "version string, features array<string>, base double, objective string,"
    " columns array<struct<name string, labels array<string>>>"
)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", mode: str = "error") -> None:
    """One file per partition: CSV with a header, or Parquet. No index column."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}: use 'csv' or 'parquet'")


def write_day(df: DataFrame, path: str, day: date, fmt: str = "parquet") -> None:
    """Predictions of a scoring day, in a partition ``as_of`` of their own.

    Written again, a day replaces itself and leaves the others; the new files take the place of
    the old when all are written, so a run that fails leaves what there was. No rows at all replace
    nothing.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}: use 'csv' or 'parquet'")
    rows = df.withColumn("as_of", F.lit(day))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.partitionBy("as_of").format(fmt).save(path)


def check_free(spark: SparkSession, path: str) -> None:
    """Raise if something is at the path already, in whatever store it names."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return
        raise
    raise FileExistsError(path)


def save_model(model: BoostedModel, features: Sequence[str], path: str) -> str:
    """A new version of the model: its nodes as a table, then one row that names the version.

    The row is written last, so a version that was not written whole is none, and the versions
    before it stay as they were.
    """
    spark = SparkSession.active()
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    stored_nodes(spark, model).coalesce(1).write.parquet(f"{path}/versions/{version}")
    columns = [(c.name, list(c.labels) if c.nominal else None) for c in model.columns]
    row = (version, list(features), model.base, model.objective, columns)
    spark.createDataFrame([row], MODELS).coalesce(1).write.mode("append").parquet(f"{path}/models")
    return version


def model_versions(spark: SparkSession, path: str) -> DataFrame:
    """A row for each version written whole, of MODELS; versions sort by time."""
    return spark.read.schema(MODELS).parquet(f"{path}/models")


def load_model(path: str, version: str | None = None) -> tuple[BoostedModel, list[str]]:
    """The latest version, or the one named, and its feature list (as long as it is wide)."""
    spark = SparkSession.active()
    versions = model_versions(spark, path)
    if version is not None:
        versions = versions.where(F.col("version") == version)
    row = versions.orderBy(F.desc("version")).first()
    if row is None:
        raise LookupError(f"no version {version} in {path}")
    columns = [
        Column(c["name"], labels=None if c["labels"] is None else tuple(c["labels"]))
        for c in row["columns"]
    ]
    nodes = spark.read.parquet(f"{path}/versions/{row['version']}").collect()
    return from_nodes(nodes, columns, row["base"], row["objective"]), row["features"]
