"""What several corpus operators share: tables, the shared folder, text in SQL functions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import shared_dir

#: Rows of whole texts that Python and the buffers before it hold at once.
TEXT_ROWS = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share; a temporary one only on a local master."""
    root = shared_dir(spark) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as a table in the shared folder, and read back from there."""
    return written(df, shared_path(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    """The frame written once as a table, and read back from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a table that was written, or a folder of them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """While it lasts, shuffle files go as soon as what needed them is written or collected."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, what is computed sends Python batches of at most ``TEXT_ROWS`` rows."""
    before = spark.conf.get(BATCH_ROWS)
    if not 0 < int(before) <= TEXT_ROWS:
        spark.conf.set(BATCH_ROWS, str(TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, what is computed sends Python batches of at most so many rows."""
    before = spark.conf.get(BATCH_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
