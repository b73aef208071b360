"""Session set-up and cluster-owned settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine's settings; cluster sizing stays with spark-submit.

    Shuffle partition counts are not pinned here: adaptive execution coalesces from
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` where the cluster sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, or None."""
    return spark.conf.get("spark.checkpoint.dir", None)


def use_checkpoints(spark: SparkSession) -> bool:
    """Whether the context has a checkpoint folder, taking it from the session's setting."""
    sc = spark.sparkContext
    folder = shared_dir(spark)
    if sc.getCheckpointDir() is None and folder is not None:
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() is not None


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame computed once, for plans that go on to read it many times.

    With a shared folder it is written there as a table, which outlives lost executors and is
    read back by column. Without one a local run caches it; on a cluster that is an error.
    """
    spark = df.sparkSession
    if not use_checkpoints(spark):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        return df.persist()
    return _written(df, shared_dir(spark) or spark.sparkContext.getCheckpointDir(), "frame")


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder; a temporary one only on a local master."""
    spark = df.sparkSession
    folder = shared_dir(spark) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.gettempdir()
    return _written(df, folder, name)


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
