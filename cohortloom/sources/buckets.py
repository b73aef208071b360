"""Source tables stored by account: bucketed and sorted on the key that every join uses.

Written once, the tables lie as the joins need them: accounts by ``a3``, commitments by their owner
``b10``, schemes by ``d15``, all in the same number of buckets. Aggregations by account and joins
between them then read their bucket and shuffle nothing, nor does a join by account and cohort,
since rows that lie by account lie by both. The register has no account and stays plain.

A bucket is read by one task, so an account with a large part of all commitments makes one task
long: where one account holds more than a task can read, use the plain tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources.tables import (
    TABLES,
    ParquetSource,
    SourceTables,
    as_accounts,
    as_commitments,
    as_register,
    as_schemes,
)

BUCKET_KEYS: Mapping[str, str] = {"pt_a": "a3", "pt_b": "b10", "pt_d": "d15"}
#: Rows that lie by one key of a join lie by all of its keys.
LAYOUT_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def store_bucketed(tables: SourceTables, root: str, buckets: int) -> None:
    """Write the tables below ``root``, one file for each bucket."""
    spark = tables.accounts.sparkSession
    by_name = {"pt_a": tables.accounts, "pt_b": tables.commitments, "pt_d": tables.schemes}
    for name, df in by_name.items():
        key = BUCKET_KEYS[name]
        table = _table_name()
        dealt = df.repartition(buckets, F.col(key))
        writer = dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{root}/{name}").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay: the table is external
    tables.register.write.parquet(f"{root}/pt_i")


def read_bucketed(spark: SparkSession, root: str, buckets: int) -> SourceTables:
    """The tables as ``store_bucketed`` wrote them, with their layout made known to the session."""
    for key, value in LAYOUT_CONF.items():
        spark.conf.set(key, value)
    loaded = {name: _bucketed(spark, f"{root}/{name}", name, buckets) for name in BUCKET_KEYS}
    return SourceTables(
        as_accounts(loaded["pt_a"]),
        as_commitments(loaded["pt_b"]),
        as_schemes(loaded["pt_d"]),
        as_register(ParquetSource(root).load(spark, "pt_i")),
    )


def _table_name() -> str:
    return f"cohortloom_{uuid.uuid4().hex}"


def _bucketed(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    table, key = _table_name(), BUCKET_KEYS[name]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[name])
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'"
        f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
    )
    return spark.table(table)
