"""The four source tables, typed as declared in ``schemas``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortloom.sources import schemas
from cohortloom.sources.database import QUERY_TIMEOUT, KeyCuts, KeyRange, read_query


@dataclass(frozen=True)
class ParquetSource:
    """Folder with one Parquet table per source table."""

    root: str
    names: Mapping[str, str] | None = None

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        name = (self.names or {}).get(table, table)
        return spark.read.parquet(f"{self.root.rstrip('/')}/{name}")


@dataclass(frozen=True)
class DatabaseSource:
    """Database with one table per source table; ``splits`` makes a table's read parallel."""

    url: str
    names: Mapping[str, str]
    splits: Mapping[str, KeyRange | KeyCuts]
    timeout: int = QUERY_TIMEOUT
    properties: Mapping[str, str] | None = None

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        columns = ", ".join(field.name for field in TABLES[table])
        return read_query(
            spark,
            self.url,
            f"SELECT {columns} FROM {self.names.get(table, table)}",
            self.timeout,
            self.splits.get(table),
            self.properties,
        )


TABLES = {
    "pt_a": schemas.ACCOUNTS,
    "pt_b": schemas.COMMITMENTS,
    "pt_d": schemas.SCHEMES,
    "pt_i": schemas.REGISTER,
}


@dataclass(frozen=True)
class SourceTables:
    accounts: DataFrame
    commitments: DataFrame
    schemes: DataFrame
    register: DataFrame


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema])


def as_accounts(df: DataFrame) -> DataFrame:
    return _typed(df, schemas.ACCOUNTS)


def as_commitments(df: DataFrame) -> DataFrame:
    return _typed(df, schemas.COMMITMENTS)


def as_schemes(df: DataFrame) -> DataFrame:
    return _typed(df, schemas.SCHEMES)


def as_register(df: DataFrame) -> DataFrame:
    return _typed(df, schemas.REGISTER)


def read_accounts(spark: SparkSession, src: ParquetSource | DatabaseSource) -> DataFrame:
    return as_accounts(src.load(spark, "pt_a"))


def read_commitments(spark: SparkSession, src: ParquetSource | DatabaseSource) -> DataFrame:
    return as_commitments(src.load(spark, "pt_b"))


def read_schemes(spark: SparkSession, src: ParquetSource | DatabaseSource) -> DataFrame:
    return as_schemes(src.load(spark, "pt_d"))


def read_register(spark: SparkSession, src: ParquetSource | DatabaseSource) -> DataFrame:
    return as_register(src.load(spark, "pt_i"))


def read_tables(spark: SparkSession, src: ParquetSource | DatabaseSource) -> SourceTables:
    return SourceTables(
        read_accounts(spark, src),
        read_commitments(spark, src),
        read_schemes(spark, src),
        read_register(spark, src),
    )
