"""The four source tables derived from the driver tables, and date-shifted settings.

The driver's dates run 22 years before the library's default windows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.cohorts import TRAINING_COHORTS, rolling_cohort, shift_cohorts
from cohortloom.operators.sampling import year_strata
from cohortloom.rules import Rules
from cohortloom.sources import tables as T

YEARS = -22
COHORTS = shift_cohorts(TRAINING_COHORTS, YEARS)
RULES = Rules().shift(YEARS)
STRATA = year_strata(2017 + YEARS, 2022 + YEARS)
EARLY_CUTOFF = date(1995, 7, 1)
SCHEME_CUTOFF = date(2000, 1, 1)
AS_OF = date(2001, 7, 1)
AS_OF_COHORT = rolling_cohort(AS_OF, compat=True)
AS_OF_START = rolling_cohort(AS_OF)
SEED = 42
MAP_SIZE = 514


# Columns used here, declared so that no file is opened to find the schema.
DRIVER_COLUMNS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,"
    " o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_returnflag STRING",
    "part": "p_partkey BIGINT, p_size INT",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _day(base: str, offset: str) -> str:
    return f"DATE '{base}' + CAST({offset} AS INT)"


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.as_accounts(
        load(spark, sf_dir, "customer").selectExpr(
            "CASE WHEN c_nationkey % 3 = 0 THEN 0 ELSE 1 END AS a1",
            f"{_day('1995-01-01', '(c_custkey * 37) % 2400')} AS a2",
            "c_custkey AS a3",
            "CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS a7",
        )
    )


def commitments(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    parts = load(spark, sf_dir, "part")
    day = "CAST(o_orderdate AS DATE)"
    return T.as_commitments(
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            "o_custkey AS b10",
            "o_orderdate AS b2",
            "CASE WHEN p_size > 45 THEN NULL ELSE CAST(p_size AS STRING) END AS b6",
            "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS b12",
            f"CASE WHEN o_orderstatus = 'P' THEN {day} + CAST(o_orderkey % 300 AS INT) END AS b16",
            f"{day} + 365 AS b17",
            f"CASE WHEN o_orderstatus = 'F' THEN {day} + CAST(365 + o_orderkey % 60 AS INT) END"
            " AS b20",
        )
    )


COMPANY_TYPES = "Company Friendly Individual LLP Partnership Sole Exempt".split()


def schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = "".join(f" WHEN {i} THEN '{name}'" for i, name in enumerate(COMPANY_TYPES))
    started = _day("1975-01-01", "(c_custkey * 53) % 7000")
    return T.as_schemes(
        load(spark, sf_dir, "customer").selectExpr(
            "c_name AS d3",
            f"CASE WHEN c_custkey % 11 <> 0 THEN {started} END AS d6",
            "1 + c_nationkey % 4 AS d8",
            "CASE WHEN c_custkey % 5 <> 0 THEN CAST(floor(abs(c_acctbal) * 3) AS INT) END AS d10",
            f"CASE c_nationkey % 8{types} END AS d12",
            "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN -1"
            " ELSE c_custkey - c_custkey % 2 END AS d15",
        )
    )


def code_pairs(spark: SparkSession) -> DataFrame:
    """A rule in place of the published code table: 514 old codes, several per new code."""
    return spark.range(MAP_SIZE).select(
        F.col("id").alias("idx"),
        F.expr("lpad(CAST(111 + id * 19 AS STRING), 4, '0')").alias("old_code"),
        F.expr(
            "lpad(CAST(1000 * (1 + (id * 193) % 99) + 10 * (id % 5) AS STRING), 5, '0')"
        ).alias("new_code"),
    )


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.broadcast(code_pairs(spark))  # MAP_SIZE rows
    return T.as_register(
        load(spark, sf_dir, "customer")
        .select("c_name", "c_custkey", "c_mktsegment")
        .join(pairs, F.expr(f"c_custkey % {MAP_SIZE} = idx"))
        .select(
            F.col("c_name").alias("i1"),
            F.expr(
                "CASE WHEN c_custkey % 13 = 0 THEN NULL"
                " WHEN c_custkey % 3 = 0 THEN CONCAT(new_code, ' Trade in ', c_mktsegment)"
                " ELSE CONCAT(old_code, ' Trade in ', c_mktsegment) END"
            ).alias("i4"),
        )
    )


def tables(spark: SparkSession, sf_dir: str) -> T.SourceTables:
    return T.SourceTables(
        accounts(spark, sf_dir),
        commitments(spark, sf_dir),
        schemes(spark, sf_dir),
        register(spark, sf_dir),
    )
