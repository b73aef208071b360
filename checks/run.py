"""Run registered queries against their SQL: ``python -m checks.run [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from cohortloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def local_session(cores: str = "8") -> SparkSession:
    spark = build_session(
        "checks",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return sorted(df.columns), Counter(
        tuple(_cell(row[i]) for i in order) for row in df.collect()
    )


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(
        tuple(_cell(row[i]) for i in order) for row in cursor.fetchall()
    )


def difference(spark: SparkSession, con, query, sql: str, sf_dir: str) -> str | None:
    """None if the query and the SQL give the same columns and rows, else what differs."""
    names, got = spark_rows(query(spark, sf_dir))
    expected_names, expected = sql_rows(con, sql)
    if names != expected_names:
        return f"columns {sorted(set(names) ^ set(expected_names))}"
    if got != expected:
        return (
            f"rows {got.total()} / {expected.total()};"
            f" only here {list((got - expected))[:2]}; only there {list((expected - got))[:2]}"
        )
    return None


def main(args: list[str]) -> int:
    from checks.catalog import ORACLES, QUERIES

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con = local_session(), oracle(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, con, QUERIES[name], ORACLES[name], sf_dir)
                state = "equal" if problem is None else f"DIFFERENT {problem}"
            else:
                problem, state = None, f"rows {len(QUERIES[name](spark, sf_dir).collect())}"
        except Exception as error:  # report and go on with the next query
            problem = state = f"ERROR {str(error)[:600]}"
        failed += problem is not None
        print(f"## {name}: {state} ({time.time() - start:.1f} s)", flush=True)
    print(f"## {len(names)} queries, {failed} failed")
    return min(failed, 1)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
