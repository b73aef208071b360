"""Small hand-written source tables."""

from datetime import datetime

from cohortloom.sources import as_accounts, as_commitments, as_register, as_schemes


def ts(text):
    return None if text is None else datetime.fromisoformat(text)


def accounts(spark, rows):
    """(a1, a2, a3, a7)"""
    rows = [(a1, ts(a2), a3, a7) for a1, a2, a3, a7 in rows]
    schema = "a1 int, a2 timestamp_ntz, a3 bigint, a7 int"
    return as_accounts(spark.createDataFrame(rows, schema))


def commitments(spark, rows):
    """(b10, b2, b6, b12, b16, b17, b20)"""
    rows = [(o, ts(b2), b6, b12, ts(b16), ts(b17), ts(b20)) for o, b2, b6, b12, b16, b17, b20 in rows]
    schema = (
        "b10 bigint, b2 timestamp_ntz, b6 string, b12 int, b16 timestamp_ntz,"
        " b17 timestamp_ntz, b20 timestamp_ntz"
    )
    return as_commitments(spark.createDataFrame(rows, schema))


def schemes(spark, rows):
    """(d3, d6, d8, d10, d12, d15)"""
    rows = [(d3, ts(d6), d8, d10, d12, d15) for d3, d6, d8, d10, d12, d15 in rows]
    schema = "d3 string, d6 timestamp_ntz, d8 int, d10 int, d12 string, d15 bigint"
    return as_schemes(spark.createDataFrame(rows, schema))


def register(spark, rows):
    return as_register(spark.createDataFrame(rows, "i1 string, i4 string"))


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}
