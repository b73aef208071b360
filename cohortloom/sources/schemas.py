"""Declared schemas of the four source tables.

Timestamps are kept without a zone, so dates taken from them do not depend on the session.
"""

from __future__ import annotations

from pyspark.sql import types as T

ACCOUNTS = T.StructType(
    [
        T.StructField("a1", T.IntegerType(), False),  # levy flag, 0 or 1
        T.StructField("a2", T.TimestampNTZType(), False),  # account created
        T.StructField("a3", T.LongType(), False),  # account id
        T.StructField("a7", T.IntegerType(), True),  # sends levy to others
    ]
)

COMMITMENTS = T.StructType(
    [
        T.StructField("b2", T.TimestampNTZType(), False),  # commitment created
        T.StructField("b6", T.StringType(), True),  # occupation code
        T.StructField("b10", T.LongType(), False),  # account id
        T.StructField("b12", T.IntegerType(), True),  # paid by a transfer
        T.StructField("b16", T.TimestampNTZType(), True),  # closed early, first kind
        T.StructField("b17", T.TimestampNTZType(), True),  # planned end
        T.StructField("b20", T.TimestampNTZType(), True),  # closed early, second kind
    ]
)

SCHEMES = T.StructType(
    [
        T.StructField("d3", T.StringType(), True),  # company number
        T.StructField("d6", T.TimestampNTZType(), True),  # scheme start
        T.StructField("d8", T.IntegerType(), True),  # company status
        T.StructField("d10", T.IntegerType(), True),  # employees
        T.StructField("d12", T.StringType(), True),  # company type
        T.StructField("d15", T.LongType(), True),  # account id, -1 for none
    ]
)

REGISTER = T.StructType(
    [
        T.StructField("i1", T.StringType(), False),  # company number
        T.StructField("i4", T.StringType(), True),  # code, space, description
    ]
)
