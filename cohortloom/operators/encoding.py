"""One-hot columns, alignment to a model's features, and column profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import scalars as S


def categories(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct values of a column that is to become columns, so as many as there will be."""
    found = df.where(F.col(col).isNotNull()).select(col).distinct().collect()
    return sorted(row[0] for row in found)


def one_hot(
    df: DataFrame,
    col: str,
    prefix: str,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """``<prefix>_<value>`` 0/1 per value; a missing value gives 0 in all of them."""
    values = categories(df, col) if values is None else values
    hot = [f"CAST({col} <=> {S.text(v)} AS INT) AS `{prefix}_{v}`" for v in values]
    return df.selectExpr("*", *hot)


@dataclass(frozen=True)
class Aligned:
    """Frame in model order; ``filled`` names the features it did not have (given as 0)."""

    frame: DataFrame
    filled: list[str]


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> Aligned:
    """Key columns, then exactly the model's features in the model's order."""
    filled = [f for f in features if f not in df.columns]
    frame = df.selectExpr(
        *[f"`{k}`" for k in keep],
        *[f"0 AS `{f}`" if f in filled else f"`{f}`" for f in features],
    )
    return Aligned(frame, filled)


def column_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column, where missing counts as one value.

    Columns are turned into (name, value) rows, so each value is reduced on its own task.
    """
    cols = list(cols or df.columns)
    pairs = [S.struct(column=S.text(c), value=f"CAST(`{c}` AS STRING)") for c in cols]
    return (
        df.selectExpr(f"inline(array({', '.join(pairs)}))")
        .groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count("*").alias("distinct_values"))
    )


def constant_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with a single value (all missing included).

    One value means equal minimum and maximum and no mix with NULL: a plain aggregate of one
    row, with none of the row expansion exact distinct counts need.
    """
    row = df.selectExpr(
        *[
            f"CASE WHEN count(`{c}`) = count(*) THEN min(`{c}`) = max(`{c}`)"
            f" ELSE count(`{c}`) = 0 END AS c{i}"
            for i, c in enumerate(cols)
        ]
    ).first()
    return [c for i, c in enumerate(cols) if row[i]]


def drop_constant(df: DataFrame, protect: Sequence[str] = ()) -> DataFrame:
    """Drop columns with a single value, never the protected ones (keys and target)."""
    candidates = [c for c in df.columns if c not in protect]
    return df.drop(*constant_columns(df, candidates)) if candidates else df
