"""Seeded samples and splits. Order is by md5(seed-key), the same on every run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import predicates as P
from cohortloom.functions import scalars as S

# Leading hex digits of the hash that cut one stratum into ranges: 16^3 = 4096.
RANGE_DIGITS = 3


@dataclass(frozen=True)
class Stratum:
    """Accounts created between two days (both in) with one levy flag."""

    low: date
    high: date
    levy: int


def year_strata(first: int, last: int) -> tuple[Stratum, ...]:
    """One stratum per year and levy flag; 1 January belongs to both of its years."""
    return tuple(
        Stratum(date(year, 1, 1), date(year + 1, 1, 1), levy)
        for year in range(first, last + 1)
        for levy in (1, 0)
    )


TRAINING_STRATA = year_strata(2017, 2022)


def inside(s: Stratum) -> str:
    return f"({P.between_incl('a2', s.low, s.high)} AND a1 = {s.levy})"


def assign_strata(df: DataFrame, strata: Sequence[Stratum]) -> DataFrame:
    """One row per account and stratum it falls in, numbered in ``_stratum``."""
    numbers = ", ".join(f"CASE WHEN {inside(s)} THEN {i} END" for i, s in enumerate(strata))
    members = df.where(P.any_of(map(inside, strata)))
    numbered = members.selectExpr("*", f"explode(array({numbers})) AS _stratum")
    return numbered.where("_stratum IS NOT NULL")


def _first_per_group(df: DataFrame, group: str, order: str, key: str, n: int) -> DataFrame:
    """The first n rows of each group by (hash, key).

    Ranking whole groups would pull them into single tasks. The hash is uniform, so its leading
    digits cut every group into even ranges: count them, find the range where n is reached, and
    rank only inside ranges. Ranges past n are left out before anything is shuffled.
    """
    ranked = df.selectExpr("*", f"{order} AS _order")
    ranged = ranked.withColumn("_range", F.substring("_order", 1, RANGE_DIGITS))
    counts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_rows"))
    ahead = (
        Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    wanted = (
        counts.withColumn("_left", F.lit(n) - F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
        .where(F.col("_left") > 0)
        .select(group, "_range", "_left")
    )
    # At most 4096 rows per group of a fixed list of groups.
    joined = ranged.join(F.broadcast(wanted), [group, "_range"])
    window = Window.partitionBy(group, "_range").orderBy("_order", key)
    return (
        joined.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= F.col("_left"))
        .select(*df.columns)
    )


def sample_stratified(
    df: DataFrame,
    strata: Sequence[Stratum],
    n: int,
    seed: int,
    key: str = "a3",
) -> DataFrame:
    """Up to n accounts per stratum, each account once."""
    order = S.seeded_hash(seed, key)
    picked = _first_per_group(assign_strata(df, strata), "_stratum", order, key, n)
    return picked.drop("_stratum").dropDuplicates([key])


def sample_top_n(df: DataFrame, n: int, seed: int, key: str = "a3") -> DataFrame:
    """The first n rows in seeded order, or all if there are fewer."""
    order = S.seeded_hash(seed, key)
    return _first_per_group(df.withColumn("_all", F.lit(0)), "_all", order, key, n).drop("_all")


def hash_split(
    df: DataFrame,
    keys: Sequence[str] = ("account_id", "cohort"),
    test: float = 0.25,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by hash bucket: no shuffle, and the same rows on every run.

    Keys (account, cohort) split rows; the account alone keeps its cohorts on one side.
    """
    bucket, limit = S.hash_bucket(seed, keys, 10_000), round(test * 10_000)
    return df.where(f"{bucket} >= {limit}"), df.where(f"{bucket} < {limit}")
