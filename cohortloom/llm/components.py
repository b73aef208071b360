"""Connected components of links, as rounds of joins: nothing of the graph goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id of every id that has a link: ``id``, ``component``.

    ``links`` has columns a and b, in any order and with repeats. Large-star and small-star steps
    alternate until nothing changes. A step needs the smallest neighbour of every id (an
    aggregation with partial results, so a hub's links are never gathered) and one join with it.
    Each round's links are written to the shared folder, so lost executors cost one round.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.where("a <> b").distinct(), "links")
    mark = _mark(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    # now every link leads from an id to its component
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of an id to the smallest of the id and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("u"), F.least("m", "a").alias("m"))
    larger = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link an id and all its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).where("a <> b").distinct()
