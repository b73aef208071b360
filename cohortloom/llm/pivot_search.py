"""Exact search for the highest inner products, by an index of distances to pivots.

Vectors of whole numbers are lengthened by one coordinate that brings all of them to the length M
of the longest; a query gets a zero there. Then the squared distance of a query q and a vector is
|q|**2 + M**2 - 2 * score, so that the nearest vectors are those with the highest scores.

The index keys every vector by its nearest pivot and its distance to it. Consecutive keys form
slices of bounded size: a histogram of pivots and distance steps, whose size does not depend on the
number of vectors, is cut into runs, and a cell with more rows than a slice takes is dealt out by
chance. Queries are grouped in the same way. A group meets a slice only if the triangle inequality
allows it, by the least and greatest distances both have to a pivot. Within such a piece of work
the slice is cut into annuli, sorted by distance within a pivot; they are visited from the nearest
outwards, an annulus only by the queries whose k-th score so far its bound does not rule out, and
the visit ends when no query is left. A query's first k-th score is that among the rows the pivots
were fitted on, which are a bounded sample.

The bound holds whatever the pivots, so results are exact; vectors that point evenly everywhere
rule out few annuli, clustered ones most.

Defined cases: rows without a vec_id or with a vector that is null, empty, or holds null or
non-finite components take no part, nor do vectors of another length than the most frequent one
(of several, the longest). Where a query's id repeats, the row with the smallest packed vector
asks, and no row with its id answers; each other repeated row is a candidate of its own. Equal
scores go by vec_id. Other columns are ignored; without queries or rows there is no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored
from cohortloom.llm.vectors import (
    LOW,
    MOST_SCORE,
    best,
    common_length,
    score_bound,
    unpack,
    whole_vectors,
)

#: Rows pivots are fitted on, pivots, and steps of distance in the histogram.
SAMPLE, PIVOTS, STEPS = 4096, 64, 64
#: Rows in a slice, queries in a group, rows in an annulus.
SLICE, GROUP, RING = 8192, 8192, 512
#: What rounding can add to a distance, as a share of the largest.
SLACK = 1e-6

KEYED = "vec_id long, x binary, pivot int, distance double, norm double, seed long, step int"
FOUND = "query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Pivots:
    """Pivots, the greatest length of a vector, and the sample the pivots were fitted on."""

    longest: float
    at: np.ndarray
    ids: np.ndarray
    sample: np.ndarray

    @staticmethod
    def fit(ids: np.ndarray, sample: np.ndarray, longest: float, count: int) -> Pivots:
        """Points far from each other, moved to the means of what lies nearest to them."""
        rows = _lengthen(sample, longest)
        at = rows[:1]
        least = _distances(rows, at)[:, 0]
        while len(at) < count and least.max(initial=0) > SLACK * longest:
            at = np.vstack([at, rows[least.argmax()]])
            least = np.minimum(least, _distances(rows, at[-1:])[:, 0])
        for _ in range(3):
            own = _distances(rows, at).argmin(axis=1)
            at = np.stack(
                [rows[own == i].mean(axis=0) if (own == i).any() else p for i, p in enumerate(at)]
            )
        return Pivots(longest, at, ids, sample)

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        return _distances(_lengthen(x, self.longest), self.at)

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        return _distances(np.c_[x.astype(np.float64), np.zeros(len(x))], self.at)

    def slack(self, norms: np.ndarray) -> np.ndarray:
        return SLACK * (norms + self.longest)

    def most_score(self, near: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """The highest score of a query of such a length with rows at least that far away."""
        near = np.maximum(near - self.slack(norms), 0)
        return (norms**2 + self.longest**2 - near**2) / 2 + self.slack(norms) * self.longest

    def seeds(self, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
        """The k-th highest score in the sample, without the query itself."""
        if len(self.ids) < k:
            return np.full(len(ids), LOW)
        keep = ids[:, None] != self.ids
        scores = np.where(keep, products(x, self.sample), LOW)
        return np.partition(scores, len(self.ids) - k, axis=1)[:, len(self.ids) - k]


def _lengthen(x: np.ndarray, longest: float) -> np.ndarray:
    x = x.astype(np.float64)
    rest = np.maximum(longest**2 - (x * x).sum(axis=1), 0)
    return np.c_[x, np.sqrt(rest)]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products: below 2**48 every sum is a whole double."""
    assert score_bound(a, b) < MOST_SCORE
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)


def key_rows(rows: DataFrame, dim: int, pivots: Pivots, is_query: Column, k: int) -> DataFrame:
    """Rows of KEYED; the seed is null for rows that do not ask."""
    widest = 2 * pivots.longest

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unpack(batch["x"], dim)
            far = pivots.of_rows(x)
            own = far.argmin(axis=1)
            distance = far[np.arange(len(x)), own]
            asks = batch["asks"].to_numpy().astype(bool)
            seed = pd.array([None] * len(x), dtype="Int64")
            if asks.any():
                seed[asks] = pivots.seeds(batch["vec_id"].to_numpy()[asks], x[asks], k)
            step = np.minimum(distance / (widest or 1) * STEPS, STEPS - 1).astype(np.int32)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "x": batch["x"],
                    "pivot": own.astype(np.int32),
                    "distance": distance,
                    "norm": np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)),
                    "seed": seed,
                    "step": step,
                }
            )

    asks = F.coalesce(is_query, F.lit(False)).alias("asks")
    return rows.select("vec_id", "x", asks).mapInPandas(run, KEYED)


def in_runs(keyed: DataFrame, name: str, most: int) -> tuple[DataFrame, int]:
    """A column with a number for rows whose keys follow each other, of about ``most`` at most."""
    counts = sorted(keyed.groupBy("pivot", "step").count().collect())
    cells, parts, full = [], 0, most
    for pivot, step, n in counts:
        if full + n > most:
            parts += max(1, -(-full // most)) if cells else 0
            full = 0
        cells.append((pivot, step, parts, max(1, -(-n // most))))
        full += n
    parts += max(1, -(-full // most)) if cells else 0
    runs = keyed.sparkSession.createDataFrame(cells, "pivot int, step int, first int, parts int")
    place = F.floor(F.rand(23) * F.col("parts")).cast("int")
    keyed = keyed.join(F.broadcast(runs), ["pivot", "step"])
    return keyed.withColumn(name, F.col("first") + place).drop("first", "parts"), parts


def meetings(rows: DataFrame, queries: DataFrame, pivots: Pivots, dim: int, k: int) -> DataFrame:
    """slice, grp: the pairs that the triangle inequality does not rule out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unpack(batch["x"], dim)
            far = pivots.of_queries(x)
            n, p = far.shape
            frame = {c: np.repeat(batch[c].to_numpy(), p) for c in ("grp", "norm", "seed")}
            frame |= {"pivot": np.tile(np.arange(p, dtype=np.int32), n), "far": far.ravel()}
            part = pd.DataFrame(frame).groupby(["grp", "pivot"], as_index=False)
            yield part.agg(
                least=("far", "min"),
                greatest=("far", "max"),
                norm=("norm", "max"),
                seed=("seed", "min"),
            )

    schema = "grp int, pivot int, least double, greatest double, norm double, seed long"
    asked = queries.mapInPandas(run, schema).groupBy("grp", "pivot")
    asked = asked.agg(
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.max("norm").alias("norm"),
        F.min("seed").alias("seed"),
    )
    rings = rows.groupBy("slice", "pivot").agg(
        F.min("distance").alias("inner"), F.max("distance").alias("outer")
    )
    slack = SLACK * (F.col("norm") + pivots.longest)
    near = F.greatest(F.col("inner") - F.col("greatest"), F.col("least") - F.col("outer")) - slack
    near = F.greatest(near, F.lit(0.0))
    most = (F.col("norm") ** 2 + pivots.longest**2 - near**2) / 2 + slack * pivots.longest
    meet = rings.join(asked, "pivot").where(most >= F.col("seed"))
    return meet.select("slice", "grp").distinct()


def expand(
    pivots: Pivots, rows: tuple, queries: tuple, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and ids of the k best rows of each query, and the number of products computed.

    ``rows`` are ids, x, pivots and distances; ``queries`` ids, x and seeds. Places that no row
    takes have the score LOW.
    """
    ids, x, pivot, distance = rows
    asked, q, seed = queries
    order = np.lexsort((ids, distance, pivot))
    ids, x, pivot, distance = ids[order], x[order], pivot[order], distance[order]
    new = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1], True])
    cuts = [c for a, b in zip(new[:-1], new[1:]) for c in range(a, b, RING)] + [len(ids)]
    rings = list(zip(cuts[:-1], cuts[1:]))
    far, norms = pivots.of_queries(q), np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    inner = np.array([distance[a] for a, _ in rings])
    outer = np.array([distance[b - 1] for _, b in rings])
    to = far[:, [pivot[a] for a, _ in rings]]
    near = np.maximum(np.maximum(inner - to, to - outer), 0)
    reach = pivots.most_score(near, norms[:, None])

    top, who = np.full((len(q), k), LOW), np.full((len(q), k), np.iinfo(np.int64).max)
    least, computed = seed.copy(), 0
    for ring in np.argsort(near.mean(axis=0), kind="stable"):
        live = np.flatnonzero(reach[:, ring] >= least)
        if not len(live):
            if (reach < least[:, None]).all():
                break
            continue
        low, high = rings[ring]
        by_id = low + np.argsort(ids[low:high], kind="stable")
        scores = products(q[live], x[by_id])
        computed += scores.size
        keep = (scores >= least[live, None]) & (asked[live, None] != ids[by_id])
        at, j = best(scores, keep, k)
        width = min(k, high - low)
        more, more_ids = np.full((len(live), width), LOW), np.full((len(live), width), who.max())
        place = np.arange(len(at)) - np.searchsorted(at, at)
        more[at, place], more_ids[at, place] = scores[at, j], ids[by_id][j]
        both, both_ids = np.c_[top[live], more], np.c_[who[live], more_ids]
        first = np.lexsort((both_ids, np.where(both == LOW, LOW + 1, both) * -1), axis=1)[:, :k]
        top[live] = np.take_along_axis(both, first, axis=1)
        who[live] = np.take_along_axis(both_ids, first, axis=1)
        least = np.maximum(least, top[:, -1])
    return top, who, computed


def _visit(pivots: Pivots, dim: int, k: int):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not (len(rows) and len(queries)):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "vec_id", "score")})
        asked = queries["vec_id"].to_numpy()
        top, who, _ = expand(
            pivots,
            (
                rows["vec_id"].to_numpy(),
                unpack(rows["x"], dim),
                rows["pivot"].to_numpy(),
                rows["distance"].to_numpy(),
            ),
            (asked, unpack(queries["x"], dim), queries["seed"].to_numpy()),
            k,
        )
        row, place = np.nonzero(top > LOW)
        return pd.DataFrame(
            {"query_id": asked[row], "vec_id": who[row, place], "score": top[row, place]}
        )

    return run


def search(embeddings: DataFrame, is_query: Column, k: int = 20, scale: float = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of every row that asks.

    ``is_query`` is a condition on vec_id; candidates are all rows but the query's own.
    """
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, scale)
    dim = common_length(rows)
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.where(F.col("dim") == dim).select("vec_id", "x")
    pivots = _fit(rows, dim)
    keyed = stored(key_rows(rows, dim, pivots, is_query, k), "keyed")
    asked = keyed.where("seed is not null").groupBy("vec_id")
    asked = asked.agg(F.min(F.struct("x", "pivot", "step", "norm", "seed")).alias("row"))
    asked, _ = in_runs(stored(asked.select("vec_id", "row.*"), "queries"), "grp", GROUP)
    queries = stored(asked, "groups")
    sliced, _ = in_runs(keyed.drop("seed", "norm"), "slice", SLICE)
    sliced = stored(sliced, "slices")
    meet = stored(meetings(sliced, queries, pivots, dim, k), "meetings")

    rows = sliced.select("vec_id", "x", "pivot", "distance", "slice")
    rows = rows.join(meet.groupBy("slice").agg(F.collect_list("grp").alias("grps")), "slice")
    rows = rows.withColumn("grp", F.explode("grps")).drop("grps")
    to = meet.groupBy("grp").agg(F.collect_list("slice").alias("slices"))
    queries = queries.select("vec_id", "x", "seed", "grp").join(to, "grp")
    queries = queries.withColumn("slice", F.explode("slices")).drop("slices")
    found = (
        rows.groupBy("grp", "slice")
        .cogroup(queries.groupBy("grp", "slice"))
        .applyInPandas(_visit(pivots, dim, k), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _fit(rows: DataFrame, dim: int) -> Pivots:
    """Pivots from at most SAMPLE rows, those with the smallest hashes."""

    def norms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unpack(batch["x"], dim).astype(np.float64)
            yield pd.DataFrame({"norm": [np.sqrt((x * x).sum(axis=1).max(initial=0))]})

    longest = rows.select("x").mapInPandas(norms, "norm double").agg(F.max("norm")).first()[0]
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(SAMPLE).collect()
    ids = np.array([r["vec_id"] for r in taken], np.int64)
    return Pivots.fit(ids, unpack([r["x"] for r in taken], dim), longest, PIVOTS)
