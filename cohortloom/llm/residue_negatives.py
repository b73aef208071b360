"""Hard negatives by products in residue arithmetic, selected in a window of scores.

An anchor's scores are whole-number products, found without a wide multiplier: both matrices are
taken modulo each of several small primes, as residues around zero, multiplied in float32, where
every sum of such products is exact, and reduced again; the residues of a score give the signed
score itself by Chinese remaindering, as soon as the primes' product exceeds twice the largest
score possible for the two matrices.

Rows are dealt evenly into slices and anchors into groups, and each pair of a group and a slice is
a task's piece of work. A first pass keeps each anchor's best rows of its own label, a second one,
for every positive, the best rows of other labels in the window that its score opens. Pieces return
only such best rows, so what is ranked by anchor at the end grows with the slices, not the rows.

Defined cases: rows without a vec_id or label, or with a vector that is null, empty, or holds null
or non-finite components, take no part, nor do vectors of another length than the most frequent one
(of several, the longest). Where an anchor's id repeats, the row with the smallest label and
vector asks, and no row with its id answers; each other repeated row counts by itself. Equal scores
go by vec_id. Other columns are ignored; without anchors or rows there is no result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored
from cohortloom.llm.vectors import best, common_length, score_bound, spread, unpack, whole_vectors

#: Rows in a slice and anchors in a group: 8192 vectors of 64 numbers are 2 MB.
SLICE, GROUP, CHUNK = 8192, 8192, 512
EXACT = 2**24

BEST = "anchor_id long, vec_id long, score long"
IN_WINDOW = "anchor_id long, place int, vec_id long, score long"


@cache
def primes_below(most: int = 256) -> tuple[int, ...]:
    """Primes below a bound, the largest first."""
    return tuple(
        p for p in range(most - 1, 2, -1) if all(p % d for d in range(2, int(p**0.5) + 1))
    )


def moduli(bound: int) -> tuple[int, ...]:
    """The fewest of the largest primes whose product exceeds twice the bound, and one."""
    out, product = [], 1
    for p in primes_below():
        if product > 2 * bound + 1:
            break
        out.append(p)
        product *= p
    return tuple(out)


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, between -(p - 1) / 2 and (p - 1) / 2, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, from 0 to p - 1: sums of as many products as float32 holds exactly."""
    most = max(1, EXACT // (p // 2) ** 2)
    total = np.zeros((len(a), len(b)), np.int64)
    for low in range(0, a.shape[1], most):
        total += (a[:, low : low + most] @ b[:, low : low + most].T).astype(np.int64)
    return np.mod(total, p)


class Scores:
    """Exact products of the rows of two matrices of whole numbers."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        self.primes = moduli(score_bound(anchors, rows))
        self.a = [residues(anchors, p) for p in self.primes]
        self.b = [residues(rows, p) for p in self.primes]
        self.shape = (len(anchors), len(rows))

    def part(self, low: int, high: int) -> np.ndarray:
        """Scores of anchors low to high with all rows, digit by digit of the mixed radix."""
        value = np.zeros((high - low, self.shape[1]), np.int64)
        product = 1
        for p, a, b in zip(self.primes, self.a, self.b):
            rest = np.mod(_product(a[low:high], b, p) - value, p)
            digit = np.mod(rest * pow(product, -1, p), p)
            value += digit * product
            product *= p
        return np.where(value > product // 2, value - product, value)


def _pieces(rows: DataFrame, anchors: DataFrame, slices: int, groups: int):
    """Rows and anchors grouped by (group, slice): a copy of a row by group, of an anchor by slice."""
    dealt = rows.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = anchors.withColumn("grp", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return dealt.groupBy("grp", "slice").cogroup(asked.groupBy("grp", "slice"))


def _each(rows: pd.DataFrame, anchors: pd.DataFrame, dim: int):
    """Chunks of anchors: their frame, scores with all rows, whether labels and ids are the same."""
    scores = Scores(unpack(anchors["x"], dim), unpack(rows["x"], dim))
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    for low in range(0, len(anchors), CHUNK):
        part = anchors.iloc[low : low + CHUNK]
        same = part["label"].to_numpy()[:, None] == labels
        own = part["vec_id"].to_numpy()[:, None] == ids
        yield part, scores.part(low, low + len(part)), same, own


def _frame(parts: list[pd.DataFrame], schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    return pd.concat(parts) if parts else pd.DataFrame({c: np.empty(0, np.int64) for c in names})


def _best_positives(dim: int, k: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            rows = rows.sort_values("vec_id", kind="stable")
            ids = rows["vec_id"].to_numpy()
            for part, scores, same, own in _each(rows, anchors, dim):
                at, j = best(scores, same & ~own, k)
                asked = part["vec_id"].to_numpy()[at]
                found = {"anchor_id": asked, "vec_id": ids[j], "score": scores[at, j]}
                out.append(pd.DataFrame(found))
        return _frame(out, BEST)

    return run


def _best_negatives(dim: int, k: int, share: tuple[int, int]):
    up, down = share

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            rows = rows.sort_values("vec_id", kind="stable")
            ids = rows["vec_id"].to_numpy()
            for part, scores, same, own in _each(rows, anchors, dim):
                asked, tops = part["vec_id"].to_numpy(), part["tops"].to_list()
                for place in range(max(map(len, tops))):
                    has = np.array([place < len(t) for t in tops])
                    top = np.array([t[place] if place < len(t) else 0 for t in tops])[:, None]
                    keep = (scores <= top) & (down * scores >= up * top) & ~same & ~own
                    at, j = best(scores, keep & has[:, None], k)
                    found = {"anchor_id": asked[at], "place": place, "vec_id": ids[j]}
                    out.append(pd.DataFrame(found | {"score": scores[at, j]}))
        return _frame(out, IN_WINDOW)

    return run


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    embeddings: DataFrame,
    is_anchor: Column,
    scale: float = 256,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings`` has vec_id, embedding and label; ``is_anchor`` is a condition on vec_id. An
    anchor's positives are its best other rows of the same label; a positive's negatives are the
    best rows of another label with share[0] * positive_score <= share[1] * negative_score and
    negative_score <= positive_score.
    """
    rows = whole_vectors(embeddings, scale, label="label")
    dim = common_length(rows) or 0
    rows = stored(rows.where(F.col("dim") == dim).drop("dim"), "whole")
    first = F.min(F.struct("label", "x")).alias("row")
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(first)
    anchors = stored(anchors.select("vec_id", "row.label", "row.x"), "anchors")
    slices = max(1, -(-rows.count() // SLICE))
    groups = max(1, -(-anchors.count() // GROUP))
    rows = rows.withColumn("slice", spread(slices))

    found = _pieces(rows, anchors, slices, groups).applyInPandas(
        _best_positives(dim, positives), BEST
    )
    near = stored(_ranked(found, ["anchor_id"], positives), "positives")
    tops = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))))
    tops = tops.toDF("vec_id", "found").select("vec_id", F.col("found.score").alias("tops"))
    asked = anchors.join(tops, "vec_id")
    found = _pieces(rows, asked, slices, groups).applyInPandas(
        _best_negatives(dim, negatives, share), IN_WINDOW
    )
    chosen = _ranked(found, ["anchor_id", "place"], negatives)
    near = near.select(
        "anchor_id",
        (F.col("rank") - 1).alias("place"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return chosen.join(near, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
