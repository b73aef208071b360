"""Quality classifier: histogram gradient-boosted trees over statistics of a document's text.

Statistics are computed for every whole text in Arrow batches. Trees are fitted on the driver, on
labelled rows only, of which about ``MAX_TRAIN`` at most are taken, by a hash of their id, so
that the choice repeats; the bound is a parameter, and bounds what is broadcast and collected. Statistics are cut into at most
``BINS`` bins by quantiles of those rows; a tree grows level by level from histograms of first and
second derivatives of the log loss. A fitted model is a handful of flat arrays, one row per tree
and one column per node, so a batch walks all trees by indexing, a level at a time.

Defined cases: null text scores as empty text; every statistic of an empty text is 0, and it is
scored like any other; repeated rows score alike; labels that are null are not learned from; of
several labels for a doc_id each counts; with no labelled rows, or labels of one value only, every
text scores that value (0.5 without any); columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 50_000
BINS = 64
TREES, DEPTH, RATE, LEAST_ROWS, L2 = 120, 4, 0.1, 10, 1.0
THRESHOLD = 0.7
HELD_OUT, FOLDS = 2, 4

_CLASSES = {
    "upper": (range(65, 91),),
    "lower": (range(97, 123),),
    "digit": (range(48, 58),),
    "space": (range(9, 14), range(32, 33)),
    "stop": (b".!?",),
    "pause": (b",;:",),
    "quote": (b"\"'()-",),
    "bar": (b"|",),
    "symbol": (b"#$%&*+/<=>@[\\]^_`{}~",),
    "high": (range(128, 256),),
    "line": (b"\n",),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _parts in enumerate(_CLASSES.values()):
    for _part in _parts:
        _TABLE[list(_part), _i] = 1

FEATURES = (
    *(f"share_{name}" for name in _CLASSES),
    *("log_bytes", "log_words", "word_bytes", "word_bytes_sd", "distinct_words", "top_word"),
    *("bare_words", "title_words", "shout_words", "sentence_words", "lines", "line_words"),
    *("distinct_lines", "repeated_line_bytes", "byte_entropy", "short_lines"),
)


def statistics(text: str) -> list[float]:
    """Figures of one text, by FEATURES; each is a count, a share or a mean over all of it."""
    data = text.encode("utf-8", "surrogatepass")
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts @ _TABLE / max(n, 1)
    words = data.split()
    if not words:
        return [*shares, np.log1p(n), *[0.0] * (len(FEATURES) - len(shares) - 1)]
    m = len(words)
    sizes = np.fromiter(map(len, words), np.int64, m)
    kinds: dict[bytes, int] = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    bare = title = shout = 0
    for word, count in kinds.items():
        if word.isalpha():
            bare += count
        if word.istitle():
            title += count
        elif word.isupper():
            shout += count
    lines = [line for line in data.split(b"\n") if line]
    distinct = set(lines)
    p = counts[counts > 0] / n
    stops = int(counts[46] + counts[33] + counts[63])
    return [
        *shares,
        np.log1p(n),
        np.log1p(m),
        sizes.mean(),
        sizes.std(),
        len(kinds) / m,
        max(kinds.values()) / m,
        bare / m,
        title / m,
        shout / m,
        m / (stops + 1),
        np.log1p(len(lines)),
        m / len(lines),
        len(distinct) / len(lines),
        1 - sum(map(len, distinct)) / n,
        float(-(p * np.log2(p)).sum()),
        sum(len(line) < 30 for line in lines) / len(lines),
    ]


@dataclass(frozen=True)
class Trees:
    """Flat arrays, one row per tree: heap-ordered inner nodes, then the leaves' values."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        out = np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1])) if len(trees) else 0
        for start in range(0, len(x), 4096) if len(trees) else ():
            rows = x[start : start + 4096]
            at = np.zeros((len(rows), len(trees)), np.int64)
            line = np.arange(len(rows))[:, None]
            for _ in range(depth):
                right = rows[line, self.feature[trees, at]] > self.cut[trees, at]
                at = 2 * at + 1 + right
            out[start : start + 4096] += self.leaf[trees, at - (2**depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the log loss; ties between cuts go to the first feature and bin."""
    inner, leaves = 2**depth - 1, 2**depth
    empty = np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves))
    if len(y) == 0:
        return Trees(*empty, 0.0)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return Trees(*empty, base)
    edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS, method="lower")) for c in x.T]
    # a value is in bin b if b edges are below it: "value > edge b" is "bin > b"
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    width = x.shape[1]
    offset = np.arange(width) * BINS
    feature, cut = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf, raw = np.zeros((trees, leaves)), np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            cell = ((at - first) * (width * BINS))[:, None] + offset + bins
            size = nodes * width * BINS
            sums = [
                np.bincount(cell.ravel(), np.repeat(v, width), size).reshape(nodes, width, BINS)
                for v in (g, h, np.ones(len(y)))
            ]
            (gl, hl, nl) = (np.cumsum(s, axis=2) for s in sums)
            gt, ht, nt = (s[:, :1, -1:] for s in (gl, hl, nl))
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            f, b = np.divmod(best, BINS)
            useful = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            for node in np.flatnonzero(useful):
                feature[t, first + node] = f[node]
                cut[t, first + node] = edges[f[node]][b[node]]
            b = np.where(useful, b, BINS)
            mine = at - first
            at = 2 * at + 1 + (bins[np.arange(len(y)), f[mine]] > b[mine])
        at -= inner
        gs, hs = np.bincount(at, g, leaves), np.bincount(at, h, leaves)
        leaf[t] = -RATE * gs / (hs + L2)
        raw += leaf[t][at]
    return Trees(feature, cut, leaf, base)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, by its remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _matrix(texts: pd.Series) -> np.ndarray:
    rows = [statistics(text or "") for text in texts]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"y": batch["quality"], "x": list(_matrix(batch["text"]))})


def train(
    documents: DataFrame, labels: DataFrame, quality: str = "quality", limit: int = MAX_TRAIN
) -> Trees:
    """Fit on labelled documents outside the held-out fold, on ``limit`` of them where more."""
    known = labels.select("doc_id", F.col(quality).cast("double").alias("quality")).where(
        F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))
    )
    total = known.count()
    if total > limit:
        kept = (F.xxhash64("doc_id") % 2**30 + 2**30) / 2**31
        known = known.where(kept < limit / total)
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")
        .select("quality", "text")
        .mapInPandas(_measure, "y double, x array<double>")
        .toPandas()
    )
    if rows.empty:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x, y = np.stack(rows["x"]), (rows["y"].to_numpy() > 0).astype(float)
    order = np.lexsort((*x.T, y))  # rows come in any order; sums and quantiles then repeat
    return fit(x[order], y[order])


def score_of(model: Trees):
    """A vectorised function of a text column: the text's score."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)))

    return run


def score(documents: DataFrame, model: Trees) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    return documents.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score_of(model)("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(documents: DataFrame, model: Trees) -> DataFrame:
    """The rows, as they are, that score at least THRESHOLD."""
    return documents.where(score_of(model)("text") >= THRESHOLD)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, train(documents, labels))
