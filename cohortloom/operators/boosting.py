"""Second-order boosted regression trees, grown a level at a time from histograms.

Values are binned once and the rows stored as packed bins with their target and margin. A level of
a tree is one pass: every task adds up first and second derivatives of its rows by node, column and
bin, the sums are shuffled by node and column, and the tasks that add them up pick the best split of
each. Only these splits go to the driver, which takes the best for each node: what it gets grows
neither with the bins nor, but for a square root, with the tasks. Trees grown since the margins were
stored travel with the pass; every few trees the margins are stored anew, so a lost executor costs
one pass and the lineage never grows.

Derivatives are rounded to whole multiples of 2**-resolution and added as whole numbers. A sum is
then the same however rows are dealt to tasks, and a fit repeated on any cluster gives the same
trees, ties included: of equal gains the first column, the lowest cut, and missing values to the
right win.

A missing value goes to the side where the gain is higher. A nominal column stands for one 0/1
column for each of its labels, which share a histogram: a split sends one label right
(``categories="one_hot"``), or the labels with the lowest mean derivatives left ("ordered"). Its
bins never change those of other columns.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import write_shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Trees after which margins are stored, rows of a stored part, and gains that count as none.
EVERY, PART, NO_GAIN = 20, 250_000, 1e-6
NODES = (
    "tree int, node int, feature string, threshold double, labels array<string>,"
    " missing_left boolean, value double, gain double, cover double"
)


@dataclass(frozen=True)
class BoostParams:
    """Settings; the defaults are those usual for trees of this kind."""

    max_iter: int = 100
    max_depth: int = 6
    step_size: float = 0.3
    l2: float = 1.0
    l1: float = 0.0
    min_gain: float = 0.0
    min_child_weight: float = 1.0
    column_sample: float = 1.0
    base_score: float = 0.5
    max_bins: int = 256
    objective: str = "squared"
    categories: str = "one_hot"
    seed: int = 7
    resolution: int = 30


#: Of a margin and a target: first and second derivatives of the loss.
OBJECTIVES = {
    "squared": lambda m, y: (m - y, np.ones_like(m)),
    "poisson": lambda m, y: (np.exp(m) - y, np.exp(m)),
}
TO_MARGIN = {"squared": float, "poisson": np.log}
FROM_MARGIN = {"squared": np.asarray, "poisson": np.exp}


@dataclass(frozen=True)
class Column:
    """A feature: cut points of a number, or labels of a nominal column. Bin 0 is for the rest."""

    name: str
    cuts: tuple[float, ...] = ()
    labels: tuple[str, ...] | None = None

    @property
    def nominal(self) -> bool:
        return self.labels is not None

    @property
    def size(self) -> int:
        return 1 + len(self.labels if self.nominal else self.cuts)

    def values(self, series: pd.Series) -> np.ndarray:
        """Numbers, NaN where missing; of labels the number, 0 where missing or unknown."""
        if not self.nominal:
            return series.to_numpy(np.float64, na_value=np.nan)
        number = {label: i for i, label in enumerate(self.labels, 1)}
        return series.map(number).fillna(0).to_numpy(np.float64)

    def bins(self, series: pd.Series) -> np.ndarray:
        v = self.values(series)
        if self.nominal:
            return v.astype("<u2")
        found = np.maximum(np.searchsorted(np.array(self.cuts), v, side="right"), 1)
        return np.where(np.isnan(v), 0, found).astype("<u2")


class Tree:
    """A tree as arrays by node; the children of node i are 2 i + 1 and 2 i + 2."""

    def __init__(self, depth: int):
        n = 2 ** (depth + 1) - 1
        self.depth = depth
        self.column = np.full(n, -1)
        self.bin = np.zeros(n, np.int64)
        self.threshold = np.full(n, np.nan)
        self.missing_left = np.zeros(n, bool)
        self.value, self.gain, self.cover = np.zeros(n), np.zeros(n), np.zeros(n)
        self.members = {}  # of a nominal split: whether a label's number goes right

    @cached_property
    def _member_rows(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.full(len(self.column), -1)
        width = max(map(len, self.members.values()), default=1)
        rows = np.zeros((max(1, len(self.members)), width), bool)
        for i, (node, right) in enumerate(self.members.items()):
            at[node] = i
            rows[i, : len(right)] = right
        return at, rows

    def walk(self, matrix: np.ndarray, binned: bool) -> np.ndarray:
        """The node each row ends in. A matrix of bins is compared with bins, else with values."""
        self.__dict__.pop("_member_rows", None) if binned else None
        slot, members = self._member_rows
        cut = self.bin + 1 if binned else self.threshold
        rows, at = np.arange(len(matrix)), np.zeros(len(matrix), np.int64)
        for _ in range(self.depth):
            column = self.column[at]
            if (column < 0).all():
                break
            v = matrix[rows, np.maximum(column, 0)]
            nominal = slot[at] >= 0
            gone = (v == 0 if binned else np.isnan(v)) & ~nominal
            right = np.where(gone, ~self.missing_left[at], v >= cut[at])
            if nominal.any():
                right[nominal] = members[slot[at[nominal]], v[nominal].astype(np.int64)]
            at = np.where(column >= 0, 2 * at + 1 + right, at)
        return at


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    """A sum of derivatives, moved towards 0 by the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


class Layout:
    """Where each column's bins are in a histogram."""

    def __init__(self, columns: Sequence[Column]):
        sizes = [c.size for c in columns]
        self.columns = tuple(columns)
        self.start = np.cumsum([0, *sizes[:-1]])
        self.total = sum(sizes)
        self.of = np.repeat(np.arange(len(sizes)), sizes)
        self.first = self.start[self.of]  # the slot for missing values of a slot's column
        self.nominal = np.array([c.nominal for c in columns])[self.of]
        self.real = np.arange(self.total) != self.first

    def sampled(self, params: BoostParams, tree: int) -> np.ndarray:
        """Slots whose cut may be used by a tree: a share of the columns, a label being one."""
        one_hot = self.nominal & self.real & (params.categories == "one_hot")
        by_label = np.flatnonzero(one_hot)
        plain = [i for i, c in enumerate(self.columns) if not one_hot[self.start[i] + c.size - 1]]
        n = len(plain) + len(by_label)
        if params.column_sample >= 1:
            return self.real.copy()
        taken = np.random.default_rng([params.seed, tree]).choice(
            n, max(1, int(params.column_sample * n)), replace=False
        )
        allowed = np.isin(self.of, [plain[t] for t in taken if t < len(plain)])
        allowed[by_label[[t - len(plain) for t in taken if t >= len(plain)]]] = True
        return allowed & self.real


@dataclass(frozen=True)
class Split:
    """A node's cut, and the sums of derivatives, as whole numbers, of the rows that go left."""

    column: int
    bin: int
    missing_left: bool
    gain: float
    right: np.ndarray | None
    left: tuple[int, int]


def best_split(
    g: np.ndarray, h: np.ndarray, nominal: bool, allowed: np.ndarray, p: BoostParams
) -> tuple | None:
    """The best cut by one column, of whose bins g and h are sums of whole numbers, or None.

    What Split holds, but for the column.
    """
    scale = 2.0**p.resolution
    all_g, all_h = g.sum(), h.sum()

    def sides(left, total):
        return left / scale, (total - left) / scale

    def gains(left_g, left_h):
        (lg, rg), (lh, rh) = sides(left_g, all_g), sides(left_h, all_h)
        ok = (lh >= p.min_child_weight) & (rh >= p.min_child_weight) & (lh > 0) & (rh > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = shrunk(lg, p.l1) ** 2 / (lh + p.l2) + shrunk(rg, p.l1) ** 2 / (rh + p.l2)
        return np.where(ok, parts - parent, -np.inf)

    parent = shrunk(all_g / scale, p.l1) ** 2 / (all_h / scale + p.l2)
    order = None
    found = np.full((len(g), 2), -np.inf)
    if nominal and p.categories == "ordered":
        if allowed.any():
            seen = np.flatnonzero(h > 0)
            order = seen[np.argsort(g[seen] / (h[seen] + p.l2 * scale), kind="stable")]
            cut = gains(np.cumsum(g[order]), np.cumsum(h[order]))
            at = int(cut.argmax())
            found[1, 0], order = cut[at], order[at + 1 :]
    elif nominal:
        # a label alone goes right
        found[:, 0] = gains(all_g - g, all_h - h)
        found[~allowed] = -np.inf
    else:
        # missing values right, then left
        low_g, low_h = np.cumsum(g) - g[0], np.cumsum(h) - h[0]
        found = np.stack([gains(low_g, low_h), gains(low_g + g[0], low_h + h[0])], axis=1)
        found[~allowed] = -np.inf
    slot, left = divmod(int(found.argmax()), 2)
    gain = float(found[slot, left])
    if not gain > max(p.min_gain, NO_GAIN):
        return None
    right = None
    if nominal:
        right = np.zeros(len(g), bool)
        right[[slot] if order is None else order] = True
        stay = ~right
    else:
        stay = np.r_[bool(left), np.arange(1, len(g)) <= slot]
    return slot, bool(left), gain, right, (int(g[stay].sum()), int(h[stay].sum()))


def find_columns(
    df: DataFrame, features: Sequence[str], nominal: Sequence[str], max_bins: int
) -> list[Column]:
    """Cuts at every distinct value of a column with at most ``max_bins``, else at quantiles.

    Labels are collected: a model is as wide as they are many.
    """
    if max_bins >= 2**16:
        raise ValueError("max_bins must be below 65536")
    if not features and not nominal:
        raise ValueError("no features")
    found: dict[str, Column] = {}
    if features:
        columns = [Column(c) for c in features]
        cuts = _few_values(df, columns, max_bins)
        many = [c for c in columns if c.name not in cuts]
        if many:
            ranks = [i / max_bins for i in range(max_bins)]
            values = [F.nanvl(x, F.lit(None)) for x in _inputs(many)]
            quantiles = [F.percentile_approx(x, ranks, max(10_000, 20 * max_bins)) for x in values]
            cuts |= dict(zip([c.name for c in many], df.agg(*quantiles).first()))
        found = {c: Column(c, tuple(sorted({v + 0.0 for v in cuts[c] or ()}))) for c in features}
    for c in nominal:
        labels = df.select(F.col(f"`{c}`")).where(F.col(f"`{c}`").isNotNull()).distinct().collect()
        if len(labels) >= 2**16 - 1:
            raise ValueError(f"column {c} has {len(labels)} labels")
        found[c] = Column(c, labels=tuple(sorted(str(r[0]) for r in labels)))
    return [found[c] for c in [*features, *nominal]]


def _few_values(df: DataFrame, columns: Sequence[Column], most: int) -> dict[str, list[float]]:
    """Distinct values of the columns that have at most so many; a task gives up beyond that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.empty(0)] * len(columns)
        for batch in batches:
            for i, c in enumerate(columns):
                if seen[i] is not None:
                    v = c.values(_series(batch, c))
                    seen[i] = np.unique(np.r_[seen[i], v[~np.isnan(v)]])
                    seen[i] = seen[i] if len(seen[i]) <= most else None
        for i, v in enumerate(seen):
            v = [None] if v is None else v
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(v), pa.int32()), pa.array(v, pa.float64())], ["at", "value"]
            )

    pairs = df.select(*_inputs(columns)).mapInArrow(run, "at int, value double")
    pairs = write_shared(pairs.distinct(), "values")
    sizes = pairs.groupBy("at").agg(F.count("*").alias("n"), F.count("value").alias("real"))
    few = [r["at"] for r in sizes.where((F.col("n") <= most) & (F.col("n") == F.col("real"))).collect()]
    out: dict[str, list[float]] = {columns[i].name: [] for i in few}
    for r in pairs.where(F.col("at").isin(few)).collect():
        out[columns[r["at"]].name].append(r["value"])
    # a column without any value has no cut
    empty = set(range(len(columns))) - {r["at"] for r in sizes.collect()}
    return out | {columns[i].name: [] for i in empty}


def _series(batch: pa.RecordBatch, column: Column) -> pd.Series:
    return batch.column(batch.schema.get_field_index(column.name)).to_pandas()


def _inputs(columns: Sequence[Column]) -> list:
    return [
        F.col(f"`{c.name}`").cast("string" if c.nominal else "double").alias(c.name)
        for c in columns
    ]


def bin_rows(df: DataFrame, columns: Sequence[Column], target: str, base: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = np.stack([c.bins(_series(batch, c)) for c in columns], axis=1)
            y = batch.column(batch.num_columns - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row.tobytes() for row in packed], pa.binary()),
                    y,
                    pa.array(np.full(len(y), base)),
                ],
                names=["bins", "y", "margin"],
            )

    y = F.col(f"`{target}`").cast("double")
    rows = df.where(y.isNotNull()).select(*_inputs(columns), y.alias("_target"))
    return rows.mapInArrow(run, "bins binary, y double, margin double")


def _unpack(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = batch.column(0)
    cuts = np.frombuffer(bins.buffers()[1], np.int32)[bins.offset :]
    flat = np.frombuffer(bins.buffers()[2], "<u2")[cuts[0] // 2 : cuts[len(bins)] // 2]
    y, margin = (batch.column(i).to_numpy() for i in (1, 2))
    return flat.reshape(-1, width), y, margin


def _margins(bins: np.ndarray, margin: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    for tree in trees:
        margin = margin + tree.value[tree.walk(bins, True)]
    return margin


def advance(data: DataFrame, width: int, trees: Sequence[Tree]) -> DataFrame:
    """The rows with the trees added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins, _, margin = _unpack(batch, width)
                new = pa.array(_margins(bins, margin, trees))
                yield batch.set_column(2, "margin", new)

    return data.mapInArrow(run, data.schema)


def _added(keys: np.ndarray, whole: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by key, a row of keys for each; in two halves that doubles add exactly."""
    width = keys.shape[1]
    if (whole == whole[0]).all():
        return np.bincount(keys.ravel(), minlength=size) * whole[0]
    high, low = whole >> 24, whole & (2**24 - 1)
    parts = [
        np.bincount(keys.ravel(), np.repeat(part.astype(np.float64), width), size)
        for part in (high, low)
    ]
    return (parts[0].astype(np.int64) << 24) + parts[1].astype(np.int64)


def packed(data: DataFrame, parts: int, width: int) -> RDD:
    """The rows as arrays of blocks, kept by the executors for the passes of the next trees.

    A pass is one short job, of which there are as many as all trees have levels: planning each as
    a query would take several times as long. A lost block is read again from the stored table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                arrays = [pa.array([x.tobytes()], pa.binary()) for x in _unpack(batch, width)]
                yield pa.RecordBatch.from_arrays(arrays, ["bins", "y", "margin"])

    def arrays(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bins = np.frombuffer(block["bins"], "<u2").reshape(-1, width)
        return bins, np.frombuffer(block["y"]), np.frombuffer(block["margin"])

    blocks = data.coalesce(parts).mapInArrow(run, "bins binary, y binary, margin binary")
    return blocks.rdd.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)


def histograms(
    blocks: RDD,
    layout: Layout,
    recent: Sequence[Tree],
    tree: Tree,
    build: Sequence[int],
    used: np.ndarray,
    p: BoostParams,
) -> RDD:
    """Sums of first and second derivatives by bin, for each (node, column): one pass."""
    place = np.full(len(tree.column), -1)
    place[list(build)] = np.arange(len(build))
    columns = np.unique(layout.of[used]) if used.any() else np.zeros(1, np.int64)
    sizes = np.array([layout.columns[c].size for c in columns])
    start, size = np.cumsum([0, *sizes[:-1]]), int(sizes.sum())

    def run(blocks: Iterator[tuple]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        sums = np.zeros((2, len(build) * size), np.int64)
        for bins, y, margin in blocks:
            node = place[tree.walk(bins, True)]
            inside = np.flatnonzero(node >= 0)
            if not len(inside):
                continue
            bins = bins[inside]
            margin = _margins(bins, margin[inside], recent)
            keys = (node[inside] * size)[:, None] + start + bins[:, columns]
            for i, d in enumerate(OBJECTIVES[p.objective](margin, y[inside])):
                whole = np.floor(d * 2.0**p.resolution + 0.5).astype(np.int64)
                sums[i] += _added(keys, whole, sums.shape[1])
        sums = sums.reshape(2, len(build), size)
        for i, node in enumerate(build):
            for column, first, n in zip(columns, start, sizes):
                yield (int(node), int(column)), sums[:, i, first : first + n]

    found, parts = blocks.mapPartitions(run), blocks.getNumPartitions()
    if parts == 1:
        return found
    width, adding = len(layout.columns), min(len(build) * len(columns), math.ceil(parts**0.5))
    return found.reduceByKey(np.add, adding, lambda key: key[0] * width + key[1])


def splits(
    sums: RDD, layout: Layout, allowed: np.ndarray, p: BoostParams
) -> dict[int, tuple[int, int, Split | None]]:
    """Of every node its sums of derivatives and its best split, if any.

    The tasks that hold the sums choose among their columns, the driver among the tasks. Of equal
    gains the first column wins.
    """
    usable = [allowed[s : s + c.size] for s, c in zip(layout.start, layout.columns)]
    nominal = [c.nominal for c in layout.columns]

    def better(a: tuple, b: tuple) -> tuple:
        if a[2] is None or b[2] is None:
            return b if a[2] is None else a
        return max(a, b, key=lambda x: (x[2][3], -x[2][0]))

    def run(sums: Iterator[tuple[tuple[int, int], np.ndarray]]) -> Iterator[dict[int, tuple]]:
        best: dict[int, tuple] = {}
        for (node, column), (g, h) in sums:
            found = best_split(g, h, nominal[column], usable[column], p)
            split = None if found is None else (column, *found)
            whole = (int(g.sum()), int(h.sum()), split)
            best[node] = better(best[node], whole) if node in best else whole
        yield best

    chosen: dict[int, tuple] = {}
    for part in sums.mapPartitions(run).collect():
        for node, found in part.items():
            chosen[node] = better(chosen[node], found) if node in chosen else found
    return {n: (g, h, None if s is None else Split(*s)) for n, (g, h, s) in chosen.items()}


def grow(
    blocks: RDD, layout: Layout, recent: Sequence[Tree], number: int, p: BoostParams
) -> Tree:
    """One more tree: one pass over the rows for each of its levels."""
    tree, allowed = Tree(p.max_depth), layout.sampled(p, number)
    scale = 2.0**p.resolution
    level = [0]
    for _ in range(p.max_depth):
        found = splits(histograms(blocks, layout, recent, tree, level, allowed, p), layout, allowed, p)
        below = []
        for node in level:
            g, h, split = found[node]
            _leaf(tree, node, g / scale, h / scale, p)
            if split is None:
                continue
            _branch(tree, node, split, layout)
            left, right = 2 * node + 1, 2 * node + 2
            lg, lh = split.left
            _leaf(tree, left, lg / scale, lh / scale, p)
            _leaf(tree, right, (g - lg) / scale, (h - lh) / scale, p)
            below += [left, right]
        level = below
        if not level:
            break
    return tree


def _leaf(tree: Tree, node: int, g: float, h: float, p: BoostParams) -> None:
    tree.value[node] = p.step_size * (-shrunk(g, p.l1) / (h + p.l2))
    tree.cover[node] = h


def _branch(tree: Tree, node: int, split: Split, layout: Layout) -> None:
    column = layout.columns[split.column]
    tree.column[node], tree.bin[node], tree.gain[node] = split.column, split.bin, split.gain
    if column.nominal:
        tree.members[node] = split.right
    else:
        cuts = column.cuts
        tree.threshold[node] = cuts[split.bin] if split.bin < len(cuts) else np.inf
        tree.missing_left[node] = split.missing_left


@dataclass(frozen=True)
class BoostedModel:
    """Trees over columns; ``base`` is the margin before the first."""

    columns: tuple[Column, ...]
    trees: tuple[Tree, ...]
    base: float
    objective: str = "squared"

    @property
    def width(self) -> int:
        """Columns as the trees see them: a nominal one is as many as it has labels."""
        return sum(len(c.labels) if c.nominal else 1 for c in self.columns)

    @property
    def nominal(self) -> list[str]:
        return [c.name for c in self.columns if c.nominal]

    def matrix(self, series: Sequence[pd.Series]) -> np.ndarray:
        return np.stack([c.values(s) for c, s in zip(self.columns, series)], axis=1)

    def margins(self, matrix: np.ndarray) -> np.ndarray:
        out = np.full(len(matrix), self.base)
        for tree in self.trees:
            out += tree.value[tree.walk(matrix, False)]
        return out

    def nodes(self) -> list[tuple]:
        """Rows of NODES: for a split its column, threshold or labels, and gain; for all, value."""
        rows = []
        for t, tree in enumerate(self.trees):
            todo = [0]
            while todo:
                node = todo.pop()
                i = int(tree.column[node])
                value, cover = float(tree.value[node]), float(tree.cover[node])
                if i < 0:
                    rows.append((t, node, None, None, None, None, value, 0.0, cover))
                    continue
                todo += [2 * node + 2, 2 * node + 1]
                c, labels, threshold = self.columns[i], None, float(tree.threshold[node])
                if c.nominal:
                    right = tree.members[node]
                    # bin 0 stands for labels not seen in the fit
                    labels = [([None, *c.labels])[j] for j in np.flatnonzero(right)]
                    threshold = None
                left = bool(tree.missing_left[node])
                gain = float(tree.gain[node])
                rows.append((t, node, c.name, threshold, labels, left, value, gain, cover))
        return rows


def fit(
    df: DataFrame,
    features: Sequence[str],
    params: BoostParams = BoostParams(),
    target: str = "target",
    nominal: Sequence[str] = (),
) -> BoostedModel:
    """Fit on all rows that have a target; missing feature values are left as they are."""
    columns = find_columns(df, features, nominal, params.max_bins)
    layout = Layout(columns)
    base = float(TO_MARGIN[params.objective](params.base_score))
    rows = bin_rows(df, columns, target, base)
    data = write_shared(rows, "binned")
    n = data.count()
    if not n:
        raise ValueError("no rows to fit on")
    parts, width = -(-n // PART), len(columns)
    trees: list[Tree] = []
    while len(trees) < params.max_iter:
        recent: list[Tree] = []
        blocks = packed(data, parts, width)
        for number in range(len(trees), min(len(trees) + EVERY, params.max_iter)):
            recent.append(grow(blocks, layout, recent, number, params))
        blocks.unpersist()
        trees += recent
        if len(trees) < params.max_iter:
            data = write_shared(advance(data, width, recent), "margins")
    return BoostedModel(tuple(replace(c, cuts=()) for c in columns), tuple(trees), base,
                        params.objective)


def predict(df: DataFrame, model: BoostedModel, name: str = "prediction") -> DataFrame:
    """Input columns with the prediction; only the model's columns go through Python."""

    @F.pandas_udf("double")
    def run(*series: pd.Series) -> pd.Series:
        found = model.margins(model.matrix(series))
        return pd.Series(FROM_MARGIN[model.objective](found))

    return df.withColumn(name, run(*_inputs(model.columns)))


def stored_nodes(spark: SparkSession, model: BoostedModel) -> DataFrame:
    return spark.createDataFrame(model.nodes(), NODES)


def from_nodes(
    rows: Sequence, columns: Sequence[Column], base: float, objective: str
) -> BoostedModel:
    """The model of a table of nodes."""
    number = {c.name: i for i, c in enumerate(columns)}
    depth: dict[int, int] = {}
    for r in rows:
        depth[r["tree"]] = max(depth.get(r["tree"], 0), (r["node"] + 1).bit_length() - 1)
    trees = [Tree(depth[t]) for t in sorted(depth)]
    for r in rows:
        tree, node = trees[r["tree"]], r["node"]
        tree.value[node], tree.gain[node], tree.cover[node] = r["value"], r["gain"], r["cover"]
        if r["feature"] is None:
            continue
        i = tree.column[node] = number[r["feature"]]
        tree.missing_left[node] = r["missing_left"]
        if columns[i].nominal:
            right = np.zeros(columns[i].size, bool)
            places = {label: j for j, label in enumerate([None, *columns[i].labels])}
            right[[places[label] for label in r["labels"]]] = True
            tree.members[node] = right
        else:
            tree.threshold[node] = r["threshold"]
    return BoostedModel(tuple(columns), tuple(trees), base, objective)
