"""Embedding near-duplicates by lattice hashing, confirmed by the cosine.

In each of several tables, orthogonal projections take a vector to blocks of eight numbers. The
nearest of the 240 shortest points of the E8 lattice are sought in every block, and a cell is a
point in one block with a point in another. A vector is in the cells whose two points are nearest
to it together. Two vectors that share a cell meet there, and their cosine is computed in double
precision. A pair that shares several cells counts in the first.

How many tables and cells are needed follows from pairs simulated at the threshold: a pair there is
missed with a probability of ``MISS`` at most. Of plans that do, the one taken needs least work: more
blocks make smaller cells, where a vector meets fewer others by chance, but take it to more places.

Equal vectors are one class, counted with its size. Classes are kept as records, many to a row.
Cells with the same point in their first block are a bucket, to which a record goes once. Records
go to their buckets in rounds: some buckets of a table at a time, whose shuffle files are deleted
before the next. Of a bucket of more than ``BLOCK`` classes every cell is a bucket of its own, and if
that holds more, it is cut into blocks, and every pair of blocks is a group of its own; small
buckets share a group. From a group come sums of links by class and links that connect what is
linked, never all pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing, nor do vectors of different lengths; each repeated row is another vector; a row without a
vec_id links with nothing, and is kept; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import deleted, freed_shuffles, shared_path, small_batches, written
from cohortloom.llm.components import components

MISS, SEED = 0.002, 8
#: Work of a table, and of a vector met by chance, where that of a record sent is 1.
TABLE, MEET = 1.0, 1e-4
#: Most cells of a vector in a table; blocks, and points in each, from which they are taken.
POINTS, NEAREST = 16, 4
#: Classes of a bucket, and of a block of a large cell; bytes of one, if their records are large.
BLOCK, BLOCK_BYTES = 60_000, 26 << 20
#: Marks a bucket that is a cell.
FINE = 1 << 62
#: Bytes of a round, unless one record of every class takes more.
ROUND = 128 << 20
#: Classes of a row of records, rows that Python gets at once, and bytes that it sends at once.
RECORDS, BATCH, SENT = 2048, 32, 32 << 20
#: Rows of a cell whose pairs are listed; rows of a larger one, and components, taken at once.
SMALL, STRIP, AT_ONCE = 32, 256, 1 << 22

KEYED = "vec_id long, key binary, vec binary"
RECORD = "dim int, records binary"
SHIPPED = "dim int, bundle long, i int, j int, records binary"
CLASSES = "key binary, vec_id long, copies long"
COUNTS = "dim int, cell long, size long"
FOUND = "key binary, n_links long, a long, b long"
FOUND_ARROW = pa.schema(
    [("key", pa.binary()), ("n_links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]
)


def _shortest() -> np.ndarray:
    """The shortest points of E8: two coordinates of one, or all of a half, evenly many below zero."""
    whole = np.zeros((112, 8), np.float32)
    signs = product(combinations(range(8), 2), product((1, -1), repeat=2))
    for row, (pair, sign) in zip(whole, signs):
        row[list(pair)] = sign
    half = np.array(list(product((0.5, -0.5), repeat=8)), np.float32)
    return np.concatenate([whole, half[(half < 0).sum(axis=1) % 2 == 0]])


SHORTEST = _shortest()


def _nearest(x: np.ndarray, points: int) -> np.ndarray:
    """The nearest cells of rows of blocks of eight numbers, the nearest first."""
    n, blocks = x.shape[:2]
    near = (x.reshape(-1, 8) @ SHORTEST.T).reshape(n, blocks, -1)
    top = np.argsort(-near.max(axis=2), axis=1)[:, :NEAREST]
    top = np.sort(top, axis=1)
    near = np.take_along_axis(near, top[:, :, None], axis=1)
    point = np.argpartition(-near, NEAREST - 1, axis=2)[:, :, :NEAREST]
    near = np.take_along_axis(near, point, axis=2)
    pairs = list(combinations(range(top.shape[1]), 2))
    pairs = product(pairs, range(NEAREST), range(NEAREST))
    p, q, i, j = np.array([(*pair, i, j) for pair, i, j in pairs]).T
    both = -(near[:, p, i] + near[:, q, j])
    if points < both.shape[1]:
        best = np.argpartition(both, points - 1, axis=1)[:, :points]
    else:
        best = np.broadcast_to(np.arange(both.shape[1]), both.shape)
    order = np.argsort(np.take_along_axis(both, best, axis=1), axis=1, kind="stable")
    best = np.take_along_axis(best, order, axis=1)
    at = np.arange(n)[:, None]
    p, q, i, j = p[best], q[best], i[best], j[best]
    place = top[at, p] * blocks + top[at, q]
    return ((place * 240 + point[at, p, i]) * 240 + point[at, q, j]).astype(np.int32)


@dataclass(frozen=True)
class Plan:
    least: float
    blocks: int
    tables: int
    points: int
    #: Buckets that share a first point, and the mean number of a vector's buckets in a table.
    split: int = 1
    spread: float = 1.0

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        """Buckets of cells of a table: by the point in the first block, and if that is split, by
        the other."""
        place, points = np.divmod(cells.astype(np.int64), 240 * 240)
        first = place // self.blocks * 240 + points // 240
        other = place % self.blocks * 240 + points % 240
        return first * self.split + other % self.split

    def with_spread(self, cells: np.ndarray, split: int) -> Plan:
        """Cells are those of sample vectors in one table."""
        plan = replace(self, split=split)
        buckets = np.sort(plan.buckets(cells[:, : self.points]), axis=1)
        return replace(plan, spread=float(_once(buckets).sum(axis=1).mean()))

    def fullest(self, cells: np.ndarray) -> float:
        """The part of vectors in a bucket of the block whose points have most, without a split."""
        buckets = np.sort(self.buckets(cells[:, : self.points]), axis=1)
        return np.bincount(buckets[_once(buckets)] // 240).max() / len(cells) / 240

    def work(self, n: int) -> float:
        places = math.comb(self.blocks, 2) * len(SHORTEST) ** 2
        met = n * self.points**2 / places
        return self.tables * (self.spread + TABLE + MEET * met)

    def planes(self, dim: int) -> list[np.ndarray]:
        """For every table orthogonal directions of vectors of a length, or if these are fewer than
        the directions wanted, a projection that keeps all products."""
        wide = 8 * self.blocks
        rng = np.random.default_rng([SEED, dim])
        draws = (rng.standard_normal((max(dim, wide), min(dim, wide))) for _ in range(self.tables))
        found = (np.linalg.qr(draw)[0].astype(np.float32) for draw in draws)
        return [q if dim >= wide else np.ascontiguousarray(q.T) for q in found]

    def cells(self, unit: np.ndarray, planes: list[np.ndarray]) -> np.ndarray:
        """Cells of unit vectors, those of a table side by side."""
        x = unit.astype(np.float32)
        out = np.empty((len(x), self.tables * self.points), np.int32)
        step = max(1, 8192 // self.blocks)
        for low in range(0, len(x), step):
            part = x[low : low + step]
            for table, plane in enumerate(planes):
                cells = _nearest((part @ plane).reshape(len(part), -1, 8), self.points)
                own = slice(table * self.points, (table + 1) * self.points)
                out[low : low + step, own] = cells
        return out


def _planned(n: int, least: float, blocks: int, trials: int) -> Plan:
    """Tables and cells that miss a pair at the threshold with ``MISS`` at most, for least work."""
    rng = np.random.default_rng([SEED, blocks])
    x, z = rng.standard_normal((2, trials, blocks, 8), np.float32)
    y = least * x + math.sqrt(max(0.0, 1 - least**2)) * z
    x, y = (_nearest(v.astype(np.float32), POINTS) for v in (x, y))
    same = x[:, :, None] == y[:, None, :]
    plans = []
    for points in range(1, POINTS + 1):
        met = min(float(same[:, :points, :points].any(axis=(1, 2)).mean()), 1 - MISS)
        if met > 0:
            tables = math.ceil(math.log(MISS) / math.log(1 - met) - 1e-9)
            plan = Plan(least, blocks, tables, points).with_spread(x, 1)
            split = math.ceil(1.1 * n * plan.fullest(x) / BLOCK)
            plans.append(plan.with_spread(x, split) if split > 1 else plan)
    return min(plans, key=lambda plan: plan.work(n))


def make_plan(n: int, least: float = 0.9, trials: int = 20_000) -> Plan:
    """A plan with as many blocks as the number of vectors asks for."""
    plan = _planned(n, least, 2, trials)
    while plan.blocks < 128:
        more = _planned(n, least, plan.blocks + max(1, plan.blocks // 2), trials)
        if more.work(n) >= plan.work(n):
            break
        plan = more
    return plan


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled by their largest component first against overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def keyed(embeddings: DataFrame, kind: str) -> DataFrame:
    """A row of KEYED for every row; nulls for vectors that cannot be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
            ends = np.cumsum(sizes)
            bad = np.r_[0, np.cumsum(~np.isfinite(values))]
            some = np.r_[0, np.cumsum(values != 0)]
            starts = ends - sizes
            good = (bad[ends] == bad[starts]) & (some[ends] > some[starts])
            vec = [
                values[low:high].tobytes() if ok else None
                for low, high, ok in zip(starts.tolist(), ends.tolist(), good.tolist())
            ]
            key = [None if v is None else xxhash.xxh3_128_digest(v) for v in vec]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(key, pa.binary()), pa.array(vec, pa.binary())],
                names=["vec_id", "key", "vec"],
            )

    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast(f"array<{'float' if kind == '<f4' else 'double'}>"),
    )
    return rows.mapInArrow(run, KEYED)


@dataclass(frozen=True)
class Layout:
    """Bytes of a record: the vector, its class, and its cells; after these, if it is sent, the
    cell it is sent to and its side of a large one."""

    plan: Plan
    kind: str

    def ends(self, dim: int, cells: int) -> list[int]:
        return np.cumsum([dim * int(self.kind[-1]), 16, 8, 8, 4 * cells, 8, 4]).tolist()

    def width(self, dim: int) -> int:
        return self.ends(dim, self.plan.tables * self.plan.points)[4]

    def matrix(self, raw: bytes, width: int) -> np.ndarray:
        return np.frombuffer(raw, np.uint8).reshape(-1, width)

    def field(self, records: np.ndarray, dim: int, cells: int, k: int) -> np.ndarray:
        ends = [0, *self.ends(dim, cells)]
        part = np.ascontiguousarray(records[:, ends[k] : ends[k + 1]])
        return part.view([self.kind, "V16", "<i8", "<i8", "<i4", "<i8", "<i4"][k])

    def buckets(self, records: np.ndarray, dim: int, low: int, high: int, fine) -> np.ndarray:
        """Buckets of some tables, with their table's number; cells for those in ``fine``."""
        points = self.plan.points
        cells = self.field(records, dim, self.plan.tables * points, 4)
        cells = cells[:, low * points : high * points]
        table = np.repeat(np.arange(low, high, dtype=np.int64), points) << 32
        buckets = self.plan.buckets(cells) + table
        if len(fine):
            buckets = np.where(np.isin(buckets, fine), cells + table + FINE, buckets)
        return np.sort(buckets, axis=1)


def _once(buckets: np.ndarray) -> np.ndarray:
    """Whether a bucket is the first of its kind in its row; rows are sorted."""
    return np.diff(buckets, axis=1, prepend=-1) != 0


def _mixed(x: np.ndarray, dim: int) -> np.ndarray:
    """A hash that is not below zero."""
    x = x.astype(np.uint64) + np.uint64(dim)
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(by)
    return (x >> np.uint64(33)).astype(np.int64)


def as_records(classes: DataFrame, layout: Layout) -> DataFrame:
    """Classes with their cells as records, those of vectors of one length together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            sizes = pc.binary_length(batch.column("vec")).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                raw = [b"".join(part.column(c).to_pylist()) for c in ("vec", "key")]
                vec, key = (layout.matrix(x, len(x) // len(part)) for x in raw)
                dim = int(size) // int(layout.kind[-1])
                if dim not in planes:
                    planes[dim] = layout.plan.planes(dim)
                x = unit(vec.view(layout.kind).astype(np.float64))
                numbers = [
                    part.column(c).to_numpy().astype("<i8")[:, None].view(np.uint8)
                    for c in ("vec_id", "copies")
                ]
                cells = layout.plan.cells(x, planes[dim]).astype("<i4").view(np.uint8)
                records = np.concatenate([vec, key, *numbers, cells], axis=1)
                rows = [
                    records[low : low + RECORDS].tobytes()
                    for low in range(0, len(records), RECORDS)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(rows), pa.int32()), pa.array(rows, pa.binary())],
                    names=["dim", "records"],
                )

    return classes.mapInArrow(run, RECORD)


def _unpacked(
    batches: Iterator[pa.RecordBatch], layout: Layout
) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        dims = batch.column("dim").to_pylist()
        for dim, raw in zip(dims, batch.column("records")):
            yield dim, layout.matrix(raw.as_py(), layout.width(dim))


def classes_of(records: DataFrame, layout: Layout) -> DataFrame:
    """A row of CLASSES for every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, found in _unpacked(batches, layout):
            key, vec_id, copies = (layout.field(found, dim, 0, k).ravel() for k in (1, 2, 3))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k.tobytes() for k in key], pa.binary()),
                    pa.array(vec_id, pa.int64()),
                    pa.array(copies, pa.int64()),
                ],
                names=["key", "vec_id", "copies"],
            )

    return records.mapInArrow(run, CLASSES)


def _large(records: DataFrame, layout: Layout, block: int) -> DataFrame:
    """Every bucket and cell of more classes than a block, perhaps some of a little fewer, and their
    sizes at most. A task names those of which it holds some: what tasks do not name of one is a
    sixteenth of a block in all at most."""
    some = block // (16 * max(1, records.rdd.getNumPartitions())) + 1
    plan = layout.plan
    whole = plan.tables * plan.points

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, list[np.ndarray]] = {}
        for dim, found in _unpacked(batches, layout):
            cells.setdefault(dim, []).append(layout.field(found, dim, whole, 4))
        for dim, parts in cells.items():
            for table in range(plan.tables):
                own = slice(table * plan.points, (table + 1) * plan.points)
                fine = np.concatenate([part[:, own] for part in parts]).astype(np.int64)
                buckets = np.sort(plan.buckets(fine), axis=1)
                for ids in (buckets[_once(buckets)], fine.ravel() + FINE):
                    cell, size = np.unique(ids + (table << 32), return_counts=True)
                    cell, size = cell[size >= some], size[size >= some]
                    dims = np.full(len(cell), dim, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(dims), pa.array(cell), pa.array(size)],
                        names=["dim", "cell", "size"],
                    )

    counts = records.mapInArrow(run, COUNTS).groupBy("dim", "cell")
    counts = counts.agg((F.sum("size") + block // 16).alias("size"))
    return counts.where(F.col("size") > block)


@dataclass(frozen=True)
class Round:
    """Some tables; or of one table, buckets of one part in so many."""

    low: int
    high: int
    part: int = 0
    parts: int = 1


def _rounds(plan: Plan, size: int) -> list[Round]:
    """Rounds of ``ROUND`` bytes, or of a record of every class, where all of these have a size."""
    most = max(ROUND, size)
    table = max(1, int(plan.spread * size))
    if table > most:
        parts = -(-table // most)
        return [Round(t, t + 1, p, parts) for t in range(plan.tables) for p in range(parts)]
    step = most // table
    return [Round(t, min(plan.tables, t + step)) for t in range(0, plan.tables, step)]


def _sent(
    records: DataFrame,
    layout: Layout,
    now: Round,
    large: dict[tuple[int, int], int],
    bundles: int,
    block: int,
) -> DataFrame:
    """Records by the groups of a round's buckets: large cells by pairs of their blocks, small ones
    bundled. Cells of later tables are not sent: a pair counts in the first."""
    points = layout.plan.points
    seen = now.high * points
    whole = layout.plan.tables * points
    def groups(dim: int, found: np.ndarray) -> Iterator[tuple[tuple, np.ndarray]]:
        over = [c for size, c in large if size == dim]
        buckets = layout.buckets(found, dim, now.low, now.high, [c for c in over if c < FINE])
        here = _once(buckets)
        if now.parts > 1:
            here &= _mixed(buckets, dim) // bundles % now.parts == now.part
        row, place = np.nonzero(here)
        cell = buckets[row, place]
        kept = found[:, : layout.ends(dim, seen)[4]]

        def out(at: np.ndarray, side: np.ndarray) -> np.ndarray:
            parts = [kept[row[at]], cell[at, None].astype("<i8").view(np.uint8)]
            return np.concatenate([*parts, side[:, None].astype("<i4").view(np.uint8)], axis=1)

        small = ~np.isin(cell, [c for c in over if c >= FINE])
        at = np.flatnonzero(small)
        bundle = _mixed(cell[at], dim) % bundles
        order = np.argsort(bundle, kind="stable")
        at, bundle = at[order], bundle[order]
        sent = out(at, np.full(len(at), -1))
        cuts = np.flatnonzero(np.r_[True, bundle[1:] != bundle[:-1], True]) if len(at) else [0]
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield (dim, int(bundle[low]), -1, -1), sent[low:high]
        of_key = layout.field(found, dim, whole, 1).view("<u8")[:, 0]
        for one in np.unique(cell[~small]):
            at = np.flatnonzero(cell == one)
            cuts = -(-large[dim, int(one)] // block)
            own = (of_key[row[at]] % np.uint64(cuts)).astype(np.int64)
            sent = out(at, own)
            for side in np.unique(own):
                for other in range(cuts):
                    pair = (min(side, other), max(side, other))
                    yield (dim, int(one), *map(int, pair)), sent[own == side]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: dict[tuple, list[bytes]] = {}
        size = 0
        for dim, found in _unpacked(batches, layout):
            for group, rows in groups(dim, found):
                packed.setdefault(group, []).append(rows.tobytes())
                size += rows.size
            if size > SENT:
                yield _packed(packed)
                packed, size = {}, 0
        if packed:
            yield _packed(packed)

    return records.mapInArrow(run, SHIPPED)


def _packed(packed: dict[tuple, list[bytes]]) -> pa.RecordBatch:
    columns = zip(*packed, strict=True)
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32())
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
    rows = pa.array([b"".join(rows) for rows in packed.values()], pa.binary())
    return pa.RecordBatch.from_arrays([*arrays, rows], names=["dim", "bundle", "i", "j", "records"])


@dataclass
class Rows:
    """Records of a group as arrays, and ordered by cell, their rows in the cells met here."""

    key: np.ndarray
    id: np.ndarray
    copies: np.ndarray
    unit: np.ndarray
    cells: np.ndarray
    side: np.ndarray
    row: np.ndarray
    cell: np.ndarray
    starts: np.ndarray


def _rows(raw: bytes, dim: int, layout: Layout, seen: int) -> Rows:
    records = layout.matrix(raw, layout.ends(dim, seen)[-1])
    vec, key, vec_id, copies, cells, bucket, side = (
        layout.field(records, dim, seen, k) for k in range(7)
    )
    points = layout.plan.points
    table = (bucket & (FINE - 1)) >> 32
    own = np.take_along_axis(cells, table * points + np.arange(points), axis=1)
    fine = own + (table << 32)
    row, place = np.nonzero(
        (layout.plan.buckets(own) + (table << 32) == bucket) | (fine + FINE == bucket)
    )
    cell = fine[row, place]
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    return Rows(
        key=key.ravel(),
        id=vec_id.ravel(),
        copies=copies.ravel(),
        unit=unit(vec.astype(np.float64)),
        cells=cells,
        side=side.ravel(),
        row=row[order],
        cell=cell,
        starts=np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True]),
    )


def _candidates(r: Rows, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs in a cell, without those whose cosine is less beyond the rounding of floats."""
    sizes = np.diff(r.starts)
    left = np.repeat(r.starts[1:], sizes) - np.arange(len(r.row)) - 1
    left[np.repeat(sizes > SMALL, sizes)] = 0
    for step in range(1, SMALL):
        i = np.flatnonzero(left >= step)
        if not len(i):
            break
        yield i, i + step
    if (sizes <= SMALL).all():
        return
    short = r.unit.astype(np.float32)
    about = np.float32(least - (short.shape[1] + 16) * 2.0**-23)
    for k in np.flatnonzero(sizes > SMALL):
        end = r.starts[k + 1]
        for low in range(r.starts[k], end, STRIP):
            near = short[r.row[low:end]]
            near = near[:STRIP] @ near.T >= about
            i, j = np.divmod(np.flatnonzero(near), near.shape[1])
            later = j > i
            yield i[later] + low, j[later] + low


def _close(r: Rows, plan: Plan, across: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs whose cosine is large enough, and that meet in this cell first."""
    step = max(1, AT_ONCE // r.unit.shape[1])
    for all_i, all_j in _candidates(r, plan.least):
        for low in range(0, len(all_i), step):
            i, j = all_i[low : low + step], all_j[low : low + step]
            cell, i, j = r.cell[i], r.row[i], r.row[j]
            if across:
                apart = r.side[i] != r.side[j]
                cell, i, j = cell[apart], i[apart], j[apart]
            good = np.einsum("ij,ij->i", r.unit[i], r.unit[j]) >= plan.least
            cell, i, j = cell[good], i[good], j[good]
            if len(i):
                first = _first(r.cells, plan.points, cell, i, j)
                yield i[first], j[first]


def _first(cells, points: int, cell: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether pairs share none of the earlier tables' cells, nor a smaller one of their table."""
    table, cell = cell >> 32, (cell & 0xFFFFFFFF).astype(np.int32)
    first = np.ones(len(i), bool)
    for before in range(table.max() + 1):
        rows = np.flatnonzero(first & (table >= before))
        own = slice(before * points, (before + 1) * points)
        a, b = cells[i[rows], own], cells[j[rows], own]
        earlier = (table[rows] > before)[:, None] | (a < cell[rows, None])
        same = (a[:, :, None] == b[:, None, :]).any(axis=2) & earlier
        first[rows[same.any(axis=1)]] = False
    return first


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """The smallest row that pairs lead to, for every row, added to what is known."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def _compare(layout: Layout, seen: int) -> Callable[[pa.Table], pa.Table]:
    """Of a group, sums of links by class, and links that connect what is linked."""

    def run(group: pa.Table) -> pa.Table:
        across = group["i"][0].as_py() < group["j"][0].as_py()
        raw = b"".join(group["records"].to_pylist())
        r = _rows(raw, group["dim"][0].as_py(), layout, seen)
        n = len(r.id)
        links, label = np.zeros(n, np.int64), np.arange(n)
        for i, j in _close(r, layout.plan, across):
            np.add.at(links, i, r.copies[j])
            np.add.at(links, j, r.copies[i])
            _join(label, i, j)
        some, led = np.flatnonzero(links), np.flatnonzero(label != np.arange(n))
        keys = pa.array([k.tobytes() for k in r.key[some]], pa.binary())
        one, two = pa.nulls(len(some), pa.int64()), pa.nulls(len(led), pa.int64())
        return pa.table(
            [
                pa.chunked_array([keys, pa.nulls(len(led), pa.binary())]),
                pa.chunked_array([pa.array(links[some], pa.int64()), two]),
                pa.chunked_array([one, pa.array(r.id[label[led]], pa.int64())]),
                pa.chunked_array([one, pa.array(r.id[led], pa.int64())]),
            ],
            schema=FOUND_ARROW,
        )

    return run


def near_duplicates(embeddings: DataFrame, least: float = 0.9) -> DataFrame:
    """Per row: vec_id, n_links, component_id, and whether it is kept for its component."""
    spark = embeddings.sparkSession
    place = shared_path(spark, "lattice")
    element = embeddings.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    with freed_shuffles(spark):
        every = keyed(embeddings, kind)
        rows = written(every.select("vec_id", "key"), f"{place}/rows")
        plan = make_plan(rows.count(), least)
        classes = (
            every.where(F.col("key").isNotNull() & F.col("vec_id").isNotNull())
            .groupBy("key")
            .agg(
                F.min("vec_id").alias("vec_id"),
                F.count("*").alias("copies"),
                F.first("vec").alias("vec"),
            )
        )
        layout = Layout(plan, kind)
        records = written(as_records(classes, layout), f"{place}/records")
    with freed_shuffles(spark), small_batches(spark, BATCH):
        classes = classes_of(records, layout)
        found = _found(records, layout, place)
        sums = found.where("key is not null").groupBy("key").agg(F.sum("n_links").alias("n"))
        linked = components(found.where("a is not null").select("a", "b"))
        labels = (
            classes.join(sums, "key", "left")
            .join(linked.withColumnRenamed("id", "vec_id"), "vec_id", "left")
            .select(
                "key",
                (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
                F.coalesce("component", "vec_id").alias("component"),
            )
        )
        labels = written(labels, f"{place}/labels")
    deleted(spark, f"{place}/records")
    deleted(spark, f"{place}/found")
    own = F.col("vec_id").isNotNull()
    return (
        rows.select("vec_id", "key")
        .join(labels, "key", "left")
        .select(
            "vec_id",
            F.when(own, F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
            F.when(own, F.coalesce("component", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _found(records: DataFrame, layout: Layout, place: str) -> DataFrame:
    """What is found in all cells, in rounds."""
    spark = records.sparkSession
    plan = layout.plan
    sizes = records.groupBy("dim").agg(F.sum(F.octet_length("records")).alias("size")).collect()
    size = sum(r["size"] for r in sizes)
    n = sum(r["size"] // layout.width(r["dim"]) for r in sizes)
    if n < 2:
        return spark.createDataFrame([], FOUND)
    widest = layout.width(max(r["dim"] for r in sizes))
    block = min(BLOCK, max(500, BLOCK_BYTES // widest))
    large = written(_large(records, layout, block), f"{place}/found/large")
    table = F.shiftright(F.col("cell").bitwiseAND(FINE - 1), 32)
    paths = []
    for now in _rounds(plan, size):
        own = large.where((table >= now.low) & (table < now.high))
        own = {(r["dim"], r["cell"]): r["size"] for r in own.collect()}
        rows = math.ceil(n * plan.spread * (now.high - now.low) / now.parts)
        sent = _sent(records, layout, now, own, -(-16 * rows // block), block)
        groups = sent.groupBy("dim", "bundle", "i", "j")
        paths.append(f"{place}/found/{now.low}-{now.part}")
        written(groups.applyInArrow(_compare(layout, now.high * plan.points), FOUND), paths[-1])
    return spark.read.schema(FOUND).parquet(*paths)
