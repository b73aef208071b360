"""MinHash near-duplicates: banded candidates, odd sketches to estimate, full sets to confirm.

Every text becomes its set of word shingles, hashed to 64 bits. Texts with equal sets are one
class, represented by the smallest doc_id. MinHash samples of a class serve twice. In bands of
``ROWS`` they are bucket keys; classes that share a bucket make a family, by one link from each to
the smallest in the bucket, however many there are. And folded into a bitmap of parities (the odd
sketch), they estimate the similarity of two classes from the count of ones in the bitmaps' XOR.

Inside a family all pairs are estimated, the most similar first; pairs whose estimate reaches the
threshold less a margin are confirmed on the full sets, unless links found before already connect
them. A family larger than ``BLOCK`` is cut into blocks, and every pair of blocks is a group of its
own, so no task holds more than two blocks. Links are then closed to components by joins.

The number of bands follows from the threshold: a pair at the threshold shares no bucket with a
probability of ``MISS`` at most. The margin is 5.5 standard deviations of the estimate.

Defined cases: null texts and texts without words have no shingles and link with nothing; a text
of fewer words than a shingle is one shingle; repeated rows and rows of one doc_id belong to one
component; a row without a doc_id links with nothing and is kept; columns beyond doc_id and text
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored, text_batches, unused
from cohortloom.llm.components import components
from cohortloom.llm.words import WordIds, chained, mix

ROWS, MISS = 6, 1e-6
BITS = 512
BLOCK = 400
CHUNK = 1 << 16

SKETCHED = (
    "doc_id string, n_shingles long, set_key binary, bands array<long>, sketch binary, body binary"
)

ARROW = [
    ("doc_id", pa.string()),
    ("n_shingles", pa.int64()),
    ("set_key", pa.binary()),
    ("bands", pa.list_(pa.int64())),
    ("sketch", pa.binary()),
    ("body", pa.binary()),
]


@dataclass(frozen=True)
class Plan:
    """Shingle width and threshold (in percent), and what follows from them."""

    width: int
    percent: int

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** ROWS))

    @property
    def samples(self) -> int:
        return ROWS * self.bands

    @property
    def most_ones(self) -> int:
        """Ones in the XOR of two sketches at the lowest estimate that is still confirmed.

        Each sample that differs flips two bits, so after T flips a bit is one with probability
        (1 - (1 - 2 / BITS) ** T) / 2. The estimate varies with the samples, by t (1 - t) / k, and
        with the flips that meet in one bit, by less than 3 (1 - t) ** 2 / BITS.
        """
        t = self.percent / 100
        least = t - 5.5 * math.sqrt(t * (1 - t) / self.samples + 3 * (1 - t) ** 2 / BITS)
        flips = 2 * self.samples * (1 - max(least, 0))
        return math.ceil(BITS * (1 - (1 - 2 / BITS) ** flips) / 2)


def shingles(data: bytes, width: int, ids: WordIds) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; the text is in lower case already."""
    words = ids.of(data.split())
    if not len(words):
        return words
    return np.unique(chained(words, min(width, len(words))))


def minima(sets: list[np.ndarray], samples: int) -> np.ndarray:
    """MinHash samples, one row for each set that is not empty."""
    factors = mix(np.arange(1, samples + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
    out = np.empty((samples, len(sets)), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= CHUNK):
            total += len(sets[last])
            last += 1
        part = sets[first:last]
        x = (np.concatenate(part) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, part[:-1])])
        for i, factor in enumerate(factors):
            y = x * factor
            out[i, first:last] = np.minimum.reduceat(y ^ (y >> np.uint32(15)), starts)
        first = last
    return out.T


def fold(samples: np.ndarray) -> np.ndarray:
    """Odd sketches: every (number, value) of a sample flips one bit."""
    n, k = samples.shape
    numbers = np.arange(k, dtype=np.uint64) << np.uint64(32)
    place = (mix(samples.astype(np.uint64) + numbers) % np.uint64(BITS)).astype(np.int64)
    flips = np.zeros((n, BITS), np.int64)
    np.add.at(flips, (np.arange(n)[:, None], place), 1)
    return np.packbits((flips & 1).astype(np.uint8), axis=1)


def band_keys(samples: np.ndarray) -> np.ndarray:
    n, k = samples.shape
    values = samples.astype(np.uint64).reshape(n, k // ROWS, ROWS)
    keys = np.broadcast_to(np.arange(k // ROWS, dtype=np.uint64), values.shape[:2])
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, :, i])
    return keys.view(np.int64)


def sketch(documents: DataFrame, plan: Plan) -> DataFrame:
    """A row of SKETCHED for every document row; nulls where there is no shingle."""

    schema = pa.schema(ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pack = WordIds(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for start in range(0, len(batch), 500):
                # of a batch only these texts become objects
                part = _sketch_rows(batch.slice(start, 500).to_pandas(), plan, ids, pack)
                yield pa.RecordBatch.from_pandas(part, schema, preserve_index=False)

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInArrow(run, SKETCHED).withColumn("doc_id", F.col("doc_id").cast("long"))


def _sketch_rows(batch: pd.DataFrame, plan: Plan, ids: WordIds, pack) -> pd.DataFrame:
    texts = [(text or "").encode().lower() for text in batch["text"]]
    sets = [shingles(text, plan.width, ids) for text in texts]
    full = [i for i, s in enumerate(sets) if len(s)]
    out = pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": list(map(len, sets))})
    columns = {name: [None] * len(sets) for name in ("set_key", "bands", "sketch", "body")}
    if full:
        samples = minima([sets[i] for i in full], plan.samples)
        for i, keys, bits in zip(full, band_keys(samples), fold(samples)):
            columns["set_key"][i] = xxhash.xxh3_128_digest(sets[i].tobytes())
            columns["bands"][i] = keys
            columns["sketch"][i] = bits.tobytes()
            columns["body"][i] = pack.compress(texts[i])
    return out.assign(**columns)


def _families(classes: DataFrame) -> DataFrame:
    """Classes that share buckets, linked through the smallest of each bucket."""
    cells = classes.select("doc_id", F.explode("bands").alias("key"))
    pivots = (
        cells.groupBy("key")
        .agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"))
        .where("pivot < last")
    )
    links = cells.join(pivots, "key").where("doc_id <> pivot")
    return components(links.select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")))


def _bundles(members: DataFrame, total: int) -> DataFrame:
    """Small families several to a bundle, larger ones by pairs of their blocks."""
    count = max(1, -(-total // BLOCK))
    cuts = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), cuts).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), cuts - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    none = F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    return members.select(
        "*",
        F.when(cuts == 1, F.pmod(F.xxhash64("family"), F.lit(count)))
        .otherwise(F.col("family"))
        .alias("bundle"),
        F.when(cuts == 1, F.lit(-1)).otherwise(own).alias("side"),
        F.explode(F.when(cuts == 1, none).otherwise(pairs)).alias("block"),
    ).withColumn("across", F.col("block.i") < F.col("block.j"))


def _confirm(plan: Plan):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, unpack = WordIds(), zstandard.ZstdDecompressor()
        found: list[tuple[int, int]] = []
        for _, family in group.groupby("family", sort=False):
            found += _family_links(family, plan, ids, unpack)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _family_links(family: pd.DataFrame, plan: Plan, ids: WordIds, unpack) -> list[tuple[int, int]]:
    """Links that connect all that is similar in one family, or across its two blocks."""
    n = len(family)
    if n < 2:
        return []
    docs, size = family["doc_id"].to_numpy(), family["n_shingles"].to_numpy()
    side, bodies = family["side"].to_numpy(), family["body"].to_numpy()
    across = bool(family["across"].iloc[0])
    bits = np.frombuffer(b"".join(family["sketch"]), np.uint64).reshape(n, -1)
    ones, left, right = [], [], []
    for i in range(n - 1):
        count = np.bitwise_count(bits[i] ^ bits[i + 1 :]).sum(axis=1, dtype=np.int64)
        small, large = np.minimum(size[i], size[i + 1 :]), np.maximum(size[i], size[i + 1 :])
        near = (count <= plan.most_ones) & (100 * small >= plan.percent * large)
        if across:
            near &= side[i + 1 :] != side[i]
        j = np.flatnonzero(near)
        ones.append(count[j])
        left.append(np.full(len(j), i))
        right.append(j + i + 1)
    ones, left, right = map(np.concatenate, (ones, left, right))
    root, sets, out = list(range(n)), {}, []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def full(i: int) -> set[int]:
        if i not in sets:
            sets[i] = set(shingles(unpack.decompress(bodies[i]), plan.width, ids).tolist())
        return sets[i]

    for at in np.argsort(ones, kind="stable").tolist():
        i, j = int(left[at]), int(right[at])
        if top(i) == top(j):
            continue
        both = len(full(i) & full(j))
        if 100 * both >= plan.percent * (len(full(i)) + len(full(j)) - both):
            root[top(i)] = top(j)
            out.append((int(docs[i]), int(docs[j])))
    return out


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, and whether it is kept."""
    plan = Plan(width, percent)
    with text_batches(documents.sparkSession):
        docs = stored(sketch(documents, plan), "sketches")
    linked = docs.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = linked.groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")
    )
    classes = stored(classes, "classes")
    families = stored(_families(classes), "families")
    sizes = families.groupBy("component").agg(F.count("*").alias("size"))
    members = (
        families.join(sizes, "component")
        .select(F.col("id").alias("doc_id"), F.col("component").alias("family"), "size")
        .join(classes.select("doc_id", "set_key"), "doc_id")
        .join(
            linked.select("doc_id", "set_key", "n_shingles", "sketch", "body").dropDuplicates(
                ["doc_id", "set_key"]
            ),
            ["doc_id", "set_key"],
        )
    )
    links = (
        _bundles(members, families.count())
        .groupBy("bundle", "block")
        .applyInPandas(_confirm(plan), "a long, b long")
    )
    labels = classes.select("set_key", "doc_id").join(
        components(links).withColumnRenamed("id", "doc_id"), "doc_id", "left"
    )
    labels = labels.select("set_key", F.coalesce("component", "doc_id").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        docs.select("doc_id", "n_shingles", "set_key")
        .join(labels, "set_key", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def representatives(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows, as they are, of one text of every component; of repeated rows one.

    Here a document is a doc_id and a text, told apart by a 64-bit hash of both: each text's own
    component decides about its row, whatever else its doc_id holds. The smallest doc_id of a
    component stays. Rows without a doc_id all stay.
    """
    uid, row = unused(documents, "uid"), unused(documents, "row")
    with_id = documents["doc_id"].isNotNull()
    texts = documents.where(with_id).withColumn(uid, F.xxhash64("doc_id", "text"))
    ids = texts.select(F.col(uid).alias("uid"), F.col("doc_id").alias("of")).distinct()
    found = near_duplicates(texts.select(F.col(uid).alias("doc_id"), "text"), width, percent)
    found = found.select(F.col("doc_id").alias("uid"), "component_id").distinct()
    first = F.min(F.struct("of", "uid")).alias("first")
    kept = found.join(ids, "uid").groupBy("component_id").agg(first)
    once = Window.partitionBy(uid).orderBy(uid)
    ours = (
        texts.join(kept.select(F.col("first.uid").alias(uid)), uid, "left_semi")
        .withColumn(row, F.row_number().over(once))
        .where(F.col(row) == 1)
        .select(*[F.col(f"`{c}`") for c in documents.columns])
    )
    return ours.union(documents.where(~with_id))
