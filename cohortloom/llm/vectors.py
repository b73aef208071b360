"""Vectors of whole numbers: reading them from a column of arrays, exact products, best columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components and scores beyond these are an error: they do not fit what is stored and compared.
MOST_COMPONENT, MOST_SCORE = 2**31, 2**48
LOW = np.iinfo(np.int64).min


def whole_vectors(
    embeddings: DataFrame, scale: float, shift: int = 0, label: str | None = None
) -> DataFrame:
    """``vec_id``, ``label`` (if named), ``dim`` and ``x``: floor(scale * component) + shift.

    ``x`` is packed as 32-bit numbers. Rows whose vec_id, label or vector is null, whose vector is
    empty or holds a null or a component that is not finite are left out. A scaled component of
    2**31 or more is an error, since no row may be changed or lost in silence.
    """
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding")]
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    if label is not None:
        rows = rows.where(F.col(label).isNotNull())
        columns.append(F.col(label).cast("long").alias("label"))
    kept = ["vec_id"] + (["label"] if label is not None else [])
    schema = ", ".join(f"{c} long" for c in kept) + ", dim int, x binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            cuts = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            bad = np.r_[0, np.cumsum(~np.isfinite(values))]
            good = np.flatnonzero((np.diff(cuts) > 0) & (bad[cuts[1:]] == bad[cuts[:-1]]))
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(scale * values) + shift
            spans = [(cuts[i], cuts[i + 1]) for i in good]
            for low, high in spans:
                if np.abs(whole[low:high]).max() >= MOST_COMPONENT:
                    raise OverflowError("a scaled component does not fit 32 bits")
            whole = np.where(np.abs(whole) < MOST_COMPONENT, whole, 0).astype("<i4")
            taken = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(taken) for c in kept]
                + [
                    pa.array([high - low for low, high in spans], pa.int32()),
                    pa.array([whole[low:high].tobytes() for low, high in spans], pa.binary()),
                ],
                names=[*kept, "dim", "x"],
            )

    return rows.select(*columns).mapInArrow(run, schema)


def common_length(rows: DataFrame) -> int | None:
    """The most frequent length of vectors, of several the largest; None without vectors.

    Vectors of another length have no product with these and take no part.
    """
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    return None if first is None else first["dim"]


def unpack(packed, dim: int) -> np.ndarray:
    """Packed vectors as a matrix of 64-bit numbers."""
    return np.frombuffer(b"".join(packed), "<i4").reshape(-1, dim).astype(np.int64)


def score_bound(a: np.ndarray, b: np.ndarray) -> int:
    """No product of a row of a and one of b is larger in absolute value."""
    if not (a.size and b.size):
        return 0
    most = a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max())
    norms = [float((m.astype(np.float64) ** 2).sum(axis=1).max()) for m in (a, b)]
    bound = min(most, int((norms[0] * norms[1]) ** 0.5 * (1 + 1e-9)) + 1)
    if bound >= MOST_SCORE:
        raise OverflowError("products of these vectors are too large to be compared exactly")
    return bound


def best(scores: np.ndarray, keep: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k highest scores among those to keep, ties to the left."""
    n = scores.shape[1]
    keys = np.where(keep, scores * n + np.arange(n - 1, -1, -1), LOW)
    k = min(k, n)
    at = np.argpartition(keys, n - k, axis=1)[:, n - k :]
    row, j = np.nonzero(np.take_along_axis(keys, at, axis=1) > LOW)
    return row, at[row, j]


def spread(parts: int) -> Column:
    """A part for each row that follows neither ids nor values, so that parts are even."""
    return F.floor(F.rand(17) * parts).cast("int")
