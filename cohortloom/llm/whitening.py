"""Whitening: unit eigenvectors of the covariance, from float32 to full double precision.

Components become whole numbers first, so that their sums are exact. The covariance is a sum of
centred products made by each task for its rows; tasks' matrices are added up in two steps, and
only one matrix of the vectors' length squared reaches the driver. Its eigenvectors are found in
float32 and then corrected by matrix products in extended precision (iterations of Ogita and
Aishima): the deviation from orthogonality and the off-diagonal part together give a correction
that squares the error each time. Where eigenvalues lie too close for that division, the vectors
of the cluster are only made orthogonal, and a small eigenproblem within the cluster, shifted to
its middle, turns them.

Defined cases: rows without a vec_id or with a vector that is null, empty, or holds null or
non-finite components take no part, nor do vectors of another length than the most frequent one
(of several, the longest); each repeated row is another row; other columns are ignored. A component
whose eigenvalue is not above 1e-13 of the trace has no scale and is left out, so equal vectors,
or a table without vectors, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.vectors import common_length, unpack, whole_vectors

BUCKETS = 64
FLAT = 1e-13
#: Gaps between eigenvalues that count as none, in units of rounding; the last step but one.
CLOSE, DONE = 1e10, 1e-9
RESULT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


@dataclass(frozen=True)
class Centre:
    """Number of vectors and the exact sum of every dimension."""

    n: int
    sums: tuple[int, ...]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if most < 2**62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> list[int]:
        d = self.scaled(x)
        if d.dtype != object and d.shape[1] * int(np.abs(d).max(initial=0)) ** 2 >= 2**62:
            d = d.astype(object)
        return (d * d).sum(axis=1).tolist()


def find_centre(rows: DataFrame, dim: int) -> Centre:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, np.zeros(dim, np.int64)
        for batch in batches:
            n += len(batch)
            total += unpack(batch["x"], dim).sum(axis=0)
        yield pd.DataFrame({"at": np.arange(dim), "n": n, "total": total})

    parts = rows.select("x").mapInPandas(run, "at int, n long, total long")
    sums = parts.groupBy("at").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    found = sorted(sums.collect())
    return Centre(found[0]["n"], tuple(int(r["total"]) for r in found))


def add_up(rows: DataFrame, size: int, values) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and sums of products, of the ``size`` values that a function makes of each vector."""
    schema = "bucket int, part binary"

    def pack(bucket: int, part: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [bucket], "part": [part.tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = np.zeros((size + 1, size))
        for batch in batches:
            y = values(batch["x"])
            part[0] += y.sum(axis=0)
            part[1:] += y.T @ y
        yield pack(TaskContext.get().partitionId() % BUCKETS, part)

    def join(group: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros((size + 1, size))
        for one in group["part"]:
            part += np.frombuffer(one).reshape(size + 1, size)
        return pack(0, part)

    parts = rows.select("x").mapInPandas(run, schema)
    for _ in range(2):  # by bucket, then the buckets
        parts = parts.groupBy("bucket").applyInPandas(join, schema)
    total = np.frombuffer(parts.first()["part"]).reshape(size + 1, size)
    return total[0], total[1:]


def eigenvectors(v: np.ndarray, most: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, both to double precision.

    A correction divides by a gap between eigenvalues, and so carries the rounding of the products
    over the gap. Gaps below CLOSE keep that at 1e-10, whose square is beyond double precision;
    closer values are a cluster. Once a correction is below DONE, one more leaves only rounding.
    """
    unit = np.abs(v).max() or 1.0
    a = v.astype(np.longdouble) / unit
    one = np.eye(len(a), dtype=np.longdouble)
    least = CLOSE * np.finfo(np.longdouble).eps * _norm(a)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    done = False
    for _ in range(most):
        x = x[:, np.argsort(-_values(a, x), kind="stable")]
        r, s = one - x.T @ x, x.T @ (a @ x)
        s = (s + s.T) / 2  # else its rounding, over a gap, takes the vectors apart
        value = np.diag(s) / (1 - np.diag(r))
        off = _norm(s - np.diag(value)) + _norm(a) * _norm(r)
        gap = value[None, :] - value[:, None]
        near = np.abs(gap) <= max(2 * off, least)
        step = np.where(near, r / 2, (s + value * r) / np.where(near, 1, gap))
        x = x + x @ step
        if done:
            break
        done = 2 * off <= least and np.abs(step).max() < DONE
        x = _turn_clusters(a, x, value, near)
    x /= np.sqrt((x * x).sum(axis=0))
    value = _values(a, x)
    order = np.argsort(-value, kind="stable")
    x = x[:, order]
    x *= np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])
    return (value[order] * unit).astype(np.float64), x.astype(np.float64)


def _norm(m: np.ndarray) -> np.longdouble:
    return np.sqrt((m * m).sum())


def _values(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (x * (a @ x)).sum(axis=0) / (x * x).sum(axis=0)


def _turn_clusters(a, x, value, near) -> np.ndarray:
    """Solve the eigenproblem within each run of neighbours that are too close to be divided."""
    low = 0
    for high in range(1, len(value) + 1):
        if high < len(value) and near[high - 1, high]:
            continue
        if high - low > 1:
            part = x[:, low:high]
            middle = value[low:high].mean()
            inner = part.T @ (a @ part - middle * part)
            size = np.abs(inner).max()
            if size > 0:  # at the scale of the cluster, whose values differ little
                inner = ((inner + inner.T) / (2 * size)).astype(np.float64)
                turn = np.linalg.eigh(inner)[1][:, ::-1]
                x[:, low:high] = part @ turn.astype(np.longdouble)
        low = high
    return x


def whiten(
    embeddings: DataFrame, scale: float = 64, shift: int = 1_000_000, components: int = 32
) -> DataFrame:
    """A row for every vector and component, of RESULT.

    deviation: sum over dimensions of (n * x - sum)**2; whitened: x without its mean, projected on
    the component, over the root of its eigenvalue; explained: the eigenvalue's share of the trace;
    identity_error: the largest absolute entry of the whitened vectors' covariance, computed over
    all of them, without the identity.
    """
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, scale, shift)
    dim = common_length(rows)
    if dim is None:
        return spark.createDataFrame([], T._parse_datatype_string(RESULT))
    rows = rows.where(F.col("dim") == dim)
    centre = find_centre(rows, dim)
    n = centre.n
    shares, maps = _fit(rows, centre, dim, components)
    k = len(shares)

    def project(packed) -> np.ndarray:
        return centre.centred(unpack(packed, dim)) @ maps

    error = 0.0
    if k:
        mean, products = add_up(rows, k, project)
        error = float(np.abs(products / n - np.outer(mean, mean) / n**2 - np.eye(k)).max())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            away = centre.deviation(unpack(batch["x"], dim))
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "deviation": [Decimal(d) for d in away],
                    "values": list(project(batch["x"])),
                }
            )

    schema = "vec_id long, deviation decimal(38,0), values array<double>"
    wide = rows.select("vec_id", "x").mapInPandas(run, schema)
    wide = wide.select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened"))
    return wide.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(shares).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _fit(rows: DataFrame, centre: Centre, dim: int, components: int):
    """Shares of the trace, and the matrix that takes a centred vector to its whitened one."""
    _, products = add_up(rows, dim, lambda packed: centre.centred(unpack(packed, dim)))
    covariance = products / centre.n
    trace = float(np.trace(covariance))
    value, vectors = eigenvectors((covariance + covariance.T) / 2)
    k = int((value[:components] > FLAT * trace).sum())
    return (value[:k] / trace if k else value[:0]).tolist(), vectors[:, :k] / np.sqrt(value[:k])
