"""Operators on vectors of whole numbers, against plain versions and on awkward rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import catalog, pivot_search, residue_negatives, whitening
from cohortloom.llm.vectors import best

CLASHING = "x dim pivot distance norm seed step slice grp rank score anchor_id query_id n at".split()
SCHEMA = "vec_id long, embedding array<double>, label int"


def wide(spark, rows):
    """Rows with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def clustered(n, dim=8, seed=3, groups=6, spread=0.05):
    """Vectors near a few centres; the first third are copies of one."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    x = centres[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, dim))
    x[: n // 3] = x[0]
    return x


@pytest.fixture(scope="module")
def awkward():
    """Rows of every kind, in a table of 240 with a third of copies."""
    rows = [(i, v.tolist(), i % 4) for i, v in enumerate(clustered(240))]
    rows += [
        (None, [1.0] * 8, 1),
        (1000, None, 1),
        (1001, [], 1),
        (1002, [1.0, None] + [0.0] * 6, 1),
        (1003, [math.nan] + [0.0] * 7, 2),
        (1004, [math.inf] + [0.0] * 7, 2),
        (1005, [0.0] * 8, 3),
        (1006, [0.5] * 5, 3),
        (1007, [0.25] * 8, None),
        rows[20],
        rows[20],
        (40, [9.0] * 8, 1),
    ]
    return rows


def whole(rows, scale, shift=0, dim=8):
    """Rows that take part, as the operators define it."""
    out = []
    for vec_id, v, label in rows:
        if vec_id is None or v is None or len(v) != dim:
            continue
        if any(c is None or not math.isfinite(c) for c in v):
            continue
        out.append((vec_id, [math.floor(scale * c) + shift for c in v], label))
    return out


def dot(a, b):
    return sum(p * q for p, q in zip(a, b))


def one_of_each(rows):
    first = {}
    for row in sorted(rows, key=lambda r: (r[0], r[2] or 0, np.array(r[1], "<i4").tobytes())):
        first.setdefault(row[0], row)
    return list(first.values())


def slow_search(rows, asks, k, scale=64):
    rows = whole(rows, scale)
    out = []
    for q in one_of_each([(i, v, 0) for i, v, _ in rows]):
        if asks(q[0]):
            scored = sorted((-dot(q[1], v), i) for i, v, _ in rows if i != q[0])
            out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def slow_mine(rows, asks, scale=256, dim=8):
    rows = [r for r in whole(rows, scale, dim=dim) if r[2] is not None]
    out = []
    for a in one_of_each(rows):
        if not asks(a[0]):
            continue
        scored = sorted((-dot(a[1], v), i, label) for i, v, label in rows if i != a[0])
        for top, positive, _ in [s for s in scored if s[2] == a[2]][:5]:
            fit = [s for s in scored if s[2] != a[2] and 80 * -top <= 100 * -s[0] <= 100 * -top]
            out += [(a[0], positive, r + 1, i, -top, -s) for r, (s, i, _) in enumerate(fit[:5])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [None, 32])
def test_search_is_exact(spark, awkward, monkeypatch, size):
    if size:  # many slices, groups and annuli
        monkeypatch.setattr(pivot_search, "SLICE", size)
        monkeypatch.setattr(pivot_search, "GROUP", size // 4)
        monkeypatch.setattr(pivot_search, "RING", 8)
        monkeypatch.setattr(pivot_search, "SAMPLE", 50)
    found = pivot_search.search(wide(spark, awkward), F.col("vec_id") % 4 == 0, k=7)
    assert rows_of(found) == slow_search(awkward, lambda i: i % 4 == 0, 7)


@pytest.mark.parametrize("size", [None, 32])
def test_negatives_are_exact(spark, awkward, monkeypatch, size):
    if size:
        for name in ("SLICE", "GROUP", "CHUNK"):
            monkeypatch.setattr(residue_negatives, name, size if name == "SLICE" else 4)
    found = residue_negatives.mine(wide(spark, awkward), F.col("vec_id") % 4 == 0)
    assert rows_of(found) == slow_mine(awkward, lambda i: i % 4 == 0)


def test_fewer_rows_than_asked(spark):
    rows = [(i, [float(i), 1.0], i % 2) for i in range(4)]
    got = rows_of(pivot_search.search(wide(spark, rows), F.col("vec_id") == 2, k=20))
    assert got == [(2, 1, 3, 128 * 192 + 4096), (2, 2, 1, 128 * 64 + 4096), (2, 3, 0, 4096)]
    mined = rows_of(residue_negatives.mine(wide(spark, rows), F.col("vec_id") % 2 == 0))
    assert mined == slow_mine(rows, lambda i: i % 2 == 0, dim=2)


def test_tables_without_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [], 1), (3, [math.nan], 1)]):
        df = wide(spark, rows)
        asked = F.col("vec_id") >= 0
        assert pivot_search.search(df, asked).collect() == []
        assert residue_negatives.mine(df, asked).collect() == []
        assert whitening.whiten(df).collect() == []
    nobody = wide(spark, [(1, [1.0], 1), (2, [2.0], 1)])
    assert pivot_search.search(nobody, F.col("vec_id") < 0).collect() == []
    assert residue_negatives.mine(nobody, F.col("vec_id") < 0).collect() == []


def test_components_that_do_not_fit_are_an_error(spark):
    df = wide(spark, [(1, [1e300], 1), (2, [2.0], 1)])
    with pytest.raises(Exception, match="does not fit"):
        pivot_search.search(df, F.col("vec_id") == 2).collect()


@pytest.mark.parametrize("dim, most", [(3, 5), (64, 170), (3000, 200), (40, 2**21)])
def test_residues_give_exact_signed_scores(dim, most):
    rng = np.random.default_rng(dim)
    a, b = (rng.integers(-most, most + 1, (n, dim)) for n in (9, 21))
    a[0], b[0], b[1] = most, most, -most
    scores = residue_negatives.Scores(a, b)
    assert np.array_equal(scores.part(2, 9), (a @ b.T)[2:])
    assert np.array_equal(scores.part(0, 2), (a @ b.T)[:2])
    product = math.prod(scores.primes)
    assert product > 2 * int(np.abs(a @ b.T).max()) + 1
    assert all(r.dtype == np.float32 and np.abs(r).max() <= 127 for r in scores.a + scores.b)


def test_products_beyond_the_stored_range_are_an_error():
    big = np.full((2, 64), 2**30)
    with pytest.raises(OverflowError):
        residue_negatives.Scores(big, big)
    with pytest.raises(OverflowError):
        pivot_search.products(big, big)


def test_best_takes_ties_from_the_left():
    scores = np.array([[3, 5, 5, 5, 1], [0, 0, 0, 0, 0]])
    row, at = best(scores, np.array([[True] * 5, [False, True, True, False, False]]), 2)
    assert sorted(zip(row.tolist(), at.tolist())) == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_bounds_spare_most_products_of_clustered_vectors():
    x = np.floor(64 * clustered(4000, 16, groups=40, spread=0.02)[1400:]).astype(np.int64)
    ids = np.arange(len(x))
    longest = float(np.sqrt((x * x).sum(axis=1).max()))
    pivots = pivot_search.Pivots.fit(ids[:500], x[:500], longest, 64)
    far = pivots.of_rows(x)
    own = far.argmin(axis=1)
    asked = ids[::20]
    top, who, computed = pivot_search.expand(
        pivots,
        (ids, x, own, far[ids, own]),
        (asked, x[asked], pivots.seeds(asked, x[asked], 10)),
        10,
    )
    assert computed < 0.25 * len(asked) * len(x)
    for q, scores, found in zip(asked, top, who):
        s = x @ x[q]
        order = np.lexsort((ids, -s))
        order = order[order != q][:10]
        assert found.tolist() == order.tolist() and scores.tolist() == s[order].tolist()


def test_annuli_that_tie_with_the_last_score_are_visited():
    x = np.repeat(np.array([[10, 0], [0, 10]]), 600, axis=0)
    ids = np.arange(1200)[::-1].copy()
    pivots = pivot_search.Pivots.fit(ids[:4], x[:4], 10.0, 2)
    far = pivots.of_rows(x)
    asked = np.array([5000])
    top, who, _ = pivot_search.expand(
        pivots,
        (ids, x, far.argmin(axis=1), far.min(axis=1)),
        (asked, np.array([[10, 0]]), pivots.seeds(asked, np.array([[10, 0]]), 3)),
        3,
    )
    assert top.tolist() == [[100] * 3] and who.tolist() == [[600, 601, 602]]


def matrix(values, seed=1):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1.0, 41),
        10.0 ** -np.arange(12),
        np.r_[1 + 1e-9 * np.arange(5), 2 + 1e-13 * np.arange(4), 3, 3.001],
        np.r_[np.ones(6), 2, 2, 5],
        np.zeros(4),
        np.r_[np.zeros(3), 1e-300, 4e-300],
        1e200 * np.arange(1.0, 6),
    ],
)
def test_eigenvectors_to_double_precision(values):
    a = matrix(values)
    a = (a + a.T) / 2
    value, x = whitening.eigenvectors(a)
    size = np.abs(a).max() or 1.0
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 4e-15
    assert np.abs((a / size) @ x - x * (value / size)).max() < 1e-14
    assert (np.diff(value) <= 1e-15 * size).all()
    assert np.allclose(value / size, np.linalg.eigvalsh(a / size)[::-1], atol=4e-15)


def test_float32_vectors_are_not_enough():
    a = matrix(np.arange(1.0, 41))
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(x.T @ x - np.eye(40)).max() > 1e-9


def test_whitened_rows(spark, awkward):
    got = whitening.whiten(wide(spark, awkward), components=5).toPandas()
    rows = whole(awkward, 64, 1_000_000)
    n = len(rows)
    x = np.array([v for _, v, _ in rows], object)
    total = x.sum(axis=0)
    assert set(got["n"]) == {n} and len(got) == 5 * n
    away = sorted((i, int((d * d).sum())) for (i, _, _), d in zip(rows, n * x - total))
    first = got[got["component"] == 1]
    assert sorted(zip(first["vec_id"], map(int, first["deviation"]))) == away
    y = ((n * x - total) / n).astype(float)
    value, vectors = np.linalg.eigh(y.T @ y / n)
    value, vectors = value[::-1][:5], vectors[:, ::-1][:, :5]
    expected = y @ vectors / np.sqrt(value)
    ids = np.array([i for i, _, _ in rows])
    for c in range(5):
        part = got[got["component"] == c + 1]
        want, have = expected[:, c], part["whitened"].to_numpy()
        assert np.allclose(part["explained"], value[c] / (y * y).sum() * n, rtol=1e-10)
        options = [sorted(zip(ids, s * want)) for s in (1, -1)]
        have = sorted(zip(part["vec_id"], have))
        assert any(np.allclose(have, o, atol=1e-8) for o in options)
    assert got["identity_error"].max() < 1e-10 and got["identity_error"].nunique() == 1


def test_flat_directions_have_no_component(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0], 0) for i in range(30)]
    assert whitening.whiten(wide(spark, rows)).select("component").distinct().count() == 1
    same = [(i, [1.0, 2.0], 0) for i in range(5)]
    assert whitening.whiten(wide(spark, same)).collect() == []


def test_deviations_beyond_long_are_exact():
    centre = whitening.Centre(2**40, (2**60 + 1, -5))
    x = np.array([[2**20, -(2**20)]])
    want = (2**60 - 2**60 - 1) ** 2 + (-(2**60) + 5) ** 2
    assert centre.deviation(x) == [want]


@pytest.mark.parametrize(
    "name", ["op11_residue_negatives", "op12_pivot_search"]
)
def test_queries_equal_their_sql(spark, duck, sf_dir, name):
    from checks.run import difference

    assert difference(spark, duck, catalog.QUERIES[name], catalog.ORACLES[name], sf_dir) is None


def test_whitening_query_covers_the_table(spark, sf_dir):
    got = catalog.QUERIES["op13_whitening"](spark, sf_dir).toPandas()
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert len(got) == 32 * n and got["deviation"].dtype == np.int64
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(w.T @ w / n - np.eye(32)).max() < 1e-9
