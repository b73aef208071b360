"""Boosted trees against a plain version with no histograms, and contributions against subsets."""

import itertools
import math
import pickle

import numpy as np
import pytest
from pyspark import RDD

from cohortloom.operators import boosting as B
from cohortloom.operators import contributions as X
from cohortloom.operators import learning as L
from cohortloom.sources import load_model, model_versions, save_model

NAN = float("nan")


def table(n=90, seed=5, missing=0.2, spread=3.0):
    """Rows of four numbers, some missing and one always so, a code, and a target."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 4)).round(2)
    x[:, 1] = rng.integers(0, 3, n)
    x[rng.random((n, 4)) < missing] = np.nan
    x[:, 3] = np.nan
    code = [None if rng.random() < 0.1 else "abcdef"[rng.integers(6)] for _ in range(n)]
    y = np.where(np.isnan(x[:, 0]), 2.0, x[:, 0] * x[:, 1].clip(0, 2)) + rng.standard_normal(n)
    y = np.nan_to_num(y, nan=-1.5) + np.array([("ab".find(c or "z") + 1) for c in code])
    return [(*map(float, r), c, float(spread * t)) for r, c, t in zip(x, code, y)]


SCHEMA = "p double, q double, r double, void double, code string, target double"
NUMBERS = ["p", "q", "r", "void"]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


class Plain:
    """Trees by looking at every cut of every column over a node's rows, in plain sums."""

    def __init__(self, x, y, p, columns=None):
        self.x, self.p = x, p
        self.margin = [math.log(p.base_score) if p.objective == "poisson" else p.base_score] * len(y)
        self.base = self.margin[0] if y else 0.0
        self.cuts = [sorted({r[c] for r in x if not math.isnan(r[c])}) for c in range(len(x[0]))]
        self.trees = []
        for t in range(p.max_iter):
            grad = [self.derivatives(m, v) for m, v in zip(self.margin, y)]
            self.allowed = range(len(x[0])) if columns is None else columns(t)
            tree = self.node(list(range(len(y))), grad, p.max_depth)
            self.trees.append(tree)
            self.margin = [m + self.leaf(tree, r) for m, r in zip(self.margin, x)]

    def derivatives(self, m, y):
        return (math.exp(m) - y, math.exp(m)) if self.p.objective == "poisson" else (m - y, 1.0)

    def pull(self, g):
        return math.copysign(max(abs(g) - self.p.l1, 0.0), g)

    def score(self, rows, grad):
        g, h = (math.fsum(grad[i][k] for i in rows) for k in (0, 1))
        return self.pull(g) ** 2 / (h + self.p.l2), g, h

    def goes_left(self, row, c, cut, left):
        return left if math.isnan(row[c]) else row[c] < cut

    def node(self, rows, grad, depth):
        whole, g, h = self.score(rows, grad)
        best, most = None, max(self.p.min_gain, 1e-6)
        for c in self.allowed if depth else []:
            for cut in [*self.cuts[c][1:], math.inf] if self.cuts[c] else []:
                for left in (False, True):
                    a = [i for i in rows if self.goes_left(self.x[i], c, cut, left)]
                    b = [i for i in rows if not self.goes_left(self.x[i], c, cut, left)]
                    if not a or not b:
                        continue
                    (sa, _, ha), (sb, _, hb) = self.score(a, grad), self.score(b, grad)
                    gain = sa + sb - whole
                    if min(ha, hb) >= self.p.min_child_weight and gain > most + 1e-10:
                        best, most = (c, cut, left, a, b), gain
        if best is None:
            return self.p.step_size * -self.pull(g) / (h + self.p.l2)
        c, cut, left, a, b = best
        return c, cut, left, self.node(a, grad, depth - 1), self.node(b, grad, depth - 1)

    def leaf(self, tree, row):
        while isinstance(tree, tuple):
            c, cut, left, a, b = tree
            tree = a if self.goes_left(row, c, cut, left) else b
        return tree

    def predict(self, row):
        m = self.base + sum(self.leaf(t, row) for t in self.trees)
        return math.exp(m) if self.p.objective == "poisson" else m


def hot(rows):
    """Numbers with a 0/1 column for each code."""
    codes = sorted({r[4] for r in rows if r[4] is not None})
    return [[*r[:4], *[float(r[4] == c) for c in codes]] for r in rows]


def predictions(spark, model, rows):
    wide = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id int, {SCHEMA}")
    return [r.prediction for r in B.predict(wide, model).orderBy("id").collect()]


def fresh(rows):
    """Rows the fit has not seen: other numbers, a missing one in each place, unknown codes."""
    return rows[:30] + [
        (NAN, NAN, NAN, NAN, "zz", 0.0),
        (9.0, -4.0, 0.33, 1.0, None, 0.0),
        (-9.0, 0.5, NAN, NAN, "a", 0.0),
    ]


SETTINGS = {
    "defaults": B.BoostParams(max_iter=6, max_depth=4),
    "l1": B.BoostParams(max_iter=6, max_depth=3, l1=10.0, l2=0.5),
    "heavy children": B.BoostParams(max_iter=4, max_depth=5, min_child_weight=9.0, min_gain=2.0),
    "counts": B.BoostParams(max_iter=5, max_depth=3, objective="poisson", base_score=1.5),
}


@pytest.mark.parametrize("name", SETTINGS)
def test_equal_to_the_plain_version(spark, name):
    params, rows = SETTINGS[name], table()
    if params.objective == "poisson":
        rows = [(*r[:5], float(round(abs(r[5])))) for r in rows]
    model = B.fit(frame(spark, rows), NUMBERS, params, nominal=["code"])
    plain = Plain(hot(rows), [r[5] for r in rows], params)
    new = fresh(rows)
    widened = [[*r[:4], *[float(r[4] == c) for c in "abcdef"]] for r in new]
    assert predictions(spark, model, new) == pytest.approx(
        [plain.predict(r) for r in widened], abs=1e-9
    )
    assert any(t.members for t in model.trees) and any(t.missing_left.any() for t in model.trees)


def test_careful_settings_run_whole(spark):
    """700 trees of depth 5, a third of the columns each, and an L1 penalty of 10."""
    params, rows = L.CAREFUL_PARAMS, table(40, spread=3.0)
    assert (params.max_iter, params.max_depth, params.l1, params.column_sample) == (700, 5, 10, 0.3)
    model = B.fit(frame(spark, rows), NUMBERS, params, nominal=["code"])
    layout = B.Layout(B.find_columns(frame(spark, rows), NUMBERS, ["code"], params.max_bins))

    def columns(tree):
        allowed = layout.sampled(params, tree)
        numbers = [i for i in range(4) if allowed[layout.start[i] :][: layout.columns[i].size].any()]
        return numbers + [4 + k for k in range(6) if allowed[layout.start[4] + 1 + k]]

    assert {len(columns(t)) for t in range(20)} <= {2, 3} and columns(0) != columns(1)
    plain = Plain(hot(rows), [r[5] for r in rows], params, columns)
    assert predictions(spark, model, rows) == pytest.approx(
        [plain.predict(r) for r in hot(rows)], abs=1e-9
    )


def test_codes_split_as_real_columns_do(spark):
    """700 codes in one histogram: the splits of 0/1 columns, other columns' bins as they were."""
    rng = np.random.default_rng(1)
    codes = [f"c{k:03d}" for k in range(700)]
    rows = [(float(rng.standard_normal()), codes[int(k)]) for k in rng.integers(0, 700, 2100)]
    rows = [(x, c, x + 9.0 * (int(c[1:]) % 50 == 7)) for x, c in rows]
    df = spark.createDataFrame(rows, "x double, code string, target double")
    params = B.BoostParams(max_iter=2, max_depth=3, max_bins=64)
    columns = B.find_columns(df, ["x"], ["code"], params.max_bins)
    assert columns[0] == B.find_columns(df, ["x"], [], params.max_bins)[0]
    assert len(columns[0].cuts) <= 64 and columns[1].size == 1 + len({c for _, c, _ in rows})
    seen = list(columns[1].labels)
    real = spark.createDataFrame(
        [(x, *[float(c == k) for k in seen], y) for x, c, y in rows], ["x", *seen, "target"]
    )
    bundled = B.fit(df, ["x"], params, nominal=["code"])
    apart = B.fit(real, ["x", *seen], params)
    splits = [
        [(t, n, feature if labels is None else labels[0]) for t, n, feature, _, labels, *_ in m.nodes()]
        for m in (bundled, apart)
    ]
    assert splits[0] == splits[1]
    assert [r[6:] for r in bundled.nodes()] == [r[6:] for r in apart.nodes()]
    assert len({s[2] for s in splits[0]} & set(codes)) > 1


def test_the_fit_does_not_depend_on_how_rows_are_dealt(spark):
    rows = table(200)
    fits = [
        B.fit(frame(spark, r, parts), NUMBERS, SETTINGS["defaults"], nominal=["code"]).nodes()
        for r, parts in ((rows, 1), (rows[::-1], 7))
    ]
    assert str(fits[0]) == str(fits[1])


def test_many_parts_and_stored_margins(spark, monkeypatch):
    rows, params = table(200), B.BoostParams(max_iter=7, max_depth=3)
    whole = B.fit(frame(spark, rows), NUMBERS, params, nominal=["code"]).nodes()
    monkeypatch.setattr(B, "EVERY", 2)
    monkeypatch.setattr(B, "PART", 30)
    assert str(B.fit(frame(spark, rows), NUMBERS, params, nominal=["code"]).nodes()) == str(whole)


def test_cuts_at_quantiles(spark):
    df = spark.range(20_000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 5 AS DOUBLE) AS few")
    many, few = B.find_columns(df, ["x", "few"], [], 16)
    assert len(many.cuts) <= 16 and few.cuts == (0.0, 1.0, 2.0, 3.0, 4.0)
    assert np.allclose(np.diff(many.cuts), 1250, atol=60)
    rows = df.selectExpr("*", "CAST(x >= 5000 AS DOUBLE) * 8 AS target")
    model = B.fit(rows, ["x", "few"], B.BoostParams(max_iter=12, max_depth=2, max_bins=64))
    off = B.predict(rows, model).selectExpr("avg(double(abs(prediction - target) > 0.3))").first()[0]
    assert off < 0.02  # a bin is 1/64 of the rows


def test_ordered_categories_cut_many_codes_at_once(spark):
    rows = [(float(i % 7), f"c{i % 60}", float(i % 60)) for i in range(600)]
    df = spark.createDataFrame(rows, "x double, code string, target double")
    params = B.BoostParams(max_iter=3, max_depth=4, max_bins=16, categories="ordered", step_size=0.8)
    model = B.fit(df, ["x"], params, nominal=["code"])
    scored = B.predict(df, model)
    assert L.evaluate(scored, 2, target="target").first().r2 > 0.9


@pytest.mark.parametrize(
    "rows",
    [[], [(1.0, 1.0, 1.0, 1.0, "a", None)]],
)
def test_no_row_to_fit_on_is_an_error(spark, rows):
    with pytest.raises(ValueError, match="no rows"):
        B.fit(spark.createDataFrame(rows, SCHEMA), NUMBERS, nominal=["code"])


def test_rows_without_a_target_are_left_out(spark):
    rows = table(60)
    more = [*rows, *[(*r[:5], None) for r in rows[:20]]]
    params = SETTINGS["defaults"]
    fits = [B.fit(frame(spark, r), NUMBERS, params, nominal=["code"]).nodes() for r in (rows, more)]
    assert str(fits[0]) == str(fits[1])


def test_one_constant_target(spark):
    rows = [(*r[:5], 2.0) for r in table(20)]
    model = B.fit(frame(spark, rows), NUMBERS, SETTINGS["defaults"], nominal=["code"])
    assert len(set(predictions(spark, model, rows))) == 1


def by_subsets(model, row):
    """Shapley values from the mean of every subset of features."""
    n = len(model.columns)

    def mean(tree, node, known):
        c = int(tree.column[node])
        if c < 0:
            return tree.value[node]
        children = (2 * node + 1, 2 * node + 2)
        if c not in known:
            return sum(tree.cover[k] / tree.cover[node] * mean(tree, k, known) for k in children)
        one = np.array([row])
        return mean(tree, children[int(X._sides(tree, one)[node][0])], known)

    def value(known):
        return model.base + sum(mean(t, 0, known) for t in model.trees)

    out = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        total = 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for known in itertools.combinations(rest, size):
                total += weight * (value({*known, i}) - value(set(known)))
        out.append(total)
    return out, value(set())


@pytest.mark.parametrize("categories", ["one_hot", "ordered"])
def test_contributions_equal_all_subsets(spark, categories):
    rows = table(120)
    params = B.BoostParams(max_iter=4, max_depth=5, categories=categories)
    model = B.fit(frame(spark, rows), NUMBERS, params, nominal=["code"])
    wide = spark.createDataFrame([(i, *r) for i, r in enumerate(fresh(rows))], f"id int, {SCHEMA}")
    found = X.contribution_rows(B.predict(wide, model), model).orderBy("id").collect()
    for r in found:
        code = 1 + "abcdef".find(r.code or "z")
        row = [*[NAN if v is None else v for v in (r.p, r.q, r.r, r.void)], float(max(code, 0))]
        want, expected = by_subsets(model, row)
        assert r.contributions == pytest.approx(want, abs=1e-9)
        assert r.expected == pytest.approx(expected, abs=1e-9)
        assert sum(r.contributions) + r.expected == pytest.approx(r.prediction, abs=1e-9)
    mean = {r.feature: r.contribution for r in X.mean_contributions(wide, model).collect()}
    for i, c in enumerate(model.columns):
        assert mean[c.name] == pytest.approx(np.mean([abs(r.contributions[i]) for r in found]))
    assert mean["void"] == 0.0


def test_versions_are_kept(spark, tmp_path):
    rows, path = table(60), str(tmp_path / "model")
    models = [
        B.fit(frame(spark, rows), NUMBERS, B.BoostParams(max_iter=n, max_depth=3), nominal=["code"])
        for n in (2, 3)
    ]
    names = [save_model(m, [*NUMBERS, "code"], path) for m in models]
    assert names == sorted(names) and model_versions(spark, path).count() == 2
    latest, features = load_model(path)
    assert features == [*NUMBERS, "code"] and str(latest.nodes()) == str(models[1].nodes())
    first, _ = load_model(path, names[0])
    new = fresh(rows)
    assert predictions(spark, first, new) == predictions(spark, models[0], new)
    # nodes without the row that names their version are no version
    B.stored_nodes(spark, models[0]).write.parquet(f"{path}/versions/99999999999999999999-torn")
    assert str(load_model(path)[0].nodes()) == str(models[1].nodes())
    with pytest.raises(LookupError):
        load_model(path, "none")


def test_the_driver_gets_no_histogram(spark, monkeypatch):
    """Rows in three tasks give the trees of one, and only splits reach the driver."""
    rng = np.random.default_rng(2)
    rows = [(float(p), float(p % 7), NAN, NAN, "abc"[p % 3], float(y)) for p, y in
            enumerate(rng.standard_normal(3000))]
    params = B.BoostParams(max_iter=2, max_depth=3, max_bins=4096)
    whole = B.fit(frame(spark, rows), NUMBERS, params, nominal=["code"]).nodes()
    sizes, collect, counts = [], RDD.collect, RDD.getNumPartitions

    def measured(rdd):
        found = collect(rdd)
        sizes.append((len(pickle.dumps(found)), counts(rdd)))
        return found

    monkeypatch.setattr(B, "PART", 1000)
    monkeypatch.setattr(RDD, "collect", measured)
    assert B.fit(frame(spark, rows), NUMBERS, params, nominal=["code"]).nodes() == whole
    assert len(sizes) == 6 and max(n for _, n in sizes) > 1
    assert max(size for size, _ in sizes) < 5000  # a histogram has over 3000 bins of 16 bytes
