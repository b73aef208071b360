"""What each feature adds to a prediction, over the paths of boosted trees.

A feature's contribution is its Shapley value where a feature that is left out sends a row down
both sides, in the shares the fit's rows went. For a leaf only the features on its path matter: the
weight of a subset of them depends on its size alone, so a polynomial in the number of features
that hold for the row carries all subsets at once, and one feature is divided out of it at a time.
Rows are a vector in every step, tasks take Arrow batches, and the sums over rows are added across
tasks. A nominal column is one feature, whatever labels its splits name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.boosting import BoostedModel, Tree, _inputs

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _leaves(tree: Tree) -> Iterator[tuple[int, dict[int, tuple[float, list]]]]:
    """Leaves with, by column on their path, the share of rows that follow, and the steps."""
    todo = [(0, {})]
    while todo:
        node, path = todo.pop()
        column = int(tree.column[node])
        if column < 0:
            yield node, path
            continue
        for side in (0, 1):
            child = 2 * node + 1 + side
            share, steps = path.get(column, (1.0, []))
            share *= tree.cover[child] / tree.cover[node]
            todo.append((child, path | {column: (share, [*steps, (node, side)])}))


def _sides(tree: Tree, matrix: np.ndarray) -> dict[int, np.ndarray]:
    """For every split, whether each row would go right there."""
    out = {}
    for node in np.flatnonzero(tree.column >= 0):
        v = matrix[:, tree.column[node]]
        if node in tree.members:
            out[node] = tree.members[node][v.astype(np.int64)]
        else:
            out[node] = np.where(np.isnan(v), not tree.missing_left[node], v >= tree.threshold[node])
    return out


def contributions(matrix: np.ndarray, model: BoostedModel) -> tuple[np.ndarray, float]:
    """Contributions by row and column, and what every row has without any feature."""
    out, expected = np.zeros(matrix.shape), model.base
    for tree in model.trees:
        right = _sides(tree, matrix)
        for leaf, path in _leaves(tree):
            value = tree.value[leaf]
            expected += value * np.prod([share for share, _ in path.values()])
            columns, shares, follows = [], [], []
            for column, (share, steps) in path.items():
                columns.append(column)
                shares.append(share)
                follows.append(np.all([right[node] == bool(side) for node, side in steps], axis=0))
            if columns:
                _spread(out, columns, shares, follows, value)
    return out, expected


def _spread(out, columns, shares, follows, value) -> None:
    """Add one leaf's contributions. weights[k]: subsets of which k features hold, by size."""
    n, m = len(out), len(columns)
    weights = np.zeros((m + 1, n))
    weights[0] = 1.0
    for size, (share, follow) in enumerate(zip(shares, follows), 1):
        for k in range(size, -1, -1):
            kept = share * weights[k] * (size - k) if k < size else 0.0
            grown = follow * weights[k - 1] * k if k else 0.0
            weights[k] = (kept + grown) / (size + 1)
    for column, share, follow in zip(columns, shares, follows):
        with_it, without = np.zeros(n), np.zeros(n)
        above = weights[m].copy()
        for k in range(m - 1, -1, -1):
            # divided by the feature where it holds, and where it does not
            part = above * (m + 1) / (k + 1)
            with_it += part
            above = weights[k] - part * share * (m - k) / (m + 1)
            without += weights[k] * (m + 1) / (share * (m - k))
        out[:, column] += value * np.where(follow, with_it * (1 - share), -without * share)


def contribution_rows(df: DataFrame, model: BoostedModel) -> DataFrame:
    """Input columns with ``contributions``, in the order of the model's columns, and ``expected``.

    Their sum is the margin: the prediction itself where the loss is the squared error.
    """

    @F.pandas_udf("contributions array<double>, expected double")
    def run(*series: pd.Series) -> pd.DataFrame:
        found, expected = contributions(model.matrix(series), model)
        return pd.DataFrame({"contributions": list(found), "expected": expected})

    return df.withColumn("_found", run(*_inputs(model.columns))).select(*df.columns, "_found.*")


def mean_contributions(df: DataFrame, model: BoostedModel) -> DataFrame:
    """feature, contribution: the mean absolute one over all rows, largest first."""
    names = [c.name for c in model.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(names)), 0
        for batch in batches:
            found, _ = contributions(model.matrix([batch[c] for c in names]), model)
            total, n = total + np.abs(found).sum(axis=0), n + len(batch)
        yield pd.DataFrame({"feature": names, "total": total, "n": n})

    sums = df.select(*_inputs(model.columns)).mapInPandas(
        run, "feature string, total double, n long"
    )
    mean = F.try_divide(F.sum("total"), F.sum("n")).alias("contribution")
    return sums.groupBy("feature").agg(mean).orderBy(F.desc("contribution"), "feature")
