"""Gradient-boosted regression: fit, predict, evaluate, importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators import boosting as B
from cohortloom.operators.boosting import BoostedModel, BoostParams

TARGET = "log_adjusted_commitments"
PREDICTION = "prediction"

# Slower, smaller steps, an L1 penalty, and a third of the features for each tree.
CAREFUL_PARAMS = BoostParams(
    max_iter=700, max_depth=5, step_size=0.05, l1=10.0, column_sample=0.3
)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``features`` vector in the given order; a NULL in any of them is an error."""
    return VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="error"
    ).transform(df)


def train(
    df: DataFrame,
    features: Sequence[str],
    params: BoostParams = BoostParams(),
    target: str = TARGET,
    categorical: Sequence[str] = (),
) -> BoostedModel:
    """Fit on numeric features and on categorical columns, a 0/1 column for each of their labels.

    Missing numbers take the side that fits them better; an unseen or missing label is none of
    those the trees name.
    """
    return B.fit(df, features, params, target, categorical)


def predict(df: DataFrame, model: BoostedModel) -> DataFrame:
    """Input columns with ``prediction``."""
    return B.predict(df, model, PREDICTION)


def evaluate(
    df: DataFrame, features: int, target: str = TARGET, prediction: str = PREDICTION
) -> DataFrame:
    """One row: rows, R^2, adjusted R^2 and RMSE, from one aggregation."""
    y, error = F.col(target), F.col(target) - F.col(prediction)
    sums = df.agg(
        F.count("*").alias("rows"),
        (F.var_pop(y) * F.count(y)).alias("total"),
        F.sum(error * error).alias("residual"),
    )
    n = F.col("rows")
    scored = sums.withColumn("r2", 1 - F.try_divide(F.col("residual"), F.col("total")))
    return scored.select(
        "rows",
        "r2",
        (1 - F.try_divide((1 - F.col("r2")) * (n - 1), n - features - 1)).alias("adjusted_r2"),
        F.sqrt(F.try_divide(F.col("residual"), n)).alias("rmse"),
    )


def importance(model: BoostedModel) -> DataFrame:
    """Share of the total gain per feature, largest first; a categorical column is one feature."""
    gains = dict.fromkeys([c.name for c in model.columns], 0.0)
    for tree in model.trees:
        for column, gain in zip(tree.column, tree.gain):
            if column >= 0:
                gains[model.columns[column].name] += float(gain)
    total = sum(gains.values()) or 1.0
    rows = [(name, gain / total) for name, gain in gains.items()]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
