"""From source tables and a saved model to predictions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.cohorts import rolling_cohort
from cohortloom.functions import scalars as S
from cohortloom.operators import accounts as A
from cohortloom.operators import encoding as E
from cohortloom.operators import learning as L
from cohortloom.operators.commitments import uplift
from cohortloom.operators.sampling import sample_top_n
from cohortloom.plans.features import FeatureSettings, account_features
from cohortloom.plans.training import (
    CODE_COLUMN,
    DIVISION_PREFIX,
    SECTION_PREFIX,
    TYPE_PREFIX,
)
from cohortloom.session import cut_lineage
from cohortloom.sources.sinks import check_free, load_model, write_day, write_predictions
from cohortloom.sources.tables import SourceTables

# Features that the as-run scoring never had under the model's names, so took as 0.
UNNAMED_IN_COMPAT = ("levy_non_levy", "as_months_since_sign_up", "log_employees")
PREDICTED = "levy_model_prediction"


def score_accounts(
    accounts: DataFrame, n: int | None = None, seed: int = 42, ids: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Levy accounts: all, those of a list, or n of these in seeded order with their ids."""
    levy = A.levy_only(accounts)
    if ids is not None:
        levy = A.restrict(levy, ids, "a3")
    if n is None:
        return levy, ids
    sample = cut_lineage(sample_top_n(levy, n, seed))
    return sample, sample.select("a3")


def score_frame(
    tables: SourceTables,
    as_of: date | datetime,
    n: int | None = None,
    seed: int = 42,
    settings: FeatureSettings = FeatureSettings(),
    compat: bool = False,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Features of every scored account as of a day, under the names the model knows.

    ``compat`` counts a commitment as live if it is open on ``as_of``; otherwise, as in
    training, on the first day of the window.
    """
    accounts, ids = score_accounts(tables.accounts, n, seed, ids)
    cohort = rolling_cohort(as_of, compat=compat)
    frame = account_features(tables, accounts, [cohort], ids, settings, members_only=False)
    return A.rename_features(uplift(frame, settings.rules.uplift))


def _values(features: Sequence[str], prefix: str) -> list[str]:
    return [f.removeprefix(f"{prefix}_") for f in features if f.startswith(f"{prefix}_")]


def align_to_model(
    frame: DataFrame, features: Sequence[str], with_code: bool = False, compat: bool = False
) -> E.Aligned:
    """Account id and the model's features; columns the frame does not have become 0.

    A value missing in a row stays so, and the trees send it the way they learned. ``compat``
    leaves out the features the as-run scoring did not have.
    """
    for col, prefix in (
        ("company_type", TYPE_PREFIX),
        ("sic_section", SECTION_PREFIX),
        ("sic_division", DIVISION_PREFIX),
    ):
        if col in frame.columns:
            frame = E.one_hot(frame, col, prefix, _values(features, prefix))
    if compat:
        frame = frame.drop(*UNNAMED_IN_COMPAT)
    keep = ["account_id"]
    if with_code:
        if CODE_COLUMN not in frame.columns:
            frame = frame.withColumn(CODE_COLUMN, F.lit(None).cast("string"))
        keep.append(CODE_COLUMN)
    return E.align(frame, features, keep)


@dataclass(frozen=True)
class Scored:
    predictions: DataFrame
    filled: list[str]


def score(
    frame: DataFrame, model: L.BoostedModel, features: Sequence[str], compat: bool = False
) -> Scored:
    """``account_id`` and predicted commitments; ``compat`` inverts with base 2."""
    with_code = bool(model.nominal)
    aligned = align_to_model(frame, features, with_code, compat)
    value = S.inverse_target(L.PREDICTION, 2 if compat else "e")
    predicted = L.predict(aligned.frame, model).selectExpr("account_id", f"{value} AS {PREDICTED}")
    return Scored(predicted, aligned.filled)


def score_pipeline(
    tables: SourceTables,
    as_of: date | datetime,
    model_path: str,
    out: str | None = None,
    n: int | None = None,
    seed: int = 42,
    settings: FeatureSettings = FeatureSettings(),
    compat: bool = False,
    fmt: str = "csv",
    ids: DataFrame | None = None,
    mode: str = "error",
) -> Scored:
    """Score current accounts with a saved model and write the predictions to ``out``.

    ``ids`` (one column) restricts the accounts. ``mode`` is the writer's: with "error" a folder
    that exists is an error before any work; "day" writes the scoring day's partition and leaves
    those of other days.
    """
    if out is not None and mode == "error":
        check_free(tables.accounts.sparkSession, out)
    model, features = load_model(model_path)
    frame = score_frame(tables, as_of, n, seed, settings, compat, ids)
    scored = score(frame, model, features, compat)
    if out is not None and mode == "day":
        day = as_of.date() if isinstance(as_of, datetime) else as_of
        write_day(scored.predictions, out, day, fmt)
    elif out is not None:
        write_predictions(scored.predictions, out, fmt, mode)
    return scored
