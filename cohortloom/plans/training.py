"""From source tables to a saved model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortloom.cohorts import TRAINING_COHORTS, Cohort
from cohortloom.functions import predicates as P
from cohortloom.functions import scalars as S
from cohortloom.operators import accounts as A
from cohortloom.operators import encoding as E
from cohortloom.operators import learning as L
from cohortloom.operators.commitments import OCCUPATION_CODES, share_columns
from cohortloom.operators.sampling import (
    TRAINING_STRATA,
    Stratum,
    hash_split,
    inside,
    sample_stratified,
)
from cohortloom.plans.features import FeatureSettings, account_features
from cohortloom.session import cut_lineage
from cohortloom.sources.sinks import save_model
from cohortloom.sources.tables import SourceTables

KEYS = ("account_id", "cohort")
CODE_COLUMN = "new_sic_code"
ELIGIBLE_STATUS = 3
TYPE_PREFIX, SECTION_PREFIX, DIVISION_PREFIX = "comp_type", "sic_section", "sic_division"


def training_accounts(
    accounts: DataFrame,
    strata: Sequence[Stratum] = TRAINING_STRATA,
    n: int | None = None,
    seed: int = 42,
    ids: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Up to n accounts per stratum with their ids; without n, every account in a stratum.

    ``ids`` (one column) restricts both. A sample is drawn once, since every scan that follows is
    restricted to it.
    """
    if ids is not None:
        accounts = A.restrict(accounts, ids, "a3")
    if n is None:
        return accounts.where(P.any_of(map(inside, strata))), ids
    sample = cut_lineage(sample_stratified(accounts, strata, n, seed))
    return sample, sample.select("a3")


def raw_training_frame(
    tables: SourceTables,
    cohorts: Sequence[Cohort] = TRAINING_COHORTS,
    strata: Sequence[Stratum] = TRAINING_STRATA,
    n: int | None = None,
    seed: int = 42,
    settings: FeatureSettings = FeatureSettings(),
    levy_accounts_only: bool = False,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Eligible accounts by cohort, every feature but the one-hot ones, and the target."""
    population = A.levy_only(tables.accounts) if levy_accounts_only else tables.accounts
    accounts, ids = training_accounts(population, strata, n, seed, ids)
    frame = account_features(tables, accounts, cohorts, ids, settings)
    status = ELIGIBLE_STATUS if settings.use_industry else None
    return A.eligible(frame, status=status).selectExpr(
        "*", f"{S.log_target('total_commitments')} AS {L.TARGET}"
    )


def numeric_features(codes: Sequence[str] = OCCUPATION_CODES) -> tuple[list[str], list[str]]:
    """Features before and after the company-type columns, in model order."""
    return (
        [
            "early_adopter",
            "levy_non_levy",
            "as_months_since_sign_up",
            *share_columns(codes),
            "prev_12m_new_commitments",
            "prev_12m_new_levy_transfers",
            "levy_sending_company",
            "commitments_ending_12m",
            "current_live_commitments",
        ],
        ["years_since_tpr_signup", "new_company", "log_employees"],
    )


def encoded(
    frame: DataFrame,
    settings: FeatureSettings = FeatureSettings(),
    types: Sequence[str] | None = None,
    sections: Sequence[str] | None = None,
    divisions: Sequence[str] | None = None,
) -> DataFrame:
    """Keys, features in model order and target; values not given are looked up in the data."""
    frame = E.one_hot(frame, "company_type", TYPE_PREFIX, types)
    first, last = numeric_features(settings.codes)
    industry: list[str] = []
    if settings.use_industry:
        frame = E.one_hot(frame, "sic_section", SECTION_PREFIX, sections)
        frame = E.one_hot(frame, "sic_division", DIVISION_PREFIX, divisions)
        prefixes = (f"{SECTION_PREFIX}_", f"{DIVISION_PREFIX}_")
        industry = [c for c in frame.columns if c.startswith(prefixes)]
        industry = [*industry, CODE_COLUMN]
    hot = [c for c in frame.columns if c.startswith(f"{TYPE_PREFIX}_")]
    renamed = A.rename_features(frame)
    present = [c for c in [*KEYS, *first, *hot, *last, *industry, L.TARGET] if c in renamed.columns]
    return renamed.select(*present)


def training_frame(
    tables: SourceTables,
    cohorts: Sequence[Cohort] = TRAINING_COHORTS,
    strata: Sequence[Stratum] = TRAINING_STRATA,
    n: int | None = None,
    seed: int = 42,
    settings: FeatureSettings = FeatureSettings(),
    levy_accounts_only: bool = False,
    ids: DataFrame | None = None,
) -> DataFrame:
    """The frame the model is fitted on: encoded, constant columns and incomplete rows dropped.

    The raw frame is written once; category lookup, profile and fit then read it back.
    """
    raw = cut_lineage(
        raw_training_frame(tables, cohorts, strata, n, seed, settings, levy_accounts_only, ids)
    )
    frame = encoded(raw, settings)
    varying = E.drop_constant(frame, protect=[*KEYS, L.TARGET, CODE_COLUMN])
    return A.drop_missing(varying, [c for c in varying.columns if c != CODE_COLUMN])


@dataclass(frozen=True)
class Trained:
    model: L.BoostedModel
    features: list[str]
    metrics: DataFrame
    importance: DataFrame


def train_pipeline(
    frame: DataFrame,
    params: L.BoostParams = L.BoostParams(),
    path: str | None = None,
    test: float = 0.25,
    seed: int = 7,
    split_key: str = "row",
) -> Trained:
    """Split, fit, evaluate on the held-out part, and save when a path is given.

    ``split_key="account"`` keeps all cohorts of an account on one side of the split.
    """
    if frame.isEmpty():
        raise ValueError("no complete, eligible rows to train on")
    categorical = [c for c in frame.columns if c == CODE_COLUMN]
    features = [c for c in frame.columns if c not in (*KEYS, L.TARGET, CODE_COLUMN)]
    keys = KEYS[:1] if split_key == "account" else KEYS
    fit_part, test_part = hash_split(frame, keys, test, seed)
    model = L.train(fit_part, features, params, categorical=categorical)
    metrics = L.evaluate(L.predict(test_part, model), model.width)
    if path is not None:
        save_model(model, features, path)
    return Trained(model, features, metrics, L.importance(model))
