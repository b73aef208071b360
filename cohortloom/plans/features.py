"""The one feature plan that training and scoring share.

Schemes and industry are joined at account grain, where each input has one row per account and
all lie by the same key. Cohorts are unfolded next, and commitments joined by account and cohort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame

from cohortloom.cohorts import Cohort
from cohortloom.functions import predicates as P
from cohortloom.functions import scalars as S
from cohortloom.functions.scalars import SHARE_TYPE
from cohortloom.operators import accounts as A
from cohortloom.operators import commitments as C
from cohortloom.operators.industry import industry_features
from cohortloom.operators.schemes import SCHEME_CUTOFF, owner_profile, profile_columns
from cohortloom.rules import Rules
from cohortloom.sources.tables import SourceTables


@dataclass(frozen=True)
class FeatureSettings:
    """Dates, rules and switches of the feature steps.

    ``code_map`` (old_code, new_code) turns the industry features on. ``null_share`` is as in
    ``mix_share``.
    """

    early_cutoff: date = A.EARLY_ADOPTER_CUTOFF
    scheme_cutoff: date = SCHEME_CUTOFF
    rules: Rules = field(default_factory=Rules)
    code_map: DataFrame | None = None
    null_share: str = "is_null"
    codes: tuple[str, ...] = C.OCCUPATION_CODES

    @property
    def use_industry(self) -> bool:
        return self.code_map is not None


def _has_features(c: Cohort) -> str:
    """Features exist for levy accounts created before the window; others count as 0."""
    return f"(a1 = 1 AND {P.before('a2', c.start)})"


def _or_zero(name: str, value: str) -> str:
    kind = SHARE_TYPE if name.startswith("occupation_") else "BIGINT"
    return f"CAST(coalesce(CASE WHEN _valid THEN {value} END, 0) AS {kind}) AS {name}"


def _attached(
    accounts: DataFrame,
    commitments: DataFrame,
    cohorts: Sequence[Cohort],
    ids: DataFrame | None,
    settings: FeatureSettings,
    members_only: bool,
) -> tuple[DataFrame, list[str]]:
    """Accounts by cohort left joined to their features, and the account columns among these.

    ``_valid`` tells where features count. Both sides are shuffled once, by account and cohort.
    """
    features = C.numbered_features(
        commitments, cohorts, ids, settings.codes, settings.null_share
    )
    number = {c: str(i) for i, c in enumerate(cohorts)}
    grown = A.expand_cohorts(
        accounts,
        cohorts,
        lambda c: {"_cohort": number[c], "_valid": _has_features(c)},
        members_only,
    )
    kept = [c for c in grown.columns if c not in ("a7", "_valid", "_cohort")]
    return A.attach(grown, features, on=["a3", "_cohort"]), kept


def cohort_frame(
    accounts: DataFrame,
    commitments: DataFrame,
    cohorts: Sequence[Cohort],
    ids: DataFrame | None = None,
    settings: FeatureSettings = FeatureSettings(),
    members_only: bool = True,
) -> DataFrame:
    """Accounts by cohort with tenure and zero-filled commitment features.

    ``accounts`` keeps whatever other columns it has.
    """
    joined, kept = _attached(accounts, commitments, cohorts, ids, settings, members_only)
    return joined.selectExpr(
        *kept,
        *[_or_zero(name, name) for name in C.feature_columns(settings.codes)],
        _or_zero("levy_sending_company", "a7"),
    )


def raw_features(
    accounts: DataFrame,
    commitments: DataFrame,
    cohorts: Sequence[Cohort],
    ids: DataFrame | None = None,
    settings: FeatureSettings = FeatureSettings(),
) -> DataFrame:
    """Features before filling: levy accounts created before each cohort's start only.

    A measure is NULL, not 0, where the account has no row in the window it is taken from.
    """
    joined, _ = _attached(accounts, commitments, cohorts, ids, settings, False)
    moved = "prev_12m_new_levy_transfers"
    unfilled = {name: f"nullif({name}, 0) AS {name}" for name in C.COUNTS}
    unfilled[moved] = f"CASE WHEN {C.LOOKBACK} > 0 THEN {moved} END AS {moved}"
    return joined.where("_valid").selectExpr(
        "a3",
        "cohort",
        *[unfilled.get(name, name) for name in C.feature_columns(settings.codes)],
        "a7 AS levy_sending_company",
    )


def account_features(
    tables: SourceTables,
    accounts: DataFrame,
    cohorts: Sequence[Cohort],
    ids: DataFrame | None = None,
    settings: FeatureSettings = FeatureSettings(),
    members_only: bool = True,
) -> DataFrame:
    """Accounts by cohort with commitment, scheme and (optionally) industry features."""
    base = A.early_adopter(accounts, settings.early_cutoff)
    joined = A.attach(base, owner_profile(tables.schemes, ids), left="a3", right="d15")
    in_scope = P.before("a2", settings.scheme_cutoff)
    joined = joined.selectExpr(*base.columns, *profile_columns(settings.rules, in_scope))
    if settings.use_industry:
        industry = industry_features(
            tables.schemes,
            tables.register,
            settings.code_map,
            settings.rules.bands,
            ids,
        )
        joined = A.attach(joined, industry, left="a3", right="d15").drop("d15")
    frame = cohort_frame(joined, tables.commitments, cohorts, ids, settings, members_only)
    return derive(frame)


def derive(frame: DataFrame) -> DataFrame:
    """Company age, scheme age and size on the log scale."""
    age = S.years_since("CAST(cohort AS INT)", "scheme_start_year")
    return A.new_company(frame).selectExpr(
        "*",
        f"{age} AS years_since_tpr_signup",
        f"{S.log2p1('employees')} AS log_employees",
    )
