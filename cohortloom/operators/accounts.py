"""Account-level filters, flags and set operations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.cohorts import Cohort
from cohortloom.functions import predicates as P
from cohortloom.functions import scalars as S

EARLY_ADOPTER_CUTOFF = date(2017, 7, 1)


def early_adopter(df: DataFrame, cutoff: date = EARLY_ADOPTER_CUTOFF) -> DataFrame:
    early = f"CASE WHEN {P.before('a2', cutoff)} THEN 1 ELSE 0 END AS early_adopter"
    return df.selectExpr("*", early)


def created_before(df: DataFrame, day: date) -> DataFrame:
    return df.where(P.before("a2", day))


def levy_only(df: DataFrame) -> DataFrame:
    return df.where("a1 = 1")


def restrict(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the one-column ``ids``.

    Whether the ids are broadcast is left to the planner, which knows their size (a stored sample
    is small, and then ``df`` is not shuffled).
    """
    ids = ids.select(F.col(ids.columns[0]).alias("_id"))
    return df.join(ids, F.col(key) == F.col("_id"), "left_semi")


def new_company(df: DataFrame, limit: int = 6, months: str = "months_since_sign_up2") -> DataFrame:
    return df.selectExpr("*", f"CASE WHEN {months} <= {limit} THEN 1 ELSE 0 END AS new_company")


def eligible(df: DataFrame, max_employees: int = 20000, status: int | None = None) -> DataFrame:
    """Matched accounts up to a size; ``status`` adds the company status of the industry path."""
    kept = f"employees <= {max_employees} AND tpr_match = 1"
    return df.where(kept if status is None else f"{kept} AND company_status = {status}")


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(cols))


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every column; NaN counts as missing.

    One condition per column: a single condition over all of them would be rewritten for every
    combination of renamed columns when the planner derives what is known about the rows.
    """
    present = [f"`{c}` IS NOT NULL" for c in (df.columns if cols is None else cols)]
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    numbers = [f"NOT isnan(`{c}`)" for c in (df.columns if cols is None else cols) if c in floats]
    return df.where(" AND ".join([*present, *numbers]))


RENAMES = {
    "a1": "levy_non_levy",
    "a3": "account_id",
    "months_since_sign_up2": "as_months_since_sign_up",
}


def rename_features(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(RENAMES)


HELPER_COLUMNS = (
    "new_sic_code",
    "company_status",
    "tpr_match",
    "company_type",
    "employees",
    "sic_division",
    "sic_section",
    "total_commitments",
    "d15",
    "a2",
    "months_since_sign_up",
    "scheme_start_year",
)


def drop_columns(df: DataFrame, cols: Sequence[str] = HELPER_COLUMNS) -> DataFrame:
    return df.drop(*cols)


def expand_cohorts(
    accounts: DataFrame,
    cohorts: Sequence[Cohort],
    per_cohort: Callable[[Cohort], Mapping[str, str]] | None = None,
    members_only: bool = True,
) -> DataFrame:
    """One row per account and cohort it was created in time for (before the cohort's end).

    The cohorts travel in the plan as a generated array, so nothing is joined or shuffled.
    ``per_cohort`` gives expressions that differ by cohort; ``members_only=False`` keeps
    accounts whatever their creation date.
    """

    def entry(c: Cohort) -> str:
        return S.struct(
            cohort=S.text(c.label),
            months_since_sign_up=S.tenure_months("a2", c.anchor),
            _member=P.before("a2", c.end) if members_only else "true",
            **(per_cohort(c) if per_cohort else {}),
        )

    unfolded = accounts.selectExpr("*", f"inline(array({', '.join(map(entry, cohorts))}))")
    months = S.tenure_months_floor("months_since_sign_up")
    return (
        unfolded.where("_member")
        .drop("_member")
        .selectExpr("*", f"{months} AS months_since_sign_up2")
    )


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames one under the other, columns by name, duplicates kept."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def attach(
    df: DataFrame,
    other: DataFrame,
    on: str | Sequence[str] | None = None,
    left: str | None = None,
    right: str | None = None,
) -> DataFrame:
    """Left join of features that have one row per key; ``left``/``right`` for unequal names."""
    if on is not None:
        return df.join(other, [on] if isinstance(on, str) else list(on), "left")
    return df.join(other, F.col(left) == F.col(right), "left")
