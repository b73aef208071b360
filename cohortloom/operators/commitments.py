"""Point-in-time commitment features for any number of cohorts in one scan.

Each row is unfolded into the cohorts that count it, inside the task that reads it, and every
measure is a conditional count. Partial aggregation then leaves one row per account and cohort
before anything is shuffled: an account that holds a large part of all rows costs no more than
any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.cohorts import Cohort
from cohortloom.functions import predicates as P
from cohortloom.functions import scalars as S
from cohortloom.operators.accounts import restrict

# Occupation codes with a share of their own.
OCCUPATION_CODES = ("1", "2", "3", "7", "13", "14", "15", "17", "20", "22", "24")

CREATED, CODE, OWNER, TRANSFER, PLANNED_END = "b2", "b6", "b10", "b12", "b17"
CLOSED = ("b16", "b20")

LOOKBACK = "prev_12m_new_commitments"
COUNTS = (
    "total_commitments",
    LOOKBACK,
    "prev_12m_new_levy_transfers",
    "commitments_ending_12m",
    "current_live_commitments",
)


def share_columns(codes: Sequence[str] = OCCUPATION_CODES) -> list[str]:
    return [f"occupation_{code}" for code in codes] + ["occupation_null"]


def feature_columns(codes: Sequence[str] = OCCUPATION_CODES) -> list[str]:
    """Features in model order, target first."""
    return [COUNTS[0], *share_columns(codes), *COUNTS[1:]]


def _still_open(day: date | str) -> str:
    return P.open_at(day, *CLOSED)


def _day(day: date | None) -> str:
    return "CAST(NULL AS TIMESTAMP_NTZ)" if day is None else P.midnight(day)


def in_target(c: Cohort | SimpleNamespace) -> str:
    return P.in_window(CREATED, c.start, c.target_end)


def in_lookback(c: Cohort | SimpleNamespace) -> str:
    return P.in_window(CREATED, c.prev_start, c.start)


def ending(c: Cohort | SimpleNamespace) -> str:
    return f"({P.in_window(PLANNED_END, c.start, c.end)} AND {_still_open(c.start)})"


def live(c: Cohort | SimpleNamespace) -> str:
    return f"({P.before(CREATED, c.start)} AND {_still_open(c.open_date)})"


# Days of a cohort, and the columns that hold them where cohorts are unfolded.
DAYS = ("prev_start", "start", "end", "target_end", "open_date")
DAY_COLUMNS = SimpleNamespace(**{day: f"_{day}" for day in DAYS})

FLAGS = {"in_target": in_target, "in_lookback": in_lookback, "ending": ending, "live": live}


def _relevant(cohorts: Sequence[Cohort], flags: Sequence[str]) -> str:
    """Bounds over all cohorts that a counted row must meet: what the scan can skip."""
    starts = [c.start for c in cohorts]
    ends = [c.target_end for c in cohorts]
    bounds = Cohort(
        label="",
        prev_start=min(c.prev_start for c in cohorts),
        start=min(starts),
        end=max(c.end for c in cohorts),
        target_end=None if None in ends else max(ends),
        open_date=min(c.open_date for c in cohorts),
        year=0,
        anchor=cohorts[0].anchor,
    )
    # Look-back and live rows are bounded by the latest start, the others by the earliest.
    latest = replace(bounds, start=max(starts))
    return P.any_of(
        FLAGS[flag](latest if flag in ("in_lookback", "live") else bounds) for flag in flags
    )


def _by_cohort(b: DataFrame, cohorts: Sequence[Cohort], flags: Sequence[str]) -> DataFrame:
    """One row per commitment and cohort that counts it, with the flags that do.

    The cohorts are a constant array in the plan. Their days are unfolded into columns, so each
    condition stands in the plan once however many cohorts there are.
    """
    table = ", ".join(
        S.struct(_cohort=str(i), **{f"_{day}": _day(getattr(c, day)) for day in DAYS})
        for i, c in enumerate(cohorts)
    )
    return (
        b.where(_relevant(cohorts, flags))
        .selectExpr("*", f"inline(array({table}))")
        .selectExpr(
            OWNER, CODE, TRANSFER, "_cohort", *[f"{FLAGS[f](DAY_COLUMNS)} AS {f}" for f in flags]
        )
        .where(P.any_of(flags))
    )


def _tallies(
    b: DataFrame, cohorts: Sequence[Cohort], flags: Sequence[str], conditions: Mapping[str, str]
) -> DataFrame:
    """Rows for which each condition on the flags holds, per account and cohort.

    Grouping is by the cohort's number in ``_cohort``, a shorter key than its label.
    """
    return (
        _by_cohort(b, cohorts, flags)
        .groupBy(OWNER, "_cohort")
        .agg(*[F.expr(f"{S.tally(cond)} AS {name}") for name, cond in conditions.items()])
    )


def _labelled(df: DataFrame, cohorts: Sequence[Cohort]) -> DataFrame:
    """The label in ``cohort`` for the number in ``_cohort``."""
    labels = ", ".join(S.text(c.label) for c in cohorts)
    rest = [c for c in df.columns[1:] if c != "_cohort"]
    return df.selectExpr(df.columns[0], f"array({labels})[_cohort] AS cohort", *rest)


def _code_conditions(codes: Sequence[str], null_share: str) -> dict[str, str]:
    """``is_null`` counts missing codes; ``equals_null`` is the comparison that never holds."""
    missing = {"is_null": f"{CODE} IS NULL", "equals_null": f"{CODE} = NULL"}[null_share]
    return {
        **{f"occupation_{v}": f"in_lookback AND {CODE} = {S.text(v)}" for v in codes},
        "occupation_null": f"in_lookback AND {missing}",
    }


def _share(name: str) -> str:
    return f"{S.share(name, LOOKBACK)} AS {name}"


def count_in_window(
    b: DataFrame,
    cohorts: Sequence[Cohort],
    start: str,
    end: str,
    cond: str | None = None,
    name: str = "commitments",
) -> DataFrame:
    """Commitments created in [start, end) per account and cohort, accounts with none left out.

    ``start`` and ``end`` name attributes of the cohort: ("start", "target_end") is the target,
    ("prev_start", "start") the look-back. ``cond`` further restricts the rows.
    """
    flag = {("start", "target_end"): "in_target", ("prev_start", "start"): "in_lookback"}
    counted = b if cond is None else b.where(cond)
    return _labelled(_tallies(counted, cohorts, [flag[start, end]], {name: "true"}), cohorts)


def ending_in_window(b: DataFrame, cohorts: Sequence[Cohort]) -> DataFrame:
    """Commitments with planned end in [start, end) still open at start."""
    counts = _tallies(b, cohorts, ["ending"], {"commitments_ending_12m": "true"})
    return _labelled(counts, cohorts)


def live_at(b: DataFrame, cohorts: Sequence[Cohort]) -> DataFrame:
    """Commitments created before start and open at the cohort's open date."""
    counts = _tallies(b, cohorts, ["live"], {"current_live_commitments": "true"})
    return _labelled(counts, cohorts)


def mix_share(
    b: DataFrame,
    cohorts: Sequence[Cohort],
    codes: Sequence[str] = OCCUPATION_CODES,
    null_share: str = "is_null",
) -> DataFrame:
    """Share of each code among look-back commitments, per account and cohort that has any."""
    conditions = {LOOKBACK: "true", **_code_conditions(codes, null_share)}
    counts = _tallies(b, cohorts, ["in_lookback"], conditions)
    shares = [_share(name) for name in share_columns(codes)]
    return _labelled(counts, cohorts).selectExpr(OWNER, "cohort", *shares)


def null_shares(b: DataFrame, cohorts: Sequence[Cohort]) -> DataFrame:
    """Share of missing codes as intended and as the comparison with NULL gives it, at once."""
    conditions = {
        LOOKBACK: "true",
        **{
            name: _code_conditions((), kind)["occupation_null"]
            for name, kind in (("intended", "is_null"), ("as_run", "equals_null"))
        },
    }
    counts = _tallies(b, cohorts, ["in_lookback"], conditions)
    shares = [_share(name) for name in ("intended", "as_run")]
    return _labelled(counts, cohorts).selectExpr(OWNER, "cohort", *shares)


def commitment_features(
    b: DataFrame,
    cohorts: Sequence[Cohort],
    ids: DataFrame | None = None,
    codes: Sequence[str] = OCCUPATION_CODES,
    null_share: str = "is_null",
) -> DataFrame:
    """Counts and shares per account and cohort, from one scan.

    Left out are accounts with nothing counted for the cohort. In the others a count is 0, and
    a share NULL, where only that window is empty.
    """
    features = numbered_features(b, cohorts, ids, codes, null_share)
    return _labelled(features, cohorts)


def numbered_features(
    b: DataFrame,
    cohorts: Sequence[Cohort],
    ids: DataFrame | None = None,
    codes: Sequence[str] = OCCUPATION_CODES,
    null_share: str = "is_null",
) -> DataFrame:
    """``commitment_features`` keyed by the cohort's number.

    It lies by (a3, _cohort) as aggregated, so a join on these keys shuffles it no further.
    """
    scoped = b if ids is None else restrict(b, ids, OWNER)
    conditions = {
        "total_commitments": "in_target",
        LOOKBACK: "in_lookback",
        "prev_12m_new_levy_transfers": f"in_lookback AND {TRANSFER} = 1",
        "commitments_ending_12m": "ending",
        "current_live_commitments": "live",
        **_code_conditions(codes, null_share),
    }
    counts = _tallies(scoped, cohorts, list(FLAGS), conditions)
    return counts.selectExpr(
        f"{OWNER} AS a3",
        "_cohort",
        *[name if name in COUNTS else _share(name) for name in feature_columns(codes)],
    )


def uplift(df: DataFrame, factors: Mapping[str, float]) -> DataFrame:
    """Commitments so far times the factor of the month the levy account was created in."""
    factor = f"CASE WHEN a1 = 1 THEN {S.lookup(S.yearmon('a2'), factors)} END"
    return df.selectExpr(
        "*", f"total_commitments * coalesce({factor}, 1D) AS adjusted_commitments"
    )
