"""Observation windows: which dates are look-back, target and anchor for a cohort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class Cohort:
    """One observation window.

    Look-back counts use [prev_start, start), the target uses [start, target_end), and
    commitments ending use [start, end). ``end`` is also the tenure anchor and the bound for
    membership, while features only exist for accounts created before ``start``.
    ``target_end=None`` leaves the target window open. ``open_date`` is the day on which a
    commitment must still be open to count as live (default: ``start``).
    """

    label: str
    prev_start: date
    start: date
    end: date
    target_end: date | None
    open_date: date
    year: int
    anchor: datetime

    @classmethod
    def fixed(cls, label: str, prev_start: date, start: date, end: date) -> Cohort:
        return cls(
            label=label,
            prev_start=prev_start,
            start=start,
            end=end,
            target_end=end,
            open_date=start,
            year=int(label),
            anchor=datetime(end.year, end.month, end.day),
        )

    def shift(self, years: int) -> Cohort:
        """The same window moved by whole years (label included)."""
        return replace(
            Cohort.fixed(
                str(int(self.label) + years),
                *(_add_years(d, years) for d in (self.prev_start, self.start, self.end)),
            ),
            target_end=None if self.target_end is None else _add_years(self.target_end, years),
            open_date=_add_years(self.open_date, years),
        )


def _add_years(day: date, years: int) -> date:
    return day.replace(year=day.year + years)


# Label, look-back start, start, end.
TRAINING_COHORTS = (
    Cohort.fixed("2019", date(2017, 4, 1), date(2018, 4, 1), date(2019, 4, 1)),
    Cohort.fixed("2020", date(2018, 4, 1), date(2019, 4, 1), date(2020, 4, 1)),
    Cohort.fixed("2022", date(2020, 1, 1), date(2021, 1, 1), date(2022, 1, 1)),
)


def shift_cohorts(cohorts: Sequence[Cohort], years: int) -> tuple[Cohort, ...]:
    return tuple(c.shift(years) for c in cohorts)


def rolling_cohort(as_of: date | datetime, days: int = 365, compat: bool = False) -> Cohort:
    """Window relative to a given day: start = as_of - days, look-back from as_of - 2*days.

    The target has no upper bound. A commitment is live if open at ``start``, as in training;
    ``compat=True`` asks for open at ``as_of`` instead.
    """
    anchor = as_of if isinstance(as_of, datetime) else datetime(as_of.year, as_of.month, as_of.day)
    day = anchor.date()
    start = day - timedelta(days=days)
    return Cohort(
        label=str(day.year),
        prev_start=day - timedelta(days=2 * days),
        start=start,
        end=day,
        target_end=None,
        open_date=day if compat else start,
        year=day.year,
        anchor=anchor,
    )
