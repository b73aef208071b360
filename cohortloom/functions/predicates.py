"""Conditions over dates and flags.

Days are compared with midnight, which is the same as comparing dates, so columns reach the
scan's filters without a cast. A day is a date, or the text of a column that holds midnights.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date


def midnight(day: date | str) -> str:
    return day if isinstance(day, str) else f"TIMESTAMP_NTZ '{day.isoformat()} 00:00:00'"


def before(col: str, day: date | str) -> str:
    """Day of ``col`` earlier than ``day``."""
    return f"{col} < {midnight(day)}"


def from_day(col: str, day: date | str) -> str:
    return f"{col} >= {midnight(day)}"


def in_window(col: str, start: date | str, end: date | str | None) -> str:
    """Day of ``col`` in [start, end); no end (None, or NULL in a column) leaves it open."""
    inside = from_day(col, start)
    if end is None:
        return inside
    below = before(col, end)
    return f"({inside} AND ({below} OR {end} IS NULL))" if isinstance(end, str) else (
        f"({inside} AND {below})"
    )


def between_incl(col: str, low: date, high: date) -> str:
    """``col`` between midnight of both days, both ends in."""
    return f"({col} BETWEEN {midnight(low)} AND {midnight(high)})"


def open_at(day: date | str, *closed: str) -> str:
    """Not closed before ``day`` by any of the close dates; NULL means never closed."""
    return any_all(" AND ", (f"({from_day(col, day)} OR {col} IS NULL)" for col in closed))


def any_all(word: str, conditions: Iterable[str]) -> str:
    return "(" + word.join(conditions) + ")"


def any_of(conditions: Iterable[str]) -> str:
    return any_all(" OR ", conditions)
