"""Scalar expressions. All are built-ins, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from cohortloom.rules import ImputeRule

# Average Gregorian month (30.436875 days), the unit of every tenure.
SECONDS_PER_MONTH = 2629746.0
SHARE_TYPE = "DECIMAL(10,3)"


def text(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"{text(k)}, {v}" for k, v in fields.items()) + ")"


def yearmon(created: str) -> str:
    """Creation month as ``2021-9``: the month is not zero padded."""
    return f"concat(year({created}), '-', month({created}))"


def tenure_months(created: str, anchor: datetime) -> str:
    """Average months from ``created`` to ``anchor``, fractional."""
    anchor_seconds = (anchor - datetime(anchor.year, anchor.month, anchor.day)).total_seconds()
    created_seconds = (
        f"CAST(hour({created}) * 3600 + minute({created}) * 60"
        f" + extract(SECOND FROM {created}) AS DOUBLE)"
    )
    days = f"datediff(DATE '{anchor.date().isoformat()}', CAST({created} AS DATE))"
    return f"({days} * 86400D + {anchor_seconds}D - {created_seconds}) / {SECONDS_PER_MONTH}D"


def tenure_months_floor(months: str) -> str:
    return f"CAST(floor({months}) AS INT)"


def years_since(year: str | int, start_year: str) -> str:
    return f"{year} - {start_year}"


def log2p1(value: str) -> str:
    return f"log2({value} + 1)"


def log_target(value: str) -> str:
    return f"log1p({value})"


def inverse_target(value: str, base: str | int = "e") -> str:
    """Undo ``log_target``. ``base=2`` gives 2^p - 1, which does not undo a natural log."""
    return f"expm1({value})" if base == "e" else f"pow({base}D, {value}) - 1"


def type_letter(company_type: str) -> str:
    """First letter of the company type, upper case whatever the source's collation."""
    return f"upper(substring({company_type}, 1, 1))"


def code_point(letter: str) -> str:
    """Number of a single character that orders like it; 0 for empty text."""
    return f"ascii({letter})"


def from_code_point(number: str) -> str:
    raw = f"unhex(lpad(hex({number}), 8, '0'))"
    return f"CASE WHEN {number} = 0 THEN '' ELSE decode({raw}, 'UTF-32') END"


def type_default(letter: str) -> str:
    return f"coalesce({letter}, 'X')"


def leading_token(value: str) -> str:
    """Text before the first space; the whole text if there is none."""
    return f"substring_index({value}, ' ', 1)"


def division(code: str) -> str:
    return f"substring({code}, 1, 2)"


def band(value: str, bounds: Sequence[tuple[int, str]], default: str) -> str:
    """Letter of the first bound that ``value`` does not exceed.

    Text that is no number and NULL take the default; blank text counts as 0.
    """
    number = f"CASE WHEN trim({value}) = '' THEN 0 ELSE try_cast({value} AS INT) END"
    letters, low = [], 0
    for upper, letter in bounds:
        letters += [text(letter)] * (upper + 1 - low)
        low = upper + 1
    # one letter per number, so that the number is worked out twice at most
    at = f"get(array({', '.join(letters)}), CASE WHEN {number} < 0 THEN 0 ELSE {number} END)"
    return f"coalesce({at}, {text(default)})"


def match_flag(value: str) -> str:
    return f"CAST({value} IS NOT NULL AS INT)"


def lookup(key: str, table: Mapping[str, float], kind: str = "DOUBLE") -> str:
    """Value of a small fixed table, NULL if absent."""
    rows = "".join(f" WHEN {text(k)} THEN {v}" for k, v in table.items())
    return f"CAST(CASE {key}{rows} END AS {kind})"


def impute(value: str, flag: str, letter: str, rule: ImputeRule, kind: str) -> str:
    """``value``, else by (flag, letter), else by flag, else NULL."""
    by_type = {f"{f}{t}": v for (f, t), v in rule.by_type.items()}
    by_flag = {str(f): v for f, v in rule.default.items()}
    return (
        f"coalesce(CAST({value} AS {kind}), {lookup(f'concat({flag}, {letter})', by_type, kind)},"
        f" {lookup(f'CAST({flag} AS STRING)', by_flag, kind)})"
    )


def tally(condition: str) -> str:
    """Aggregate: rows for which the condition holds."""
    return f"count(CASE WHEN {condition} THEN 1 END)"


def share(part: str, total: str) -> str:
    """part / total as decimal(10,3), half up, NULL for an empty total.

    Whole-number arithmetic gives the exact rounding without arbitrary-precision division.
    """
    thousandths = f"({part} * 2000 + {total}) div (nullif({total}, 0) * 2)"
    return f"CAST(CAST({thousandths} AS DECIMAL(10,0)) * 0.001 AS {SHARE_TYPE})"


def seeded_hash(seed: int, *keys: str) -> str:
    """md5 over seed and keys: the same order and buckets on any engine."""
    return f"md5(concat_ws('-', '{seed}', {', '.join(keys)}))"


def hash_bucket(seed: int, keys: Sequence[str], buckets: int = 100) -> str:
    """Bucket 0 .. buckets-1 from the first 32 bits of the seeded hash."""
    head = f"conv(substring({seeded_hash(seed, *keys)}, 1, 8), 16, 10)"
    return f"CAST(CAST({head} AS BIGINT) % {buckets} AS INT)"
