"""SQL databases over JDBC, read by many tasks at once where a key range is given."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

QUERY_TIMEOUT = 3600


@dataclass(frozen=True)
class KeyRange:
    """Numeric or date column and bounds that split a read into ``parts`` range queries.

    The bounds only set the strides: rows outside them are still read, by the first and
    last part.
    """

    column: str
    lower: str | int
    upper: str | int
    parts: int


@dataclass(frozen=True)
class KeyCuts:
    """Column and rising cut points that split a read into parts of about as many rows each.

    Even strides leave most rows to a few parts where keys are skewed; cuts at quantiles of the
    rows do not. One value is never divided: all of its rows are in one part.
    """

    column: str
    cuts: tuple

    def predicates(self) -> list[str]:
        """Conditions of which every row, one without a key included, meets exactly one."""
        low, high = [None, *self.cuts], [*self.cuts, None]
        return [self._between(a, b) for a, b in zip(low, high)]

    def _between(self, low, high) -> str:
        if low is None and high is None:
            return "1 = 1"
        if low is None:
            return f"({self.column} < {_literal(high)} OR {self.column} IS NULL)"
        below = "" if high is None else f" AND {self.column} < {_literal(high)}"
        return f"{self.column} >= {_literal(low)}{below}"


def _literal(value) -> str:
    if isinstance(value, bool) or value is None:
        raise TypeError(f"not a cut point: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def key_quantiles_sql(table: str, column: str, parts: int) -> str:
    """Query for the least key of each of ``parts`` even parts, in order; one row for each."""
    return (
        f"SELECT MIN(k) AS cut FROM (SELECT {column} AS k, NTILE({parts}) OVER (ORDER BY {column})"
        f" AS part FROM {table} WHERE {column} IS NOT NULL) q GROUP BY part ORDER BY cut"
    )


def key_cuts(column: str, least: Iterable) -> KeyCuts | None:
    """Cuts from the keys that ``key_quantiles_sql`` gave; none for an empty table.

    A key that fills more than one part is the least of several: it is one cut.
    """
    found = sorted(set(least))
    return KeyCuts(column, tuple(found[1:])) if found else None


def query_options(
    url: str,
    sql: str,
    timeout: int = QUERY_TIMEOUT,
    split: KeyRange | None = None,
    fetch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a query. Spark takes a split only on a table, so it is aliased."""
    options = {
        **(properties or {}),
        "url": url,
        "queryTimeout": str(timeout),
        "fetchsize": str(fetch_rows),
    }
    if split is None:
        return {**options, "query": sql}
    return {
        **options,
        "dbtable": f"({sql}) q",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }


def key_bounds_sql(table: str, column: str) -> str:
    """Query for the bounds of a split; one row, so it can run unsplit."""
    return f"SELECT MIN({column}) AS lower_key, MAX({column}) AS upper_key FROM {table}"


def parse_split(text: str) -> tuple[str, str, int]:
    """Table, column and number of parts of TABLE=COLUMN:PARTS."""
    table, _, rest = text.partition("=")
    column, _, parts = rest.rpartition(":")
    if not (table and column and parts.isdigit() and int(parts) > 0):
        raise ValueError(f"not TABLE=COLUMN:PARTS: {text}")
    return table, column, int(parts)


def key_range(column: str, parts: int, bounds: Sequence | None) -> KeyRange | None:
    """The range between the bounds that ``key_bounds_sql`` gave; none for an empty table."""
    if bounds is None or bounds[0] is None:
        return None
    return KeyRange(column, str(bounds[0]), str(bounds[1]), parts)


def read_query(
    spark: SparkSession,
    url: str,
    sql: str,
    timeout: int = QUERY_TIMEOUT,
    split: KeyRange | KeyCuts | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Result of a query the database runs.

    Without ``split`` one task reads the whole result: pass one for anything large.
    """
    if isinstance(split, KeyCuts):
        given = query_options(url, sql, timeout, properties=properties)
        rest = {k: v for k, v in given.items() if k not in ("url", "query")}
        return spark.read.jdbc(
            url, f"({sql}) q", predicates=split.predicates(), properties=rest
        )
    options = query_options(url, sql, timeout, split, properties=properties)
    return spark.read.format("jdbc").options(**options).load()
