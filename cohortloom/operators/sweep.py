"""Commitment features for many cohorts by a sweep, and from a kept roll-up.

A commitment counts for a run of consecutive cohorts: their days move on together, so each
condition holds from some cohort to some other. A row therefore becomes an event where it starts to
count and one where it stops, however many cohorts there are between, and a running sum by account
over the cohorts gives every count. Where a row's run begins and ends is looked up by its days in a
calendar of the cohorts' span, as many rows as days.

Equal rows are counted in tasks dealt by all their columns, and what is left, of an account no more
than its days and codes allow, goes to the account's task: one with a large part of all rows is
added up by many tasks. A row becomes up to eight wide cells, so tasks are as many as rows need,
``TASK_ROWS`` in each, and the memory of one does not grow with the input.

What the sweep reads of a commitment is a few days: created, closed, planned end. Rows equal in
these, counted by account, are a roll-up that adds: batches are appended, late rows with the batch
they arrive in, and a batch that is written again replaces itself. Any later cohort is answered
from the roll-up alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.cohorts import Cohort
from cohortloom.functions import scalars as S
from cohortloom.operators import commitments as C
from cohortloom.operators.accounts import restrict

BOUNDS = ("prev_start", "start", "end", "target_end", "open_date")
KEYS = (C.OWNER, "kind", "day", "closed", C.CODE, C.TRANSFER)
#: Rows of ``day_rows`` that a task adds up.
TASK_ROWS = 500_000


def day_rows(b: DataFrame) -> DataFrame:
    """What the features need of each commitment: KEYS, and ``n``, here 1.

    Days are numbers since 1970. The kinds are ``new`` and ``live`` by the day a commitment was
    created, and ``ending`` by the day it is planned to end; only ``new`` has code and transfer.
    """
    created, planned = (f"unix_date(CAST({c} AS DATE))" for c in (C.CREATED, C.PLANNED_END))
    closed = f"unix_date(CAST(least({', '.join(C.CLOSED)}) AS DATE))"
    none = {"closed": "CAST(NULL AS INT)", "code": "CAST(NULL AS STRING)", "moved": "NULL"}
    moved = f"CAST({C.TRANSFER} = 1 AS INT)"

    def row(kind: str, day: str, closed: str, code: str, moved: str) -> str:
        values = {"kind": S.text(kind), "day": day, "closed": closed, C.CODE: code}
        return S.struct(**values, **{C.TRANSFER: f"CAST({moved} AS INT)"})

    rows = [
        row("new", created, none["closed"], f"CAST({C.CODE} AS STRING)", moved),
        row("live", created, closed, none["code"], none["moved"]),
        row("ending", planned, closed, none["code"], none["moved"]),
    ]
    return b.selectExpr(C.OWNER, f"inline(array({', '.join(rows)}))", "1L AS n").where(
        "day IS NOT NULL"
    )


def roll_up(b: DataFrame) -> DataFrame:
    """The rows of ``day_rows`` counted: additive, so that batches can be appended."""
    rows = day_rows(b)
    return _counted(rows, _tasks(rows))


def _tasks(rows: DataFrame) -> int:
    """As many as the rows need; two at least, so that rows are always dealt by their keys."""
    return max(2, math.ceil(rows.count() / TASK_ROWS))


def _counted(rows: DataFrame, tasks: int) -> DataFrame:
    return rows.repartition(tasks, *KEYS).groupBy(*KEYS).agg(F.sum("n").alias("n"))


def append_batch(b: DataFrame, path: str, batch: str, sign: int = 1) -> None:
    """Add a batch of commitments to the roll-up at ``path``; a batch written again replaces itself.

    A commitment that has changed is taken out as it was, with ``sign=-1`` and a batch name of its
    own, and added as it is. One row that counts nothing stands for the batch itself, so that one
    written again without commitments takes the place of what it held.
    """
    rows = roll_up(b).withColumn("n", F.col("n") * sign)
    nothing = {"kind": F.lit("none"), "n": F.lit(0).cast("long")}
    mark = b.sparkSession.range(1).select(
        *[nothing.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema]
    )
    rows = rows.union(mark).withColumn("batch", F.lit(batch))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch"
    ).parquet(path)


def read_roll_up(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def chains(cohorts: Sequence[Cohort]) -> list[list[Cohort]]:
    """Cohorts in as few runs as greed finds, in each of which no bound ever moves back."""
    out: list[list[Cohort]] = []

    def days(c: Cohort) -> list[date]:
        return [getattr(c, name) or date.max for name in BOUNDS]

    for c in sorted(cohorts, key=lambda c: (c.start, days(c))):
        for run in out:
            if all(a <= b for a, b in zip(days(run[-1]), days(c))):
                run.append(c)
                break
        else:
            out.append([c])
    return out


def calendar(spark: SparkSession, cohorts: Sequence[Cohort]) -> tuple[DataFrame, int, int]:
    """For every day of the cohorts' span, how many have reached each bound by then."""
    days = {name: [getattr(c, name) for c in cohorts] for name in BOUNDS}
    known = [d for bound in days.values() for d in bound if d is not None]
    epoch = date(1970, 1, 1)
    low = (min(known) - timedelta(days=1) - epoch).days
    high = (max(known) - epoch).days
    table = spark.range(low, high + 1).select(F.col("id").cast("int").alias("at"))
    for name, bound in days.items():
        reached = F.lit([(d - epoch).days for d in bound if d is not None]).cast("array<int>")
        table = table.withColumn(
            f"n_{name}", F.size(F.filter(reached, lambda d: d <= F.col("at")))
        )
    return table, low, high


def _events(rows: DataFrame, cohorts: Sequence[Cohort]) -> DataFrame:
    """Owner, place, flag, change, code, transfer: where rows start and stop to count."""
    table, low, high = calendar(rows.sparkSession, cohorts)
    n = len(cohorts)

    def found(name: str) -> DataFrame:
        columns = [F.col(c).alias(c.replace("n_", f"{name}_", 1)) for c in table.columns[1:]]
        return F.broadcast(table.select(F.col("at").alias(f"_{name}"), *columns))

    def clamped(col: str) -> str:
        return f"IF({col} IS NULL, NULL, least(greatest({col}, {low}), {high}))"

    # a row not closed is open at every bound
    rows = rows.selectExpr("*", f"{clamped('day')} AS _day", f"{clamped('closed')} AS _closed")
    rows = rows.join(found("day"), "_day").join(found("closed"), "_closed", "left")
    still = {name: f"coalesce(closed_{name}, {n})" for name in ("start", "open_date")}
    runs = {
        "in_target": ("new", "day_target_end", "day_start"),
        "in_lookback": ("new", "day_start", "day_prev_start"),
        "live": ("live", "day_start", still["open_date"]),
        "ending": ("ending", "day_end", f"least(day_start, {still['start']})"),
    }
    cells = ", ".join(
        S.struct(of=S.text(kind), flag=S.text(flag), place=place, change=change)
        for flag, (kind, first, past) in runs.items()
        for place, change in ((first, f"IF({first} < {past}, n, 0L)"), (past, f"IF({first} < {past}, -n, 0L)"))
    )
    return (
        rows.selectExpr("*", f"inline(array({cells}))")
        .where(f"of = kind AND change <> 0 AND place < {n}")
        .select(C.OWNER, "place", "flag", "change", C.CODE, C.TRANSFER)
    )


def swept_features(
    rows: DataFrame,
    cohorts: Sequence[Cohort],
    ids: DataFrame | None = None,
    codes: Sequence[str] = C.OCCUPATION_CODES,
    null_share: str = "is_null",
) -> DataFrame:
    """The rows of ``commitment_features`` from ``day_rows`` or a roll-up.

    Shuffled are the narrow rows alone, whatever the number of cohorts: events, of which a row has
    at most eight, and their running sums stay in the account's task.
    """
    if ids is not None:
        rows = restrict(rows, ids, C.OWNER)
    tasks = _tasks(rows)
    rows = _counted(rows, tasks).repartition(tasks, C.OWNER)
    conditions = {
        "total_commitments": "flag = 'in_target'",
        C.LOOKBACK: "flag = 'in_lookback'",
        "prev_12m_new_levy_transfers": f"flag = 'in_lookback' AND {C.TRANSFER} = 1",
        "commitments_ending_12m": "flag = 'ending'",
        "current_live_commitments": "flag = 'live'",
        **{
            name: cond.replace("in_lookback", "flag = 'in_lookback'")
            for name, cond in C._code_conditions(codes, null_share).items()
        },
    }
    parts = []
    for run in chains(cohorts):
        changes = _events(rows, run).groupBy(C.OWNER, "place").agg(
            *[
                F.expr(f"sum(CASE WHEN {cond} THEN change ELSE 0L END)").alias(name)
                for name, cond in conditions.items()
            ]
        )
        order = Window.partitionBy(C.OWNER).orderBy("place")
        so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = changes.select(
            C.OWNER,
            "place",
            F.coalesce(F.lead("place").over(order), F.lit(len(run))).alias("next"),
            *[F.sum(name).over(so_far).alias(name) for name in conditions],
        ).where(" OR ".join(f"{name} <> 0" for name in C.COUNTS))
        labels = ", ".join(S.text(c.label) for c in run)
        parts.append(
            counts.withColumn("place", F.explode(F.expr("sequence(place, next - 1)"))).selectExpr(
                f"{C.OWNER} AS a3",
                f"array({labels})[place] AS cohort",
                *[name if name in C.COUNTS else C._share(name) for name in C.feature_columns(codes)],
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
