"""Headline queries, timed end to end from the driver tables: prints one JSON line.

Each query is built and run into the noop sink, so that every column of every row is computed
and nothing is collected. ``queries`` has the second run of each, ``first_run`` the first.
"""

from __future__ import annotations

import json
import os
import time

from checks import catalog
from checks import tables as T
from checks.catalog import FITTED, QUERIES
from checks.run import local_session
from cohortloom.operators import commitments as C
from cohortloom.operators import sweep as W
from cohortloom.plans import features as PF
from cohortloom.sources import ParquetSource, read_bucketed, read_tables, store_bucketed

HEADLINE = (
    "cohort_features",
    "asof_features",
    "occupation_share",
    "commitments_ending_12m",
    "current_live_commitments",
    "scheme_features",
    "industry_features",
    "sample_stratified",
    "sample_stratified_large",
    "column_profile",
    "training_frame",
    "training_frame_industry",
    "training_frame_sampled",
    "score_frame",
    "evaluate",
    "train_regressor",
    "score_pipeline",
)


def timed(spark, sf_dir: str, name: str) -> float:
    FITTED.clear()
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    return round(time.perf_counter() - start, 3)


def on_stored_tables(spark, sf_dir: str) -> dict[str, float]:
    """The engine's own time: cohorts from source tables that are stored, not derived here."""
    root = catalog.scratch(spark)
    derived = T.tables(spark, sf_dir)
    for name, df in zip(("pt_a", "pt_b", "pt_d", "pt_i"), vars(derived).values()):
        df.write.parquet(f"{root}/plain/{name}")
    store_bucketed(derived, f"{root}/bucketed", 8)
    plain = read_tables(spark, ParquetSource(f"{root}/plain"))
    bucketed = read_bucketed(spark, f"{root}/bucketed", 8)
    frames = {
        "cohort_features": lambda: PF.cohort_frame(plain.accounts, plain.commitments, T.COHORTS),
        "cohort_features_bucketed": lambda: PF.cohort_frame(
            bucketed.accounts, bucketed.commitments, T.COHORTS
        ),
        "monthly_by_sweep": lambda: W.swept_features(
            W.day_rows(plain.commitments), catalog.MONTHS
        ),
        "monthly_by_scan": lambda: C.commitment_features(plain.commitments, catalog.MONTHS),
    }
    times = {}
    for name, frame in frames.items():
        for _ in range(2):
            start = time.perf_counter()
            frame().write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    first = {name: timed(spark, sf_dir, name) for name in HEADLINE}
    second = {name: timed(spark, sf_dir, name) for name in HEADLINE}
    stored = on_stored_tables(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of second runs",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "stored_tables": stored,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
