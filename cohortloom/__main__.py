"""``spark-submit``-able jobs: ``python -m cohortloom train|score ...``."""

from __future__ import annotations

import argparse
import dataclasses
import json
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from cohortloom.operators.learning import CAREFUL_PARAMS, BoostParams
from cohortloom.operators.schemes import SCHEME_CUTOFF
from cohortloom.plans.features import FeatureSettings
from cohortloom.plans.scoring import score_pipeline
from cohortloom.plans.training import train_pipeline, training_frame
from cohortloom.rules import read_code_map
from cohortloom.session import build_session
from cohortloom.sources import (
    DatabaseSource,
    ParquetSource,
    key_bounds_sql,
    key_cuts,
    key_quantiles_sql,
    read_query,
    read_tables,
)
from cohortloom.sources.database import key_range, parse_split


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cohortloom")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("train", "score"):
        job = jobs.add_parser(name)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--tables", help="folder with pt_a, pt_b, pt_d, pt_i")
        source.add_argument("--url", help="JDBC url of a database with these tables")
        job.add_argument("--property", action="append", default=[], help="NAME=VALUE for JDBC")
        job.add_argument(
            "--split", action="append", default=[], metavar="TABLE=COLUMN:PARTS",
            help="read a database table by ranges of a column; bounds are asked for",
        )
        job.add_argument(
            "--even", action="store_true",
            help="cut ranges at quantiles of the rows, which the database sorts for it",
        )
        job.add_argument("--accounts", help="Parquet with a column a3: the accounts to take")
        job.add_argument("--scheme-cutoff", type=date.fromisoformat, default=SCHEME_CUTOFF)
        job.add_argument("--null-share", choices=("is_null", "equals_null"), default="is_null")
        job.add_argument("--model", required=True, help="folder of the saved model")
        job.add_argument("--code-map", help="CSV old_code,new_code, or a text with the recode as SQL: turns industry features on")
        job.add_argument("--sample", type=int, help="accounts (per stratum when training)")
        job.add_argument("--seed", type=int, default=42)
        if name == "train":
            job.add_argument("--split-key", choices=("row", "account"), default="row")
            job.add_argument("--careful", action="store_true", help="many small steps")
            job.add_argument("--trees", type=int)
            job.add_argument("--levy-only", action="store_true")
        else:
            job.add_argument("--as-of", required=True, type=datetime.fromisoformat)
            job.add_argument("--out", required=True)
            job.add_argument("--format", choices=("csv", "parquet"), default="csv")
            job.add_argument("--mode", choices=("error", "overwrite", "append", "day"), default="error")
            job.add_argument("--compat", action="store_true", help="as-run scoring, base 2")
    return top


def source_of(spark: SparkSession, args: argparse.Namespace) -> ParquetSource | DatabaseSource:
    """The folder, or the database with the ranges its large tables are read by."""
    if args.tables:
        return ParquetSource(args.tables)
    properties = dict(p.split("=", 1) for p in args.property)
    splits = {}
    for text in args.split:
        table, column, parts = parse_split(text)
        if args.even:
            sql = key_quantiles_sql(table, column, parts)
            rows = read_query(spark, args.url, sql, properties=properties).collect()
            splits[table] = key_cuts(column, [row[0] for row in rows])
            continue
        bounds = read_query(
            spark, args.url, key_bounds_sql(table, column), properties=properties
        ).first()
        splits[table] = key_range(column, parts, bounds)
    return DatabaseSource(args.url, {}, {t: k for t, k in splits.items() if k}, properties=properties)


def run(spark: SparkSession, argv: Sequence[str]) -> dict:
    args = parser().parse_args(argv)
    tables = read_tables(spark, source_of(spark, args))
    settings = FeatureSettings(
        scheme_cutoff=args.scheme_cutoff,
        code_map=read_code_map(spark, args.code_map) if args.code_map else None,
        null_share=args.null_share,
    )
    ids = spark.read.parquet(args.accounts).select("a3") if args.accounts else None
    if args.job == "train":
        params = CAREFUL_PARAMS if args.careful else BoostParams()
        if args.trees:
            params = dataclasses.replace(params, max_iter=args.trees)
        frame = training_frame(
            tables,
            n=args.sample,
            seed=args.seed,
            settings=settings,
            levy_accounts_only=args.levy_only,
            ids=ids,
        )
        trained = train_pipeline(frame, params, args.model, split_key=args.split_key)
        return {"features": len(trained.features), **trained.metrics.first().asDict()}
    scored = score_pipeline(
        tables,
        args.as_of,
        args.model,
        args.out,
        args.sample,
        args.seed,
        settings,
        args.compat,
        args.format,
        ids,
        args.mode,
    )
    return {"out": args.out, "filled": scored.filled}


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    print(json.dumps(run(build_session(), sys.argv[1:] if argv is None else argv)))


if __name__ == "__main__":
    main()
