"""The corpus pipeline: stages in order, each working on all that the one before it kept.

1. Documents that the quality classifier rejects go.
2. Of each group of near-duplicates (five words, 0.8) one document stays.
3. Documents that hold a window of a benchmark item go.
4. Secrets are replaced by a mark; no document goes.
5. What is left is encoded: one row of pieces per document.

Stages 1 to 4 return the columns of documents. Null and empty texts pass every stage that does not
reject them for their score; extra columns are carried along, whatever their names; empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import decontaminate, odd_sketch, piece_lattice, quality_trees, secret_ledger
from cohortloom.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_trees.train(docs, table(spark, sf_dir, "labels"))
    return quality_trees.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return odd_sketch.representatives(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_ledger.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_lattice.encode(docs, piece_lattice.load_pieces())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]
#: No SQL: trees, sketches and lattices cannot be stated in it; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
