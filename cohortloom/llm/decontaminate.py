"""Benchmark decontamination: document word windows matched against a set of benchmark n-grams.

A window is ``WINDOW`` consecutive words of an item, or the whole of a shorter item. Every window
of w words holds a whole block of ceil(w / 2) words that starts, in the document, at a multiple of
that size. So documents are scanned block by block, not window by window: blocks that are also
somewhere in an item are found by a join, and the words around such a pair are compared to see
how far document and item agree. Where they agree for w words or more, all of them are hit. A long
text is cut into pieces first, which overlap by the words around a block.

The n-grams of the items are broadcast when they are counted to be at most ``BROADCAST_GRAMS``;
a larger benchmark is joined by shuffling the blocks, with the same result.

Defined cases: null and empty texts have no words and are not contaminated; repeated rows give
repeated results; rows that share a doc_id but not the text are judged apart; null item_ids are
not counted among items; columns beyond doc_id and text (item_id and text) are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import ascii_lower, sha256_hex, unused

WINDOW = 10
BROADCAST_GRAMS = 200_000
#: About how many words of a document are scanned as one row.
PIECE = 3840
#: Words consist of digits, letters and everything that is not ASCII.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CELL = "struct<size: int, at: int, gram: string, near: array<string>>"


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(ascii_lower(text), BREAK, " ")), " ")


def _tokenised(df: DataFrame, reach: int, *keys: str) -> DataFrame:
    """Number of words, and the words with ``reach`` empty ones on either side."""
    pad = F.array_repeat(F.lit(""), reach)
    return df.select(*keys, words(F.coalesce("text", F.lit(""))).alias("words")).select(
        *keys,
        F.when(F.col("words")[0] == "", 0).otherwise(F.size("words")).alias("n"),
        F.concat(pad, "words", pad).alias("padded"),
    )


def _cells(starts: Column, size: int, step: int, reach: int) -> Column:
    """An n-gram of half the window, with the words around it, at ``step`` times every start."""
    block = (size + 1) // 2
    own = size - block
    return F.transform(
        starts,
        lambda i: F.struct(
            F.lit(size).alias("size"),
            (i * step).alias("at"),
            F.array_join(F.slice("padded", i * step + reach + 1, block), " ").alias("gram"),
            F.slice("padded", i * step + reach - own + 1, own + size).alias("near"),
        ),
    )


def _pieces(docs: DataFrame, blocks: list[int], reach: int) -> DataFrame:
    """Pieces of the padded words, each with the word it begins at: a multiple of every block."""
    size = math.lcm(*blocks)
    size *= max(1, PIECE // size)
    last = F.floor((F.greatest(F.col("n"), F.lit(1)) - 1) / size).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda p: F.struct(
            (p * size).alias("base"),
            F.least(F.col("n") - p * size, F.lit(size)).alias("own"),
            F.slice("padded", p * size + 1, size + 2 * reach).alias("padded"),
        ),
    )
    return docs.select("doc_id", "text_key", "n", F.explode(pieces).alias("p")).select(
        "doc_id", "text_key", "n", "p.*"
    )


def _starts(last: Column, some: Column) -> Column:
    none = F.array().cast("array<int>")
    return F.when(some, F.sequence(F.lit(0), last)).otherwise(none)


def item_grams(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every n-gram of every item: its window's size, text, item, and the words around it."""
    reach = window // 2
    cells = []
    for size in range(1, window + 1):
        fits = F.col("n") >= size if size == window else F.col("n") == size
        starts = _starts(F.col("n") - (size + 1) // 2, fits)
        cells.append(_cells(starts, size, 1, reach))
    return (
        _tokenised(benchmark, reach, "item_id")
        .select("item_id", F.explode(F.concat(*cells)).alias("g"))
        .select("item_id", "g.size", "g.gram", F.col("g.near").alias("theirs"))
        .distinct()
    )


def find_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs of hit words: doc_id, text_key, n, item_id, first and last word (from 0).

    Every document row also has one row without a run, so that all are there.
    """
    reach = window // 2
    grams = item_grams(benchmark, window)
    counts = {r["size"]: r["count"] for r in grams.groupBy("size").count().collect()}
    if sum(counts.values()) <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    cells = []
    for size in sorted(counts or {window: 0}):
        block = (size + 1) // 2
        last = F.floor(F.col("own") / block).cast("int") - 1
        some = (F.col("n") >= size) & (F.col("own") >= block)
        cells.append(_cells(_starts(last, some), size, block, reach))
    row = F.when(F.col("base") == 0, F.array(F.lit(None).cast(CELL)))
    row = row.otherwise(F.array().cast(f"array<{CELL}>"))
    blocks = [(size + 1) // 2 for size in counts or {window: 0}]
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = (
        _pieces(_tokenised(docs, reach, "doc_id", "text_key"), blocks, reach)
        .select("doc_id", "text_key", "n", "base", F.explode(F.concat(row, *cells)).alias("b"))
        .select("doc_id", "text_key", "n", "base", "b.*")
        .withColumn("at", F.col("base") + F.col("at"))
        .join(grams, ["size", "gram"], "left")
        .where(F.col("theirs").isNotNull() | F.col("at").isNull())
        .withColumn("same", F.zip_with("near", "theirs", lambda a, b: (a == b) & (a != "")))
    )
    block = F.ceil(F.col("size") / 2).cast("int")
    own = F.col("size") - block

    def run(flags: Column) -> Column:
        stop = F.array_position(flags, False).cast("int")
        return F.when(stop == 0, own).otherwise(stop - 1)

    return (
        found.withColumn("left", run(F.reverse(F.slice("same", F.lit(1), own))))
        .withColumn("right", run(F.slice("same", own + block + 1, own)))
        .where(F.col("at").isNull() | (F.col("left") + F.col("right") >= own))
        .select(
            "doc_id",
            "text_key",
            "n",
            "item_id",
            (F.col("at") - F.col("left")).alias("first"),
            (F.col("at") + block - 1 + F.col("right")).alias("last"),
        )
    )


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: words, hit words, items with windows in it, and whether any word is hit.

    ``text_key`` tells rows of one doc_id apart whose texts differ.
    """
    is_run = F.col("first").isNotNull()
    found = (
        find_hits(documents, benchmark, window)
        .groupBy("doc_id", "text_key")
        .agg(
            F.max("n").alias("n"),
            F.count_if(~is_run).cast("int").alias("rows"),
            F.collect_set(F.when(is_run, F.struct("first", "last"))).alias("runs"),
            F.collect_set(F.when(is_run, F.col("item_id"))).alias("items"),
        )
        .withColumn("row", F.explode(F.array_repeat(F.lit(0), F.col("rows"))))
    )
    hit = F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))
    items = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "text_key",
        F.col("n").cast("long").alias("n_words"),
        F.size(F.array_distinct(hit)).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        sha256_hex(F.array_join(items, ",")).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows, as they are, in which no word is hit."""
    bad = contamination(documents, benchmark, window).where("contaminated")
    doc, key = unused(documents, "bad_doc"), unused(documents, "bad_key")
    bad = bad.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key))
    same = documents["doc_id"].eqNullSafe(F.col(doc))
    key = F.xxhash64(documents["text"]) == F.col(key)
    return documents.join(bad, same & key, "left_anti")
