"""Substring dedup by block lookup, in place of a relative Lempel-Ziv parse.

In such a parse a text is read against everything that comes before it (smaller doc_id, then earlier start): it
is a sequence of factors, each a copy of an earlier passage, and of new words. Only factors of at
least ``WINDOW`` words count, so a factor is a run of windows of that many words that all start
somewhere earlier too. The greedy parse itself is not done: no factor is extended from a source
position, as that needs an ordered pass over all text. Those windows are found by hash instead.

Reference blocks are cut by content: every window has an anchor, the ``GRAM`` words in it with the
smallest hash (the first of equal ones), and consecutive windows with one anchor are a block. The
same passage falls into the same blocks wherever it stands. All blocks of all texts are indexed by
anchor. A block that equals an earlier one continues a factor. A block whose anchor is known with
other surroundings is at a boundary, where a factor ends, begins, or goes over to another source:
there each window is looked up by itself. All other blocks are new words.

Tasks settle first what they can among their own blocks: repeats of a block become spans at once,
and of an anchor with many surroundings two blocks are passed on and the others are asked about
window by window, so that a line that every document holds is not gathered in one place.

Defined cases: null and empty texts have no words; texts shorter than a window keep all; repeated
rows (equal doc_id and text) are one document, whose result each gets; if texts differ under one
doc_id, what is found in either is removed from both; a row without a doc_id has no place in the
order and keeps all its words; columns beyond doc_id and text are ignored. Blocks and windows are
compared by two independent 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import stored
from cohortloom.llm.words import WordIds, chained, mix

WINDOW, GRAM = 20, 5
CHUNK_WORDS = 1_000_000

BLOCK, SPAN, ASK = 0, 1, 2
BLOCKS = "kind int, anchor long, block long, doc_id long, start int, n int"


def windows(ids: np.ndarray, ends: np.ndarray):
    """Places, hashes and anchors of the windows of texts laid end to end.

    ``ends`` is, for each word, where its text ends. Returned are a window's first word, the hash
    of all its words, and its anchor's place and hash.
    """
    none = np.zeros(0, np.int64)
    at = np.flatnonzero(np.arange(len(ids)) + WINDOW <= ends)
    if not len(at):
        return at, none.view(np.uint64), none, none.view(np.uint64)
    grams = chained(ids, GRAM)
    cover = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
    place = np.empty(len(at), np.int64)
    for i in range(0, len(at), 1 << 16):
        part = at[i : i + (1 << 16)]
        place[i : i + len(part)] = part + cover[part].argmin(axis=1)
    # a window is its first and last grams that touch, so grams of grams hash all its words
    whole = np.full(len(at), WINDOW, np.uint64)
    for i in range(0, WINDOW, GRAM):
        whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + grams[at + i])
    return at, whole, place, grams[place]


def blocks(at: np.ndarray, whole: np.ndarray, place: np.ndarray, anchor: np.ndarray):
    """First window's number, length, anchor and hash of every block."""
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(at) else at
    n = np.diff(np.r_[first, len(at)])
    # its first and last window overlap, so they and their distance are all of it
    body = mix(whole[first] + mix(whole[first + n - 1]) * np.uint64(3))
    body = mix(body + (n.astype(np.uint64) << np.uint64(8)))
    body = mix(body + (place[first] - at[first]).astype(np.uint64))
    return first, n, anchor[first], body


def settle(anchor: np.ndarray, block: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """Which blocks repeat an earlier one here, and the rank of the others among their anchor's."""
    order = np.lexsort((start, doc, block, anchor))
    a, b, d, s = anchor[order], block[order], doc[order], start[order]
    new_anchor = np.r_[True, a[1:] != a[:-1]]
    new_block = new_anchor | np.r_[True, b[1:] != b[:-1]]
    group = np.flatnonzero(new_block)[np.cumsum(new_block) - 1]
    repeat = np.empty(len(a), bool)
    repeat[order] = (d != d[group]) | (s != s[group])
    numbers = np.cumsum(new_block)
    rank = np.empty(len(a), np.int64)
    rank[order] = numbers - numbers[np.flatnonzero(new_anchor)[np.cumsum(new_anchor) - 1]]
    return repeat, rank


def _merged(doc: np.ndarray, start: np.ndarray, n: np.ndarray):
    """Runs of windows, with those joined that follow one another; in order of the text."""
    if not len(doc):
        return doc, start, n
    joined = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + n[:-1])
    first = np.flatnonzero(np.r_[True, ~joined])
    return doc[first], start[first], np.add.reduceat(n, first)


def _laid_out(batches: Iterator[pd.DataFrame], ids: WordIds):
    """Rows of several texts, of CHUNK_WORDS together or more: the rows, their words' hashes."""
    rows, parts, total = [], [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            words = ids.of((row.text or "").encode().split())
            rows.append(row)
            parts.append(words)
            total += len(words)
            if total >= CHUNK_WORDS:
                yield rows, parts
                rows, parts, total = [], [], 0
    if rows:
        yield rows, parts


def _placed(rows, parts):
    """Windows of the chunk's texts, and of each the doc_id and the start in its text."""
    sizes = np.array(list(map(len, parts)))
    begins = np.cumsum(np.r_[0, sizes[:-1]])
    text_of = np.repeat(np.arange(len(parts)), sizes)
    ids = np.concatenate(parts)
    at, whole, place, anchor = windows(ids, (begins + sizes)[text_of] if len(ids) else ids)
    text = text_of[at] if len(at) else at
    docs = np.array([row.doc_id for row in rows], np.int64)
    return text, docs[text], at - begins[text], at, whole, place, anchor


def _frame(kind: int, anchor, block, doc, start, n) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "kind": np.full(len(doc), kind, np.int32),
            "anchor": np.asarray(anchor, np.uint64).view(np.int64),
            "block": np.asarray(block, np.uint64).view(np.int64),
            "doc_id": doc,
            "start": start.astype(np.int32),
            "n": n.astype(np.int32),
        }
    )


def _loose(kind: int, doc, start, n) -> pd.DataFrame:
    """Rows that need not meet others: their anchor only spreads them."""
    spread = mix(doc.astype(np.uint64) + (start.astype(np.uint64) << np.uint64(32)))
    return _frame(kind, spread, np.zeros(len(doc), np.uint64), doc, start, n)


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of the task's texts; those it can settle by itself as spans and questions."""
    for rows, parts in _laid_out(batches, WordIds()):
        text, doc, start, at, whole, place, anchor = _placed(rows, parts)
        if not len(at):
            continue
        first, n, anchors, bodies = blocks(at, whole, place, anchor)
        doc, start = doc[first], start[first]
        repeat, rank = settle(anchors, bodies, doc, start)
        ask = ~repeat & (rank >= 2)
        yield _loose(SPAN, *_merged(doc[repeat], start[repeat], n[repeat]))
        yield _loose(ASK, *_merged(doc[ask], start[ask], n[ask]))
        on = ~repeat & ~ask
        yield _frame(BLOCK, anchors[on], bodies[on], doc[on], start[on], n[on])


def _look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The windows asked about, by hash; repeats among the task's own as spans."""
    for rows, parts in _laid_out(batches, WordIds()):
        text, doc, start, at, whole, place, anchor = _placed(rows, parts)
        if not len(at):
            continue
        asked = np.zeros(len(at), bool)
        begins = np.searchsorted(text, np.arange(len(rows)))
        for i, row in enumerate(rows):
            for run in row.runs:
                asked[begins[i] + run["start"] : begins[i] + run["start"] + run["n"]] = True
        doc, start, whole, anchor = doc[asked], start[asked], whole[asked], anchor[asked]
        repeat, _ = settle(anchor, whole, doc, start)
        one = np.ones(len(doc), np.int64)
        yield _loose(SPAN, *_merged(doc[repeat], start[repeat], one[repeat]))
        on = ~repeat
        yield _frame(BLOCK, anchor[on], whole[on], doc[on], start[on], one[on])


def _first_of(*keys: str):
    return F.min(F.struct("doc_id", "start")).over(Window.partitionBy(*keys))


def find_spans(documents: DataFrame) -> DataFrame:
    """Runs of windows that start earlier too: doc_id, first window's start, number of windows."""
    texts = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    place = F.struct("doc_id", "start")
    by_anchor = Window.partitionBy("anchor", "kind")
    settled = (
        texts.mapInPandas(_index, BLOCKS)
        .withColumn("varied", F.min("block").over(by_anchor) < F.max("block").over(by_anchor))
        .withColumn("first", _first_of("anchor", "kind", "block"))
        .withColumn(
            "kind",
            F.when(F.col("kind") != BLOCK, F.col("kind"))
            .when(place != F.col("first"), SPAN)
            .when(F.col("varied"), ASK),
        )
        .where("kind is not null")
        .select("kind", "doc_id", "start", "n")
    )
    settled = stored(settled, "factors")
    runs = (
        settled.where(F.col("kind") == ASK)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    )
    single = (
        texts.join(runs, "doc_id")
        .mapInPandas(_look_up, BLOCKS)
        .withColumn("first", _first_of("anchor", "kind", "block"))
        .where((F.col("kind") == SPAN) | (place != F.col("first")))
    )
    columns = ["doc_id", "start", "n"]
    return settled.where(F.col("kind") == SPAN).select(*columns).union(single.select(*columns))


def covered(n_words: int, runs) -> np.ndarray:
    """Which words the runs' windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for run in runs:
        edge[run["start"]] += 1
        edge[min(n_words, run["start"] + run["n"] - 1 + WINDOW)] -= 1
    return np.cumsum(edge[:-1]) > 0


def dedup(documents: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, and ``kept``: what is left, words by spaces."""
    runs = (
        find_spans(documents)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "n")).alias("runs"))
        .withColumnRenamed("doc_id", "of")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                words = (row.text or "").encode().split()
                n = len(words)
                if row.runs is not None and n:
                    kept = np.flatnonzero(~covered(n, row.runs)).tolist()
                    words = [words[i] for i in kept]
                out.append((row.doc_id, n, n - len(words), b" ".join(words).decode()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = (
        texts.join(runs, F.col("doc_id") == F.col("of"), "left")
        .select(F.col("doc_id").cast("string").alias("doc_id"), "text", "runs")
        .mapInPandas(run, "doc_id string, n_words long, n_removed long, kept string")
    )
    return kept.withColumn("doc_id", F.col("doc_id").cast("long"))
