"""Personal data by weak supervision: labelers vote on spans, a classifier learns from the votes.

Base spans follow fixed patterns and checks and are always reported. Further candidates are wider
patterns: matches that fail a base check, numbers in local notation, names after a title. Four
labelers vote on every span, for, against or not at all: the patterns and their checks, gazetteers
(domain ends, calling codes, issuers, given names), words in the context, and the span's shape and
its neighbours. Expectation-maximisation over the counts of vote patterns, taken over all
documents, estimates how reliable each labeler is and how likely each pattern means personal data.
A logistic model of the spans' features is then fitted to these likelihoods, on about
``MAX_TRAIN`` spans at most (by a hash; the bound is a parameter), and decides on the candidates.

A text is read once: what is kept of it are its spans with votes and features. Scoring is an
expression over these, so nothing is shuffled but the counts. Candidates can overlap: each is voted on
and scored, and of accepted ones that overlap the best score stays.

Defined cases: null and empty texts have no spans; a candidate that overlaps a base span is not
reported, nor one that overlaps an accepted candidate of a higher score (of equal ones the earlier
start, then kind, then end goes first); repeated rows give repeated results; without any candidate nothing is fitted and base
spans alone are reported; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from cohortloom.llm.common import sha256_hex, stored

MAX_TRAIN = 50_000
ACCEPT = 0.9
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "id", "name")
LABELERS = ("pattern", "gazetteer", "context", "shape")
CONTEXT = 40

LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a number that fails here fails at each of its later digits too, so those need no try
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
DIGIT_RUN = re.compile(r"\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
NAME = re.compile(
    r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme|Monsieur|Madame)\b\.?\x20"
    r"([A-Z]\w{1,20}(?:\x20[A-Z]\w{1,20})?)"
)

#: Fixed values of the gazetteers and context labelers.
DOMAIN_ENDS = frozenset("com org net edu gov info io de fr es uk eu it nl ch at us ca".split())
CALLING_CODES = ("1", "7", "20", "27", "3", "4", "5", "6", "81", "82", "86", "9")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "65")
GIVEN_NAMES = frozenset(
    "Anna Antonio Carlos Carmen Charles Claire David Elena Emma Hans James Jean John Jose Juan"
    " Julia Karl Laura Lucia Luis Maria Marie Mary Michael Paul Peter Pierre Robert Sarah Sophie"
    " Thomas Ursula William Wolfgang".split()
)
CUES_FOR = re.compile(
    r"(?i)\b(?:e-?mail|mail|contact|call|tel|phone|mobile|fax|card|visa|account|ssn|passport|"
    r"name|address|telefon|correo|courriel|konto|nombre|nom)\b"
)
CUES_AGAINST = re.compile(
    r"(?i)\b(?:version|release|isbn|order|invoice|page|section|figure|table|chapter|build|"
    r"model|serial|item|seite|p[aá]gina)\b|[$€£%#]"
)

SPANS = (
    "array<struct<start: int, rank: int, stop: int, base: boolean, votes: array<int>,"
    " features: array<double>>>"
)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their ``@``: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_number(text: str) -> bool:
    part = text.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Kind, start, end and whether the checks hold, of every match of a base pattern."""
    for start, stop in emails(text):
        yield "email", start, stop, True
    for m in IP.finditer(text):
        yield "ip", m.start(), m.end(), all(map(small_number, m[0].split(".")))
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        yield "card", m.start(), m.end(), 12 <= len(digits) <= 19 and luhn(digits)
    for m in PHONE.finditer(text):
        yield "phone", m.start(), m.end(), 9 <= len(only_digits(m[0])) <= 15


def find_spans(text: str) -> list[tuple]:
    """Base spans and further candidates: start, rank of the kind, end, base, votes, features."""
    good, bad = [], []
    if ANY.search(text):
        for kind, start, stop, holds in base_matches(text):
            (good if holds else bad).append((start, KINDS.index(kind), stop))
        for m in DIGIT_RUN.finditer(text):
            if 7 <= len(only_digits(m[0])) <= 19:
                bad.append((m.start(), KINDS.index("id"), m.end()))
    for m in NAME.finditer(text):
        bad.append((m.start(1), KINDS.index("name"), m.end(1)))
    taken = sorted((start, stop) for start, _, stop in good)
    more, at = [], 0
    for start, rank, stop in sorted(bad):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= stop:
            more.append((start, rank, stop))
    spans = [(*s, True, *_judge(text, *s, True)) for s in good]
    spans += [(*s, False, *_judge(text, *s, False)) for s in more]
    return sorted(spans, key=lambda s: s[:3])


def _judge(text: str, start: int, rank: int, stop: int, holds: bool):
    """Votes of the labelers (1 for, 0 against, -1 none) and the features of one span."""
    kind, span = KINDS[rank], text[start:stop]
    before, after = text[max(0, start - CONTEXT) : start], text[stop : stop + CONTEXT // 2]
    digits = only_digits(span)
    pattern = 1 if holds else 0 if kind in BASE else -1
    known = {
        "email": lambda: span.rpartition(".")[2].lower() in DOMAIN_ENDS,
        "ip": lambda: not span.startswith(("0.", "127.", "255.")),
        "card": lambda: digits.startswith(ISSUERS),
        "phone": lambda: digits.startswith(CALLING_CODES),
        "id": lambda: None,
        "name": lambda: span.split(" ")[0] in GIVEN_NAMES,
    }[kind]()
    gazetteer = -1 if known is None else int(known)
    cue, counter = bool(CUES_FOR.search(before)), bool(CUES_AGAINST.search(before))
    context = int(cue) if cue != counter else -1
    joined = (before[-1:].isalnum() or before[-1:] in (".", "-", "_")) and kind != "email"
    joined_after = after[:1].isalnum() or after[:1] in ("@", "_")
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    grouped = len(groups) > 1 and groups[-1] == 4
    shape = 0 if joined or joined_after else 1 if grouped or kind in ("email", "name") else -1
    features = [1.0, *(float(rank == i) for i in range(len(KINDS)))]
    features += [float(holds), float(known is True), float(cue), float(counter)]
    features += [float(joined), float(joined_after), float(grouped)]
    features += [float(luhn(digits)) if 12 <= len(digits) <= 19 else 0.0, len(digits) / 20]
    return [pattern, gazetteer, context, shape], features


def scan(documents: DataFrame) -> DataFrame:
    """doc_id and spans of every row, each with its votes and features."""
    names = ["start", "rank", "stop", "base", "votes", "features"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in find_spans(t or "")] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "spans": spans})

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = rows.mapInPandas(run, f"doc_id string, spans {SPANS}")
    return found.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))


@dataclass(frozen=True)
class Model:
    """What the votes say: chance of personal data by vote pattern; and the span classifier."""

    reliability: np.ndarray
    chance: dict[tuple[int, ...], float]
    weights: np.ndarray | None


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50):
    """EM: share of personal data, and each labeler's votes given the truth.

    Labelers are independent given the truth. At the start each is right in 8 of 10 votes, which
    also settles which of the two classes is personal data. A count of one is added to each cell.
    """
    onehot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    prior = 0.5
    table = np.tile(np.log([[0.2, 0.64, 0.16], [0.2, 0.16, 0.64]]), (patterns.shape[1], 1, 1))
    for _ in range(rounds):
        log = np.einsum("plv,lcv->pc", onehot, table) + np.log([1 - prior, prior])
        yes = 1 / (1 + np.exp(log[:, 0] - log[:, 1]))
        weight = counts * np.stack([1 - yes, yes])
        seen = np.einsum("cp,plv->lcv", weight, onehot) + 1
        table = np.log(seen / seen.sum(axis=2, keepdims=True))
        prior = float(np.clip((counts @ yes + 1) / (counts.sum() + 2), 1e-3, 1 - 1e-3))
    return np.exp(table), yes


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25, l2: float = 1.0) -> np.ndarray:
    """Newton steps on the log loss against chances between 0 and 1."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - l2 * w)
    return w


def learn(scanned: DataFrame, limit: int = MAX_TRAIN) -> Model:
    """Reliabilities from the vote patterns of all spans, weights from about ``limit`` of them."""
    spans = scanned.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    rows = spans.groupBy("votes").count().collect()  # at most 3 ** len(LABELERS)
    if not rows:
        return Model(np.zeros((len(LABELERS), 2, 3)), {}, None)
    rows = sorted((tuple(r["votes"]), r["count"]) for r in rows)
    patterns, counts = np.array([v for v, _ in rows]), np.array([c for _, c in rows], float)
    reliability, yes = estimate(patterns, counts)
    chance = {votes: float(p) for (votes, _), p in zip(rows, yes)}
    share = limit / counts.sum()
    if share < 1:
        spans = spans.where((F.xxhash64("doc_id", "start") % 2**30 + 2**30) / 2**31 < share)
    sample = spans.groupBy("votes", "features").count().toPandas()
    if sample.empty:
        return Model(reliability, chance, None)
    x = np.repeat(np.stack(sample["features"]), sample["count"], axis=0)
    y = np.repeat([chance[tuple(v)] for v in sample["votes"]], sample["count"])
    order = np.lexsort((y, *x.T))
    return Model(reliability, chance, fit_logistic(x[order], y[order]))


def best_apart(spans: list[tuple[int, int, int, float]]) -> list[int]:
    """Positions of the (start, rank, end, score) that stay, best first, where none overlap."""
    order = sorted(range(len(spans)), key=lambda i: (-spans[i][3], spans[i][:3]))
    taken: list[tuple[int, int]] = []
    kept = []
    for i in order:
        start, _, stop, _ = spans[i]
        at = bisect_left(taken, (stop,))  # those from here on start at or after the end
        if at == 0 or taken[at - 1][1] <= start:
            taken.insert(at, (start, stop))
            kept.append(i)
    return sorted(kept)


@F.pandas_udf(ArrayType(IntegerType()))
def _places(starts: pd.Series, ranks: pd.Series, stops: pd.Series, scores: pd.Series) -> pd.Series:
    rows = zip(starts, ranks, stops, scores)
    return pd.Series([best_apart(list(zip(*(c.tolist() for c in row)))) for row in rows])


def decide(scanned: DataFrame, model: Model) -> DataFrame:
    """Base spans, and the candidates that the classifier takes for personal data.

    Where accepted candidates overlap, the best of them stay.
    """
    if model.weights is None:
        return scanned.withColumn("spans", F.filter("spans", lambda s: s["base"]))
    weights = F.array(*map(F.lit, model.weights.tolist()))
    bound = float(np.log(ACCEPT / (1 - ACCEPT)))

    def score(span: Column) -> Column:
        terms = F.zip_with(span["features"], weights, lambda x, w: x * w)
        return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)

    frame = scanned.withColumn(
        "_best", F.filter("spans", lambda s: ~s["base"] & (score(s) >= bound))
    )
    best = F.col("_best")
    places = _places(best["start"], best["rank"], best["stop"], F.transform(best, score))
    frame = frame.withColumn("_places", F.when(F.size(best) > 1, places))
    kept = F.transform("_places", lambda i: F.get(best, i))
    base = F.filter("spans", lambda s: s["base"])
    spans = F.sort_array(F.concat(base, F.when(F.size(best) > 1, kept).otherwise(best)))
    return frame.withColumn("spans", spans).select(*scanned.columns)


def detect(documents: DataFrame) -> DataFrame:
    scanned = stored(scan(documents), "spans")
    return decide(scanned, learn(scanned))


def digests(detected: DataFrame) -> DataFrame:
    """Counts of the base kinds, the base spans' digest, and all spans as text."""
    kinds = F.array(*map(F.lit, KINDS))

    def listed(spans: Column) -> Column:
        parts = F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["stop"]),
        )
        return F.array_join(parts, ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(rank: int) -> Column:
        return F.size(F.filter(base, lambda s: s["rank"] == rank)).cast("long")

    return detected.select(
        "doc_id",
        *[count(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)],
        sha256_hex(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
