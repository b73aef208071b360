"""The pipeline over a whole small table, each stage against a brute-force version of it."""

import re

import corpus_pipeline
from cohortloom.llm import odd_sketch, piece_lattice, quality_trees
from cohortloom.llm.common import table
from tests.llm.test_methods import closed, secrets_of


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def one_of_each_group(docs):
    sets = {}
    for i, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        size = min(5, len(words))
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()
    links = [
        (a, b)
        for a in docs
        for b in docs
        if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    component = closed(docs, links)
    return {i: text for i, text in docs.items() if component[i] == i}


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def without_leaks(docs, items):
    windows = set()
    for item in items:
        words = benchmark_words(item)
        size = min(10, len(words))
        windows |= {tuple(words[k : k + size]) for k in range(len(words) - size + 1) if size}
    sizes = {len(w) for w in windows}
    kept = {}
    for i, text in docs.items():
        words = benchmark_words(text)
        if not any(tuple(words[k : k + n]) in windows for n in sizes for k in range(len(words))):
            kept[i] = text
    return kept


def redacted(text):
    out, at = "", 0
    for span in filter(None, secrets_of(text).split(",")):
        _, start, stop = span.split(":")
        if int(start) >= at:
            out += text[at : int(start)] + "[SECRET]"
        at = max(at, int(stop))
    return out + text[at:]


def test_every_stage(spark, sf_dir):
    source = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in source.collect()}
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    model = quality_trees.train(source, table(spark, sf_dir, "labels"))
    scores = {i: model.score(quality_trees._matrix([t]))[0] for i, t in texts.items()}
    expected = {i: t for i, t in texts.items() if scores[i] >= 0.7}
    steps = {
        "quality": lambda d: expected,
        "near_duplicates": one_of_each_group,
        "decontamination": lambda d: without_leaks(d, items),
        "secrets": lambda d: {i: redacted(t) for i, t in d.items()},
    }
    docs = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        texts = steps[name](texts)
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == texts, name
        assert docs.count() == len(texts) and docs.columns == source.columns
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    pieces = piece_lattice.load_pieces()
    rows = corpus_pipeline.run(spark, sf_dir)
    back = {r["doc_id"]: r["text"] for r in piece_lattice.decode(rows, pieces).collect()}
    assert back == texts


def test_near_duplicates_take_small_batches(spark, sf_dir, monkeypatch):
    """Whole texts go to Python a few at a time, and the session's setting stays as it was."""
    name, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, odd_sketch.stored

    def recorded(df, what):
        seen[what] = int(spark.conf.get(name))
        return write(df, what)

    monkeypatch.setattr(odd_sketch, "stored", recorded)
    before = spark.conf.get(name)
    docs = table(spark, sf_dir, "documents")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == one_of_each_group(texts)
    assert 0 < seen["sketches"] <= 1000
    assert spark.conf.get(name) == before
