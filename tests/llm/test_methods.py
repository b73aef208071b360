"""Each operator against a brute-force version, an exact round trip or held-out labels."""

import hashlib
import os
import random
import re
import threading
import time
from contextlib import contextmanager, suppress
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.run import difference
from cohortloom.llm import (
    catalog,
    components,
    decontaminate,
    e8_lattice,
    license_rules,
    odd_sketch,
    pii_votes,
    piece_lattice,
    quality_trees,
    relative_lz,
    secret_ledger,
)
from cohortloom.llm.common import shared_path, table

QUIET = settings(max_examples=60, deadline=None)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equal_to_sql(spark, duck, sf_dir, name):
    assert difference(spark, duck, catalog.QUERIES[name], catalog.ORACLES[name], sf_dir) is None


# --- quality ------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    scored = catalog.QUERIES["op1_quality_trees"](spark, sf).join(
        table(spark, sf, "labels"), "doc_id"
    )
    rows = [r for r in scored.collect() if r["held_out"] and r["quality"] is not None]
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    wins = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert len(rows) > 50 and wins > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_trees_walk_as_they_were_grown():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality_trees.fit(x, y, trees=40, depth=3)
    scores = model.score(x)
    assert ((scores > 0.5) == y).mean() > 0.95

    def walk(row):
        total = model.base
        for t in range(len(model.feature)):
            at = 0
            while at < 7:
                at = 2 * at + 1 + (row[model.feature[t, at]] > model.cut[t, at])
            total += model.leaf[t, at - 7]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(scores[:50], [walk(row) for row in x[:50]])


# --- pieces -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return piece_lattice.load_pieces()


def all_scores(signs, pieces):
    out = []

    def rest(at, score):
        if at == len(signs):
            out.append(score)
            return
        single = False
        for stop in range(at + 1, len(signs) + 1):
            piece, value = pieces.prefixes.get(signs[at:stop], (-1, 0.0))
            if piece >= 0:
                rest(stop, score + value)
                single |= stop == at + 1
        if not single:
            rest(at + 1, score + pieces.unknown)

    rest(0, 0.0)
    return sorted(out, reverse=True)


@QUIET
@given(st.text(alphabet="thein a漢\n", min_size=1, max_size=12))
def test_n_best_are_the_best(pieces, text):
    encoder = piece_lattice.Encoder(pieces, 5)
    ids, scores, changes = encoder.encode(text)
    expected = all_scores("▁" + text.replace(" ", "▁"), pieces)[:5]
    assert np.allclose(scores, expected, atol=1e-9) and len(changes) == len(expected) - 1
    for edits in changes:
        other, shift = ids.tolist(), 0
        for e in edits:
            at = e["at"] + shift
            other[at : at + e["drop"]] = e["ids"]
            shift += len(e["ids"]) - e["drop"]
        assert encoder.decode(other) == text and other != ids.tolist()


def test_segmentations_are_close_to_the_library_s(pieces, sf_dir):
    """Whole documents: chunks that the library cuts alike, and pieces against its own."""
    import pandas as pd
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_lattice.MODEL)
    encoder = piece_lattice.Encoder(pieces)
    texts = [t for t in pd.read_parquet(f"{sf_dir}/documents.parquet")["text"] if t]
    alike = chunks = own = theirs = size = 0
    for text, (ids, *_, good) in zip(texts, encoder.encode_all(texts)):
        assert good and encoder.decode(ids.tolist()) == text
        own, theirs = own + len(ids), theirs + len(library.encode(text))
        size += len(text.encode())
        words = encoder.chunks(text)
        for word, (found, *_) in zip(words, encoder.encode_all(words)):
            alike += found.tolist() == library.encode(word)
        chunks += len(words)
    assert alike > 0.8 * chunks
    assert own <= 1.01 * theirs and own < 0.6 * size
    the = encoder.encode("the documents of the house")[0].tolist()
    assert the == library.encode("the documents of the house")


def test_ranks_become_falling_log_probabilities():
    found = [piece_lattice.log_probability(-r, True) for r in (0, 10, 1000, 30_000)]
    assert found == sorted(found, reverse=True) and found[0] < 0
    assert piece_lattice.log_probability(-3.5, False) == -3.5


@QUIET
@given(st.text(max_size=60))
def test_pieces_decode_to_the_text(pieces, text):
    encoder = piece_lattice.Encoder(pieces)
    ids, *_, decodes = encoder.encode_all([text])[0]
    assert decodes and encoder.decode(ids.tolist()) == text


@pytest.mark.parametrize("text", ["a  b", "   ", " a ▁ ▁▁b  ", "▁", "ü  漢 \n \t ", "x\n  y"])
def test_runs_of_spaces_and_the_sign_itself(pieces, text):
    encoder = piece_lattice.Encoder(pieces)
    ids, *_, decodes = encoder.encode_all([text])[0]
    assert decodes and encoder.decode(ids.tolist()) == text


def test_pieces_that_are_not_the_text_are_told(pieces):
    paths = piece_lattice.Encoder(pieces).known
    for chunks in (["ab", "c"], ["äb", "c"]):
        _, _, ids, counts = piece_lattice.best_paths(chunks, paths.encoder.lattice, pieces)
        ends = np.cumsum(counts)
        assert paths._decode(chunks, ids, ends).tolist() == [True, True]
        assert paths._decode([chunks[0], "d"], ids, ends).tolist() == [True, False]
        assert paths._decode([chunks[0] + " c"[:1], "c"], ids, ends).tolist()[0] is False


def test_pieces_over_a_border_of_chunks_are_told(pieces):
    """All pieces are the whole text, but one chunk's are cut elsewhere."""
    paths = piece_lattice.Encoder(pieces).known
    for chunks in (["ab", "c", "d"], ["äb", "c", "d"], ["ab", "漢", "d"]):
        ids = [paths.encoder.pieces.byte_ids[b] for b in f" {' '.join(chunks)}".encode()]
        ends = np.cumsum([len(f" {c}".encode()) for c in chunks])
        assert paths._decode(chunks, np.array(ids), ends).tolist() == [True, True, True]
        ends[0] -= 1
        assert paths._decode(chunks, np.array(ids), ends).tolist() == [False, False, True]


def test_one_lookup_numbers_the_chunks(pieces, monkeypatch):
    """Numbers of known, new and remembered chunks, before and after the cache turns over."""
    monkeypatch.setattr(piece_lattice, "CACHE_ENTRIES", 3)
    encoder, long = piece_lattice.Encoder(pieces), "ä" * (piece_lattice.CACHE_CHARS + 1)
    for text in ("the house the ", "", f"  of {long} ▁ the", f"a house {long} of of", "b", "the a"):
        lists = [encoder.chunks(text), [], encoder.chunks("the")]
        numbers = encoder.learn(lists)
        assert numbers.tolist() == [encoder.known.number[c] for chunks in lists for c in chunks]
        fresh = piece_lattice.Encoder(pieces)
        found, alone = (e.encode_all([text, "", "the"]) for e in (encoder, fresh))
        assert [(i.tolist(), *rest) for i, *rest in found] == [
            (i.tolist(), *rest) for i, *rest in alone
        ]


def test_decode_as_a_table(spark, pieces):
    docs = spark.createDataFrame([(1, "a  b\nc"), (2, ""), (3, None)], "doc_id long, text string")
    back = piece_lattice.decode(piece_lattice.encode(docs, pieces), pieces)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {1: "a  b\nc", 2: "", 3: ""}


# --- near-duplicates ----------------------------------------------------------------------------


def closed(ids, links):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in ids}


def edited(rng, words, share):
    return [f"new{rng.random()}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("block", [3, 400])
def test_near_duplicates(spark, monkeypatch, block):
    rng = random.Random(3)
    docs = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(rng.choice((5, 60, 200)))]
        docs += [edited(rng, base, rng.choice((0, 0.005, 0.02, 0.05))) for _ in range(12)]
    monkeypatch.setattr(odd_sketch, "BLOCK", block)
    frame = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string"
    )
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(frame, 3, 85).collect()}
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in docs]
    links = [
        (i, j)
        for i in range(len(docs))
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    assert len(links) > 20 and got == closed(range(len(docs)), links)


def test_sketches_estimate_similarity():
    plan = odd_sketch.Plan(3, 85)
    rng = np.random.default_rng(5)
    for share in (0.85, 0.9, 0.97):
        both = int(400 * 2 * share / (1 + share))
        x = rng.integers(0, 1 << 63, 800 - both, dtype=np.uint64)
        bits = odd_sketch.fold(odd_sketch.minima([x[:400], x[400 - both :]], plan.samples))
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= plan.most_ones


def test_components_of_links(spark):
    rng = random.Random(9)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    links += [(500 + i, 501 + i) for i in range(40)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(frame).collect()}
    ids = {i for link in links if link[0] != link[1] for i in link}
    assert got == closed(ids, [link for link in links if link[0] != link[1]])


@pytest.mark.parametrize("block", [7, 1000])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(e8_lattice, "BLOCK", block)
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, 32))
    x = centers[rng.integers(0, 30, 300)] + 0.25 * rng.normal(size=(300, 32))
    x = np.concatenate([x, x[:20]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: tuple(r)[1:3] for r in e8_lattice.near_duplicates(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    expected = closed(range(len(x)), zip(*map(list, np.nonzero(close))))
    links = close.sum(axis=1)
    assert sum(g for g, _ in got.values()) >= 0.98 * links.sum() > 1000
    assert all(got[i][0] <= links[i] for i in got)
    assert np.mean([got[i][1] == expected[i] for i in got]) > 0.98


@contextmanager
def disk_of(spark):
    """Most bytes that shuffles and stored tables have had beyond those at first."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    dirs = [str(d) for d in env.blockManager().diskBlockManager().localDirs()]
    dirs.append(re.sub("^file:/*", "/", str(Path(shared_path(spark, "x")).parent)))

    def used():
        found = 0
        for d in dirs:
            for folder, _, names in os.walk(d):
                for name in names:
                    with suppress(FileNotFoundError):
                        found += os.path.getsize(f"{folder}/{name}")
        return found

    first, most, over = used(), [0], threading.Event()

    def watch():
        while not over.wait(0.05):
            most[0] = max(most[0], used() - first)

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        yield most
    finally:
        over.set()
        thread.join()


def test_vectors_take_little_disk(spark, monkeypatch):
    monkeypatch.setattr(e8_lattice, "ROUND", 1)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(20_000, 64)).astype(np.float32)
    x[10_000:10_400] = x[:400] + 0.2 * rng.normal(size=(400, 64))
    schema = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame(list(enumerate(x.tolist())), schema).persist()
    frame.count()
    with disk_of(spark) as most:
        got = {r["vec_id"]: r["n_links"] for r in e8_lattice.near_duplicates(frame).collect()}
    frame.unpersist()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = np.array([(u[i] @ u.T >= 0.9).sum() - 1 for i in range(len(u))])
    assert sum(got.values()) >= 0.99 * links.sum() > 700
    assert all(got[i] <= links[i] for i in got)
    assert most[0] < 4 * x.nbytes


@pytest.mark.parametrize("n", [1000, 10**6, 10**8])
def test_cells_at_the_threshold(n):
    plan = e8_lattice.make_plan(n)
    rng = np.random.default_rng(12)
    x, z = rng.normal(size=(2, 2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    planes = plan.planes(64)
    a, b = (plan.cells(v, planes) for v in (x, 0.9 * x + (1 - 0.81) ** 0.5 * z))
    a, b = (c.reshape(2000, plan.tables, plan.points) for c in (a, b))
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() > 0.995 and plan.tables * plan.points <= 64


# --- substrings ---------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk", [50, 1_000_000])
def test_removed_words(spark, monkeypatch, chunk):
    monkeypatch.setattr(relative_lz, "CHUNK_WORDS", chunk)
    rng = random.Random(4)
    passages = [[f"p{p}w{i}" for i in range(rng.randrange(15, 60))] for p in range(6)]
    docs = []
    for d in range(60):
        words = []
        for k in range(rng.randrange(1, 6)):
            part = rng.choice(passages)
            at = rng.randrange(0, 10)
            words += [f"d{d}k{k}i{i}" for i in range(rng.randrange(0, 12))] + part[at:]
        docs.append(words)
    docs += [["same"] * 70, ["a", "b"] * 30, docs[0]]
    order = list(range(len(docs)))
    rng.shuffle(order)
    frame = spark.createDataFrame([(i, " ".join(docs[i])) for i in order], "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in relative_lz.dedup(frame.repartition(5)).collect()}
    seen = set()
    for i, words in enumerate(docs):
        gone = set()
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if window in seen:
                gone.update(range(at, at + 20))
            seen.add(window)
        assert got[i] == " ".join(w for k, w in enumerate(words) if k not in gone)


# --- decontamination ----------------------------------------------------------------------------


@pytest.mark.parametrize("grams", [200_000, 0])
def test_windows_across_pieces(spark, monkeypatch, grams):
    """Items of every length 1 to 20 in texts of many pieces, joined by broadcast and by shuffle."""
    monkeypatch.setattr(decontaminate, "PIECE", 60)
    monkeypatch.setattr(decontaminate, "BROADCAST_GRAMS", grams)
    rng = random.Random(4)
    items = [[f"i{k}x{j}" for j in range(k)] for k in range(1, 21)]
    docs = []
    for d in range(60):
        words = [f"w{rng.randrange(50)}" for _ in range(rng.choice([0, 3, 59, 60, 61, 119, 400]))]
        for _ in range(rng.randrange(6)):
            at, item = rng.randrange(len(words) + 1), rng.choice(items)
            low = rng.randrange(len(item))
            words[at:at] = item[low : low + rng.randrange(1, 21)]
        docs.append(words)
    # what windows of which item are where, word by word
    expected = {}
    for i, words in enumerate(docs):
        hit, found = set(), set()
        for k, item in enumerate(items):
            size = min(10, len(item))
            windows = {tuple(item[a : a + size]) for a in range(len(item) - size + 1)}
            for at in range(len(words) - size + 1):
                if tuple(words[at : at + size]) in windows:
                    hit |= set(range(at, at + size))
                    found.add(k)
        expected[i] = (len(words), len(hit), len(found), bool(hit))
    frame = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string"
    )
    bench = spark.createDataFrame(
        [(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string"
    )
    got = decontaminate.contamination(frame, bench).collect()
    assert {
        r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got
    } == expected


def test_a_long_text_with_items_of_every_length(spark):
    """1,600,000 words in one text of 11 MB."""
    text = " ".join(f"w{i % 9973}" for i in range(1_600_000)) + " i9x0 i9x1"
    items = [(k, " ".join(f"i{k}x{j}" for j in range(k))) for k in range(1, 21)]
    frame = spark.createDataFrame([(1, text + " i2x0 i2x1")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame, bench).first()
    assert (got["n_words"], got["n_hit"], got["n_items"]) == (1_600_004, 2, 1)


# --- secrets, personal data, licences -----------------------------------------------------------


def secrets_of(text, rules=secret_ledger.ALL_RULES):
    found = []
    for rank, rule in enumerate(rules):
        pattern = rule.pattern.replace("(?i:", "(?ai:")
        for m in re.finditer(pattern, text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), rank, m.end(), rule.kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_secret_spans(spark):
    texts = [
        "secret: token: abcdefgh", "token=token=abcdefgh", "ÄAKIA" + "A" * 16, "\U0001f600" + "a1" * 12,
        "API_KEY = 'abcdef' apikey:\"x\" passwd=1234567", "AKIAAKIA" + "B" * 12, "f" * 23, "",
        "password=" + "0" * 30 + " token: " + "ab" * 20,
        "-----BEGIN RSA PRIVATE KEY-----\n" + "Ab3/\n" * 30 + "-----END RSA PRIVATE KEY-----",
        "-----BEGIN PRIVATE KEY-----" * 3 + "x" * 40 + "-----END PRIVATE KEY-----",
        "ghp_" + "a1B2" * 9 + " xoxb-123-" + "z" * 20 + " sk_live_" + "4" * 24 + " ghp_short",
        "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK", "see postgres://me:pa55w0rd@db.local:5432/x",
        "token=eyJhbGciOiJI.eyJzdWIiOiIx.abc-def", "https://a:b@c http://user@host/x:y@z",
    ]
    rng = random.Random(8)
    bits = ["token", "secret", "=", ": ", " ", "'", '"', "abcdef", "AKIA", "Z9" * 8, "0f" * 12, "ß"]
    bits += ["ghp_", "eyJ", ".", "://", "ab:cd@", "-----BEGIN PRIVATE KEY-----", "x1" * 9]
    texts += ["".join(rng.choices(bits, k=rng.randrange(1, 25))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = secret_ledger.digests(secret_ledger.scan(frame)).collect()
    for r in got:
        text = texts[r["doc_id"]]
        assert r["spans"] == secrets_of(text)
        base = secrets_of(text, secret_ledger.RULES)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    added = {s.split(":")[0] for r in got for s in r["spans"].split(",")}
    assert added >= {rule.kind for rule in secret_ledger.ALL_RULES}


def test_a_text_of_many_secrets(spark):
    """100,000 secrets in one text of 3 MB: found and redacted in time linear in them."""
    words = [f"ä{i:025x} " for i in range(100_000)]
    frame = spark.createDataFrame([(1, "".join(words)), (2, "plain")], "doc_id long, text string")
    began = time.monotonic()
    got = {r["doc_id"]: r for r in secret_ledger.digests(secret_ledger.scan(frame)).collect()}
    assert got[1]["n_hex"] == 100_000 and got[2]["n_hex"] == 0
    assert got[1]["spans"] == ",".join(f"hex:{27 * i + 1}:{27 * i + 26}" for i in range(100_000))
    clean = {r["doc_id"]: r["text"] for r in secret_ledger.redact(frame).collect()}
    assert clean == {1: "ä[SECRET] " * 100_000, 2: "plain"}
    assert time.monotonic() - began < 120


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    rules = secret_ledger.ALL_RULES
    first = spark.createDataFrame([(1, "token=abcdefg"), (2, "x")], "doc_id long, text string")
    secret_ledger.scan(first, path).collect()
    assert spark.read.parquet(path).count() == 2 * len(rules)
    second = spark.createDataFrame(
        [(3, "token=abcdefg"), (4, "new"), (5, "new")], "doc_id long, text string"
    )
    got = {r["doc_id"]: len(r["spans"]) for r in secret_ledger.scan(second, path).collect()}
    assert got == {3: 1, 4: 0, 5: 0}
    assert spark.read.parquet(path).count() == 3 * len(rules)
    newer = (secret_ledger.Rule("assign", "token=([a-z]+)", 1, 3, version=2), *rules[1:])
    secret_ledger.scan(second, path, newer).collect()
    assert spark.read.parquet(path).count() == 3 * len(rules) + 2


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@QUIET
@given(st.text(alphabet="a1.@- +()4\U0001f600", max_size=60))
def test_base_matches_are_the_patterns(text):
    got = list(pii_votes.base_matches(text))
    for kind, pattern in (("email", EMAIL), ("ip", IP)):
        assert [(s, e) for k, s, e, _ in got if k == kind] == [
            m.span() for m in pattern.finditer(text)
        ]


def test_luhn():
    assert pii_votes.luhn("4111111111111111") and not pii_votes.luhn("4111111111111112")


def test_votes_settle_what_is_personal(spark):
    rng = random.Random(6)
    texts = []
    for i in range(120):
        texts.append(f"call phone +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} now")
        texts.append(f"order page {rng.randrange(10**8, 10**9)}x of the build version")
        texts.append(f"mail me at user{i}@example.com")
    texts.append("phone 212 555-1234 and email bob@site.org, ip 1.2.3.4, 999.1.1.1")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scanned = pii_votes.scan(frame)
    model = pii_votes.learn(scanned)
    assert model.chance[(1, 1, 1, 1)] > 0.95
    assert all(p < 0.5 for votes, p in model.chance.items() if votes[2] == 0 and votes[3] == 0)
    rows = pii_votes.digests(pii_votes.decide(scanned, model)).collect()
    last = next(r for r in rows if r["doc_id"] == len(texts) - 1)
    assert (last["n_email"], last["n_ip"], last["n_card"], last["n_phone"]) == (1, 1, 0, 0)
    assert all(r["spans"] == "" for r in rows if "build version" in texts[r["doc_id"]])


def test_candidates_that_overlap_are_all_judged(spark):
    rng = random.Random(8)
    number = lambda a, b: rng.randrange(10**a, 10**b)
    texts = []
    for i in range(120):
        texts.append(f"call phone ({number(2, 3)}) 555-{number(3, 4)} now or mail u{i}@example.com")
        texts.append(f"call phone +1 ({number(2, 3)}) 555-{number(3, 4)} now")
        texts.append(f"order page {number(8, 9)}x of the build version {number(2, 3)} serial")
    local = ["212 555-1234", "123-45-6789", "212.555.1234", "(212) 555-1234"]
    before = len(texts)
    texts += [f"call phone {n} now" for n in local]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii_votes.digests(pii_votes.detect(frame)).collect()
    got = {r["doc_id"]: r["spans"] for r in rows}
    for i, number in enumerate(local):
        assert got[before + i] == f"id:11:{11 + len(number)}"


def test_best_of_overlapping_candidates():
    at = pii_votes.KINDS.index
    spans = [(0, at("card"), 9, 1.0), (0, at("id"), 9, 2.0), (5, at("ip"), 12, 3.0)]
    spans += [(12, at("id"), 20, 2.5), (14, at("card"), 16, 2.5), (21, at("name"), 25, 9.0)]
    assert pii_votes.best_apart(spans) == [2, 3, 5]
    chain = [(0, 2, 10, 1.0), (8, 2, 20, 2.0), (18, 2, 30, 3.0)]
    assert pii_votes.best_apart(chain) == [0, 2]
    rng = random.Random(9)
    for _ in range(200):
        some = [(s, rng.randrange(6), s + rng.randrange(1, 9), rng.random())
                for s in (rng.randrange(40) for _ in range(12))]
        kept = []
        for i in sorted(range(12), key=lambda i: (-some[i][3], some[i][:3])):
            if all(some[i][2] <= some[j][0] or some[j][2] <= some[i][0] for j in kept):
                kept.append(i)
        assert pii_votes.best_apart(some) == sorted(kept)


def test_license_rules_follow_the_order(spark):
    s = license_rules.SENTENCES
    bsd = [s["bsd-grant"] + ":", s["bsd-source"] + ".", s["bsd-binary"] + "."]
    texts = {
        1: "\n".join([*bsd, "some other words. " + s["bsd-names"].upper() + "."]),
        2: " ".join(bsd),
        3: " ".join(reversed(bsd)),
        4: f"x. {s['mit-released']}! {s['apache-header']}.",
        5: s["mit-grant"] + ":\n\n" + s["mit-notice"] + ".",
        6: s["mit-grant"] + ". " + s["isc-grant"] + ". " + s["mit-notice"],
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_rules.licenses(frame).collect()}
    assert got == {
        1: "BSD-3-Clause", 2: "BSD-2-Clause", 3: "", 4: "Apache-2.0,MIT", 5: "MIT", 6: "ISC"
    }


NOTICES = {
    "MIT": """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
}
NOTICES["BSD-2-Clause"] = NOTICES["BSD-3-Clause"].partition("3. ")[0]


def in_forms(text):
    """As it is, with other line ends, in comments, and wrapped at every word of a sentence."""
    lines = text.split("\n")
    yield from (text, text.replace("\n", "\r\n"))
    yield from ("\n".join(mark + line for line in lines) for mark in ("# ", " * ", "// "))
    yield "\n".join(line.strip().replace(" ", "\n") for line in lines)
    yield " ".join(line.strip() for line in lines)


def found_licenses(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = license_rules.licenses(frame).collect()
    return {r["doc_id"]: (r["n_known"], r["licenses"]) for r in rows}


def test_wrapped_notices(spark):
    forms = [(name, form) for name, text in NOTICES.items() for form in list(in_forms(text))[:6]]
    got = found_licenses(spark, [form for _, form in forms])
    assert [got[i][1] for i in range(len(forms))] == [name for name, _ in forms]
    known = {"MIT": 2, "BSD-3-Clause": 4, "ISC": 1, "GPL-2.0-or-later": 3, "MPL-2.0": 1}
    known |= {"Apache-2.0": 4, "BSD-2-Clause": 3}
    assert [got[i][0] for i in range(len(forms))] == [known[name] for name, _ in forms]


def test_runs_of_lines(spark):
    isc = NOTICES["ISC"]
    texts = [
        isc.replace("for any\n", "for any\n\n"),  # a blank line ends a sentence
        isc.replace("for any\n", "for any\nother\n"),
        "some text\n" + isc + "more text",
        'Licensed under the Apache License, Version 2.0\n(the "License");\nyou may',
        "Licensed under the MIT License\nLicensed under the MIT License",
    ]
    frame = [(i, t) for i, t in enumerate(texts)]
    got = found_licenses(spark, texts)
    assert got == {0: (0, ""), 1: (0, ""), 2: (1, "ISC"), 3: (1, ""), 4: (2, "MIT")}
    twice = spark.createDataFrame(frame + frame, "doc_id long, text string")
    rows = license_rules.licenses(twice).collect()
    assert sorted((r["doc_id"], r["n_known"], r["licenses"]) for r in rows) == sorted(
        (i, *v) for i, v in [*got.items(), *got.items()]
    )


PUBLISHED_GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""


def test_every_rule_on_its_notice(spark):
    forms = list(in_forms(PUBLISHED_GPL3))
    assert found_licenses(spark, forms) == {
        i: (2, "GPL-3.0-or-later") for i in range(len(forms))
    }
    s = license_rules.SENTENCES
    notices = [" ".join(s[i] + ";" for i in ids) for _, ids in license_rules.RULES]
    got = found_licenses(spark, [*notices, *(n.replace(" ", "\n") for n in notices)])
    names = [name for name, _ in license_rules.RULES]
    assert [got[i][1] for i in range(len(got))] == [*names, *names]
