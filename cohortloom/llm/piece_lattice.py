"""SentencePiece encoding and decoding: the N best segmentations of a text over its piece lattice.

A text gets a leading space, spaces become the model's space sign, and every piece of the model
that occurs is an edge of the lattice, weighted by the piece's log probability. A model of merges
has ranks instead, whose sums mean nothing: they become log probabilities that fall with the
logarithm of the rank, as frequencies of words do. A character without a piece of its own is an
edge too, below every piece, and comes out as the model's byte pieces. A forward Viterbi pass gives the best score from the start to every position. That is the exact
remaining cost of an A-star search that goes backwards from the end: it takes up only hypotheses
that lie on one of the N best paths, and finds those in order.

No piece has a space sign after another sign (checked when a model is loaded), so no path crosses
the beginning of a run of spaces, and the lattice of a text falls into chunks at these places. The
forward pass runs over all new chunks of some hundred texts at once, in numpy, and is kept in a
bounded cache of the task. It also tells what the chunk's
second best path loses, and the N best paths of a text differ from its best one only in the N - 1
chunks that lose least: the search backwards runs there. They are given as changes to the best.

Defined cases: null and empty texts have no pieces, score 0 and decode to empty text; a text that
holds the space sign itself gets its bytes, so it decodes to what it was; of equal scores the path
found first counts, which depends on the text and model alone; repeated rows give repeated
results; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
CACHE_ENTRIES, CACHE_CHARS = 400_000, 40
GROUP = 500
#: The rank from which frequencies fall in proportion to the rank (of Zipf and Mandelbrot).
FLAT_RANKS = 1000
SPACE = "▁"
#: Stands for a space sign of the text itself; no valid text holds it.
OWN_SPACE = "\ud800"
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

ENCODED = (
    "ids array<int>, score double, scores array<double>, alternatives"
    " array<array<struct<at: int, drop: int, ids: array<int>>>>, decodes boolean"
)


@dataclass(frozen=True)
class Pieces:
    """A model's pieces: of each prefix of a piece, its id and score, or no id."""

    prefixes: dict[str, tuple[int, float]]
    surfaces: list[str]
    byte_ids: list[int]
    unknown: float


def log_probability(score: float, ranks: bool) -> float:
    """Of a piece: its score, or of a merge's rank, which the model has as 0, -1, -2 and so on."""
    return -math.log(FLAT_RANKS - score) if ranks else score


def load_pieces(path: str = MODEL) -> Pieces:
    """Read once on the driver; what is sent to the tasks is bounded by the model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.GetPieceSize()
    surfaces, prefixes, least = [""] * n, {}, 0.0
    byte_ids = [0] * 256
    scores = [model.GetScore(i) for i in range(n)]
    ranks = all(s == int(s) for s in scores) and min(scores) < -n / 2
    for i in range(n):
        piece = model.IdToPiece(i)
        if model.IsByte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        elif not (model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i)):
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"a space sign inside a piece: {piece}")
            surfaces[i] = piece
            score = log_probability(scores[i], ranks)
            least = min(least, score)
            for stop in range(1, len(piece)):
                prefixes.setdefault(piece[:stop], (-1, 0.0))
            prefixes[piece] = (i, score)
    if not all(byte_ids):
        raise ValueError("the model has no byte pieces")
    return Pieces(prefixes, surfaces, byte_ids, least - 10.0)


def n_best(text: str, pieces: Pieces, n: int = BEST) -> list[tuple[float, list[int]]]:
    """The n best segmentations of a text that is in the model's signs: score and pieces.

    The search counts what a hypothesis loses against the best path. The best edge into a position
    loses nothing, so a hypothesis is followed back to the start along best edges at once, and
    each position on the way gives one more hypothesis, with its next edge. Every hypothesis has a
    whole path at its own cost: only as many as paths are still wanted need to be kept.
    """
    size, find, unknown = len(text), pieces.prefixes.get, pieces.unknown
    ending: list[list[tuple[float, int, int]]] = [[] for _ in range(size + 1)]
    ahead = [0.0] * (size + 1)
    for start in range(size):
        if start:
            ahead[start] = max(ending[start])[0]
        base, single = ahead[start], False
        for stop in range(start + 1, size + 1):
            found = find(text[start:stop])
            if found is None:
                break
            if found[0] >= 0:
                ending[stop].append((base + found[1], start, found[0]))
                single |= stop == start + 1
        if not single:
            ending[start + 1].append((base + unknown, start, -1))
    best = ahead[size] = max(ending[size])[0]
    edges: dict[int, list[tuple[float, int, int]]] = {}

    def into(at: int) -> list[tuple[float, int, int]]:
        if at not in edges:
            edges[at] = sorted(ending[at], reverse=True)
        return edges[at]

    out, open_, made = [], [(0.0, 0, size, 0, None)], 0
    while open_ and len(out) < n:
        loss, _, at, nth, path = open_.pop(0)
        more = []
        total = loss
        while at:
            own = into(at)
            if nth + 1 < len(own):
                made += 1
                cost = total + own[nth][0] - own[nth + 1][0]
                more.append((cost, made, at, nth + 1, path))
            _, start, piece = own[nth]
            path, at, nth = (start, piece, path), start, 0
        ids: list[int] = []
        while path is not None:
            start, piece, path = path
            ids += [piece] if piece >= 0 else _bytes(text[start], pieces)
        out.append((best - loss, ids))
        open_ = sorted(open_ + more)[: n - len(out)]
    return out


def _bytes(sign: str, pieces: Pieces) -> list[int]:
    return [pieces.byte_ids[b] for b in sign.replace(OWN_SPACE, SPACE).encode()]


class Lattice:
    """The model's prefixes as arrays: for a prefix and a sign, the longer prefix and its piece."""

    def __init__(self, pieces: Pieces):
        number = {"": 0} | {prefix: i for i, prefix in enumerate(pieces.prefixes, 1)}
        steps = sorted((number[p[:-1]] << 21 | ord(p[-1]), i) for p, i in number.items() if p)
        self.keys, self.next = np.array(steps, np.int64).T.copy()
        found = [(-1, 0.0), *pieces.prefixes.values()]
        self.piece = np.array([i for i, _ in found], np.int64)
        self.score = np.array([score for _, score in found])
        self.unknown = pieces.unknown
        # the prefix of a single sign, or -1
        self.first = np.full(sys.maxunicode + 1, -1)
        single = self.keys < 1 << 21
        self.first[self.keys[single]] = self.next[single]

    def edges(self, signs: np.ndarray, ends: np.ndarray):
        """Start, end, piece and score of every edge of texts laid end to end."""
        out, size = [], 0
        single = np.zeros(len(signs), bool)
        at, state = np.arange(len(signs)), None
        while len(at):
            if state is None:
                state = self.first[signs]
                hit = state >= 0
                at, state = at[hit], state[hit]
            else:
                inside = at + size < ends[at]
                at, state = at[inside], state[inside]
                key = state << 21 | signs[at + size]
                i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[i] == key
                at, state = at[hit], self.next[i[hit]]
            size += 1
            whole = self.piece[state] >= 0
            if size == 1:
                single[at[whole]] = True
            start, last = at[whole], state[whole]
            out.append((start, start + size, self.piece[last], self.score[last]))
        start = np.flatnonzero(~single)
        out.append((start, start + 1, np.full(len(start), -1), np.full(len(start), self.unknown)))
        return tuple(map(np.concatenate, zip(*out)))


def best_paths(chunks: list[str], lattice: Lattice, pieces: Pieces):
    """The forward pass over many chunks: by chunk the best score and what the next best loses,
    all pieces, and how many are each chunk's.

    All chunks go forward together, one place at a time. A next best path leaves the best one at
    one place, by that place's next edge. Of equal scores the later start counts, as in ``n_best``.
    """
    text = SPACE + SPACE.join(chunks)
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(chunks)), sizes)
    start, stop, piece, score = lattice.edges(signs, ends[of])
    # a chunk of n signs has n + 1 places, numbered after those of the chunks before it
    chunk = of[start]
    depth = stop - (ends - sizes)[chunk]
    # by place, then chunk, then start: the longest edge into a place begins first
    longest = int((stop - start).max()) + 1
    order = np.argsort((depth * len(chunks) + chunk) * longest - (stop - start))
    start, stop, piece, score, chunk, depth = (
        v[order] for v in (start, stop, piece, score, chunk, depth)
    )
    source, target = start + chunk, stop + chunk
    best = np.zeros(len(text) + len(chunks))
    second, back = np.full(len(best), -np.inf), np.zeros(len(best), np.int64)
    cuts = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1], True])
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        to, total = target[low:high], best[source[low:high]] + score[low:high]
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        top = np.maximum.reduceat(total, first)
        ties = total == np.repeat(top, np.diff(np.r_[first, len(to)]))
        winner = np.maximum.reduceat(np.where(ties, np.arange(len(to)), -1), first)
        place = to[first]
        best[place], back[place] = top, low + winner
        total[winner] = -np.inf
        second[place] = np.maximum.reduceat(total, first)
    last = ends + np.arange(len(chunks))
    scores, loss = best[last], np.full(len(chunks), np.inf)
    walk, at = np.arange(len(chunks)), last
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(walk):
        loss[walk] = np.minimum(loss[walk], best[at] - second[at])
        edge = back[at]
        steps.append((walk, edge))
        at = source[edge]
        going = at > (last - sizes)[walk]
        walk, at = walk[going], at[going]
    owner, edge = (np.concatenate(v)[::-1] for v in zip(*steps))
    order = np.argsort(owner * len(owner) + np.arange(len(owner)))
    owner, edge = owner[order], edge[order]
    ids = piece[edge].astype(np.int32)
    sizes = np.ones(len(ids), np.int64)
    unknown = np.flatnonzero(ids < 0)
    spelt = [_bytes(text[start[e]], pieces) for e in edge[unknown]]
    sizes[unknown] = list(map(len, spelt))
    if len(unknown):
        begin = np.cumsum(sizes) - sizes
        ids = np.repeat(ids, sizes)
        for at, part in zip(begin[unknown].tolist(), spelt):
            ids[at : at + len(part)] = part
    counts = np.bincount(owner, sizes, len(chunks)).astype(np.int64)
    return scores, loss, ids, counts


class Paths:
    """Best paths of chunks: a number for each chunk, and by number score, loss, pieces, and
    whether the pieces decode to the chunk."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.number: dict[str, int] = {}
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.good = np.zeros(0, bool)

    def add(self, chunks: list[str], score, loss, ids: np.ndarray, counts: np.ndarray) -> None:
        self.number.update(zip(chunks, range(len(self.score), len(self.score) + len(chunks))))
        self.score, self.loss = np.r_[self.score, score], np.r_[self.loss, loss]
        ends = np.cumsum(counts)
        self.first = np.r_[self.first, self.first[-1] + ends]
        self.ids = np.r_[self.ids, ids]
        self.good = np.r_[self.good, self._decode(chunks, ids, ends)]

    def _decode(self, chunks: list[str], ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the pieces up to each end, from the end before, are the chunk's text."""
        made = b"".join(map(self.encoder.surfaces.__getitem__, ids.tolist()))
        stops = np.cumsum(self.encoder.sizes[ids])[ends - 1]
        # a chunk of a run of spaces has the model's sign for them, and another for the sign itself
        signs = f" {' '.join(chunks)}".replace(SPACE, " ")
        text = signs.replace(OWN_SPACE, SPACE).encode()
        points = np.frombuffer(signs.encode("utf-32-le", "surrogatepass"), np.uint32)
        widths = np.ones(len(points), np.int64)
        for more in (0x80, 0x800, 0x10000):
            widths += points >= more
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
        wanted = np.cumsum(widths)[np.cumsum(sizes) - 1]
        if made == text:
            same = wanted == stops
            return same & np.r_[True, same[:-1]]
        places = [np.r_[0, v].tolist() for v in (stops, wanted)]
        spans = zip(*(v[k:] for v in places for k in (0, 1)))
        return np.array([made[a:b] == text[c:d] for a, b, c, d in spans], bool)

    def pieces(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of chunks one after another, and where each chunk's begin, with the end."""
        sizes = self.first[numbers + 1] - self.first[numbers]
        begin = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=begin[1:])
        at = np.arange(begin[-1]) + np.repeat(self.first[numbers] - begin[:-1], sizes)
        return self.ids[at], begin


class Encoder:
    """Encodes texts, remembering the short chunks it has met in two bounded generations."""

    def __init__(self, pieces: Pieces, n: int = BEST):
        self.pieces, self.n, self.lattice = pieces, n, Lattice(pieces)
        self.surfaces = [s.replace(SPACE, " ").encode() for s in pieces.surfaces]
        for byte, i in enumerate(pieces.byte_ids):
            self.surfaces[i] = bytes([byte])
        self.sizes = np.array(list(map(len, self.surfaces)))
        self.known, self.older = Paths(self), Paths(self)
        self.ways: dict[str, list[tuple[float, list[int]]]] = {}

    def chunks(self, text: str) -> list[str]:
        """The text's chunks, each without the space sign it begins with."""
        signs = text.replace(SPACE, OWN_SPACE)
        if "  " in signs or signs[:1] == " " or signs[-1:] == " ":
            return [c[1:] for c in CHUNK.findall(SPACE + signs.replace(" ", SPACE))]
        return signs.split(" ") if signs else []

    def learn(self, lists: list[list[str]]) -> np.ndarray:
        """The numbers of all chunks, list after list, whose best paths are then at hand."""
        if len(self.known.number) > CACHE_ENTRIES:
            short = {c: i for c, i in self.known.number.items() if len(c) <= CACHE_CHARS}
            self.older, self.known = self.known, Paths(self)
            self.older.number = short
        flat = list(chain.from_iterable(lists))
        numbers = np.fromiter(map(self.known.number.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(numbers < 0)
        wanted = list(map(flat.__getitem__, missing.tolist()))
        new, again = [], []
        for chunk in dict.fromkeys(wanted):
            (again if chunk in self.older.number else new).append(chunk)
        if new:
            self.known.add(new, *best_paths(new, self.lattice, self.pieces))
        if again:
            old = np.fromiter(map(self.older.number.__getitem__, again), np.int64, len(again))
            ids, begin = self.older.pieces(old)
            scores, loss = self.older.score[old], self.older.loss[old]
            self.known.add(again, scores, loss, ids, np.diff(begin))
        numbers[missing] = np.fromiter(
            map(self.known.number.__getitem__, wanted), np.int64, len(wanted)
        )
        return numbers

    def encode_all(self, texts: list[str]):
        """Of each text the pieces, the n best scores, the others' changes, and if it decodes."""
        lists = list(map(self.chunks, texts))
        numbers = self.learn(lists)
        ends = np.cumsum(list(map(len, lists)))
        return list(map(self._encode, lists, np.split(numbers, ends[:-1])))

    def encode(self, text: str):
        return self.encode_all([text])[0][:3]

    def _encode(self, chunks: list[str], numbers: np.ndarray):
        if not chunks:
            return np.zeros(0, np.int32), [0.0], [], True
        known = self.known
        best = float(known.score[numbers].sum())
        ids, begin = known.pieces(numbers)
        # the n cheapest sets of changes, chunk by chunk: cost, then chunk and alternative
        sets: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        others = {}
        for c in sorted(_cheapest(known.loss[numbers], self.n - 1)):
            ways = self._ways(chunks[c])
            others[c] = [alternative for _, alternative in ways[1:]]
            more = [
                (cost + ways[0][0] - way[0], (*changes, (c, k)))
                for cost, changes in sets
                for k, way in enumerate(ways[1:])
            ]
            sets = sorted(sets + more)[: self.n]
        changes = []
        for _, chosen in sets[1:]:
            edits = []
            for c, k in chosen:
                at, drop = int(begin[c]), int(begin[c + 1] - begin[c])
                edits.append({"at": at, "drop": drop, "ids": others[c][k]})
            changes.append(edits)
        # pieces of chunks decode one after another, so a text does if all of its chunks do
        good = bool(known.good[numbers].all())
        return ids, [best - cost for cost, _ in sets], changes, good

    def _ways(self, chunk: str) -> list[tuple[float, list[int]]]:
        if (found := self.ways.get(chunk)) is None:
            found = n_best(SPACE + chunk, self.pieces, self.n)
            if len(chunk) <= CACHE_CHARS:
                if len(self.ways) >= CACHE_ENTRIES // 20:
                    self.ways.clear()
                self.ways[chunk] = found
        return found

    def decode(self, ids: list[int]) -> str:
        """The text of any segmentation; bytes that are no valid text become its usual sign."""
        return b"".join(map(self.surfaces.__getitem__, ids)).decode("utf-8", "replace")[1:]


def _cheapest(costs: np.ndarray, n: int) -> list[int]:
    """Positions of the n smallest costs, the first of equal ones; none of infinite cost."""
    if len(costs) > n:
        bound = np.partition(costs, n - 1)[n - 1] if n else -np.inf
        under = np.flatnonzero(costs < bound)
        equal = np.flatnonzero(costs == bound)[: n - len(under)]
        places = [*under.tolist(), *equal.tolist()]
    else:
        places = range(len(costs))
    return [c for c in places if costs[c] < np.inf]


def encode(documents: DataFrame, pieces: Pieces, n: int = BEST) -> DataFrame:
    """doc_id with the best ``ids`` and ``score``, the n ``scores`` and the others' changes.

    An alternative is a list of changes to ``ids``: at a position, so many pieces give way to
    others. ``decodes`` says whether the best pieces decode to the text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(pieces, n)
        for batch in batches:
            for start in range(0, len(batch), GROUP):
                part = batch[start : start + GROUP]
                texts = [text or "" for text in part["text"]]
                rows = []
                for ids, scores, changes, same in encoder.encode_all(texts):
                    rows.append((ids, scores[0], scores, changes, same))
                names = ["ids", "score", "scores", "alternatives", "decodes"]
                out = pd.DataFrame(rows, columns=names)
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out

    ids = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    encoded = ids.mapInPandas(run, f"doc_id string, {ENCODED}")
    return encoded.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id and text of every row of ``ids``; null ids decode to empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(pieces, 1)
        for batch in batches:
            texts = [encoder.decode([] if ids is None else list(ids)) for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": texts})

    ids = encoded.select(F.col("doc_id").cast("string").alias("doc_id"), "ids")
    texts = ids.mapInPandas(run, "doc_id string, text string")
    return texts.withColumn("doc_id", F.col("doc_id").cast(encoded.schema["doc_id"].dataType))
