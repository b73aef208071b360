"""Words of a text as 64-bit hashes, and hashes of words that follow one another, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 200_000


class WordIds(dict):
    """Hashes of words, remembered; emptied when it holds ``CACHE_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` ids that follow one another; empty where there are fewer."""
    out = np.full(max(0, len(ids) - size + 1), size, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + len(out)])
    return out
