"""Hashes of word shingles, a word hashed once a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

SEED = 42
#: Words that a task remembers the hashes of.
CACHE = 1 << 17
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def hasher(size: int) -> Callable[[str | None], np.ndarray]:
    """A function from a text to the 64-bit hashes of its shingles, repeats included, in order.

    A shingle is `size` words, lower-cased in A-Z; fewer words are one shingle, none are none.
    """
    from xxhash import xxh64_intdigest

    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) >= CACHE:
                self.clear()
            h = self[word] = xxh64_intdigest(word, SEED)
            return h

    known = Hashes()

    def shingles(text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # bytes split at ASCII white space
        w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(len(w) - size + 1, min(len(w), 1))
        x = np.full(n, min(len(w), size), np.uint64)
        for k in range(min(len(w), size)):
            x = (x ^ w[k : k + n]) * M1
            x ^= x >> np.uint64(29)
            x *= M2
            x ^= x >> np.uint64(32)
        return x

    return shingles


def sketcher() -> Callable[[list], Iterator[tuple[int]]]:
    """The least hash of three words in a row of each text: near copies mostly share it."""
    shingles = hasher(3)

    def compute(texts: list) -> Iterator[tuple[int]]:
        for t in texts:
            h = shingles(t)
            yield (int(h.min() >> np.uint64(1)) if len(h) else 0,)

    return compute
