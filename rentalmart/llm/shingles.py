"""Word shingles of a text as sorted 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

REMEMBERED = 300_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    return x ^ (x >> np.uint64(29))


class Shingler:
    """of(text): the distinct hashes, ascending, of the ``k``-word shingles of a text; with
    fewer words the whole sequence is one shingle, without words there is none. Words are
    runs without ASCII white space; A-Z are lower-cased."""

    def __init__(self, k: int):
        self.k = k
        self.weights = [_ODD[j % len(_ODD)] + np.uint64(2 * (j // len(_ODD))) for j in range(k)]
        self.words = _Words()

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        w = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        n = max(1, len(w) - self.k + 1)
        h = np.full(n, np.uint64(min(len(w), self.k)))
        for j in range(min(len(w), self.k)):
            h += w[j:j + n] * self.weights[j]
        return np.unique(mixed(h))
