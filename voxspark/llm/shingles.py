"""Word shingles of a text as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from voxspark.llm.common import Memo

_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Distinct ``width``-word shingles; words as split at ASCII blanks, A-Z in lower case.

    A shorter text is one shingle, its whole word sequence; a text without words
    has none. Word hashes are combined with odd random factors, so that unequal
    shingles of a corpus meet with a chance of about 2**-64 a pair.
    """

    def __init__(self, width: int = 5, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.width = width
        self.factors = rng.integers(0, 1 << 63, width + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.words = Memo(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        n = len(words)
        if not n:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        k = min(n, self.width)
        h = np.full(n - k + 1, np.uint64(int(self.factors[-1]) * k % (1 << 64)), np.uint64)
        for j in range(k):
            h += w[j : n - k + 1 + j] * self.factors[j]
        return np.unique(mixed(h))
