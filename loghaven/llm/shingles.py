"""Word shingles of whole texts as sorted numbers, vectorised per text."""

from __future__ import annotations

import numpy as np

#: Letters A-Z in lower case, all other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of the words of texts. Powers are kept for the longest text seen."""

    def __init__(self):
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.power, self.inverse = (np.cumprod(np.full(n, b, np.uint64)) for b in (_BASE, _UNBASE))

    def words(self, text: str | None) -> np.ndarray:
        """Hashes of the words in order, A-Z in lower case."""
        if not text:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(LOWER), np.uint8)
        if len(data) > len(self.power):
            self._grow(2 * len(data))
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_SPACE[data]
        step = np.diff(inside)
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=sums[1:])
        return mixed((sums[end] - sums[start]) * self.inverse[start])


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words; of fewer words, the whole text as one."""
    if not len(words):
        return words
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = mixed(total * np.uint64(_BASE) + words[i : len(words) - n + 1 + i])
    return np.unique(total)
