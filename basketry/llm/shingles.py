"""Word shingles of whole texts as sorted arrays of 64-bit hashes, in numpy."""

import numpy as np

from basketry.llm.common import mix

_RANDOM = np.random.default_rng(20240229)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
# An odd base has an inverse modulo 2**64, so the hash of a word follows from prefix sums.
_BASE = int(_RANDOM.integers(1, 1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Shingler:
    """Shingles of ``size`` words; words are split at ASCII blanks, A-Z are lower-cased."""

    def __init__(self, size: int):
        self.size = size
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)

    def words(self, text: bytes | None) -> np.ndarray:
        """One hash per word, in order."""
        raw = np.frombuffer((text or b"").lower(), np.uint8)
        if raw.size + 1 > self.up.size:
            self._grow(2 * raw.size)
        inside = np.concatenate(([False], ~_BLANK[raw], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(raw.size + 1, np.uint64)
        np.cumsum(_BYTES[raw] * self.up[:raw.size], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def shingles(self, text: bytes | None) -> np.ndarray:
        """The distinct shingles, sorted; a text of fewer words is one shingle, one without
        words has none."""
        words = self.words(text)
        if not words.size:
            return words
        n = max(1, words.size - self.size + 1)
        width = min(self.size, words.size)
        rolled = words[:n].copy()
        for k in range(1, width):
            rolled = mix(rolled) + words[k:k + n]
        return np.unique(mix(rolled + np.uint64(width)))
