"""A minimal perfect hash over 128-bit keys: a cascade of bit arrays, built and read in numpy.

On each level every key that is left falls on one bit; keys alone on their bit are settled
there, the others go on to the next level. The rank of a key's bit among all set bits is its
slot, so ``n`` keys use the slots ``0 .. n - 1`` and about three bits each.
"""

import math

import numpy as np

from basketry.llm.common import GOLDEN, MASK64, mix

BITS_PER_KEY = 2.0


def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64(level * int(GOLDEN) & MASK64)
    return mix(a ^ mix(b + step)) % np.uint64(size)


def build(a: np.ndarray, b: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and all bits of the hash over the distinct keys (a, b), two uint64 arrays."""
    sizes, bits, left = [], [], np.arange(a.size)
    while left.size:
        size = max(64, math.ceil(BITS_PER_KEY * left.size))
        places = _places(a[left], b[left], len(sizes), size).astype(np.int64)
        held = np.bincount(places, minlength=size)
        sizes.append(size)
        bits.append(held == 1)
        left = left[held[places] != 1]
        if len(sizes) > 200:
            raise ValueError("keys of a perfect hash must be distinct")
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(a: np.ndarray, b: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of every key; keys that were not built in get -1 or another key's slot."""
    found, left, start = np.full(a.size, -1, np.int64), np.arange(a.size), 0
    rank = np.cumsum(bits) - 1
    for level, size in enumerate(sizes):
        at = start + _places(a[left], b[left], level, size).astype(np.int64)
        hit = bits[at]
        found[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
        if not left.size:
            break
    return found
