"""Hashes of words and of stretches of a byte string, for whole texts at once in numpy.

A stretch hashes to ``sum(value[byte] * BASE**(place - start))`` modulo 2**64, taken from
prefix sums, so any number of stretches costs one pass over the text. All constants come
from a seeded generator.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_random = np.random.default_rng(20)
VALUES = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | U64(1)
BASE = [int(b) | 1 for b in _random.integers(1 << 40, 1 << 63, 2)]
INVERSE = [pow(b, -1, 1 << 64) for b in BASE]
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), kept for the next text."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits."""
    x = x ^ x >> U64(30)
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Stretches:
    """Hashes of stretches of one sequence: bytes, or words given by their own hashes."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.which, n = which, len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power(BASE[which], n), out=self.sums[1:])

    @staticmethod
    def of_bytes(text: bytes, which: int = 0) -> Stretches:
        return Stretches(VALUES[which][np.frombuffer(text, np.uint8)], which)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _power(INVERSE[self.which], len(self.sums))[start])


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = ~WHITE[np.frombuffer(text, np.uint8)]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(text: bytes) -> np.ndarray:
    start, end = word_bounds(text)
    return Stretches.of_bytes(text).hash(start, end)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    width = min(width, len(words))
    return Stretches(words, 1).hash(np.arange(len(words) - width + 1), np.arange(width, len(words) + 1))
