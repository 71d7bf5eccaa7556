"""Vectorised hashes of byte ranges, words and word sequences, with arithmetic modulo 2**64.

Each step mixes what went before with the next part, so unequal sequences share a hash by chance only (one pair in
2**64), however regular they are.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
FACTOR = U64(0x9E3779B97F4A7C15)
CHUNK = 4 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash of two in this order. No step is linear over a whole sequence, so regular sequences hash like any others."""
    return mix(left * FACTOR + right)


def windows(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of every range of ``length`` values, by start: of halves of halves, and of what is left of the length."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    level, size, done, out = mix(values.astype(U64) + U64(1)), 1, 0, np.full(n, U64(length))
    while True:
        if length & size:
            out = joined(out, level[done : done + n])
            done += size
        if 2 * size > length:
            return out
        level, size = joined(level[:-size], level[size:]), 2 * size


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range of bytes, eight bytes a step."""
    whole = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", whole.data, strides=(1,))
    length = end - start
    out = mix(length.astype(U64) + FACTOR)
    open_ = np.flatnonzero(length > 0)
    at = 0
    while len(open_):
        left = length[open_] - at
        word = words[start[open_] + at] & (~U64(0) >> (U64(8) * (U64(8) - np.minimum(left, 8).astype(U64))))
        out[open_] = joined(out[open_], word)
        open_, at = open_[left > 8], at + 8
    return out


class Words:
    """Words of the rows of a block: runs of bytes other than space and 0x09 to 0x0D; none crosses a row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR):
        inside = ~separator[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.empty(len(data), bool)
        before[:1], before[1:] = False, inside[:-1]
        self.start = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.empty(len(data), bool)
        after[-1:], after[:-1] = False, inside[1:]
        self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.bounds = np.searchsorted(self.start, offsets)  # the words of row i are bounds[i] to bounds[i + 1]
        self.data = data

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return range_hashes(self.data, self.start, self.end)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in [s, s + length) for a start s."""
    steps = np.zeros(n + length + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:n]) > 0
