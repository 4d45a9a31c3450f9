"""Words of whole batches of UTF-8 texts as numpy arrays.

A word is a run of the bytes 0-9, a-z and 0x80 on, after A-Z are lower-cased: exactly the matches of
[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ on the text, as every other character has multi-byte codes from 0x80 on.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lodeplane.llm.common import utf8

MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE = np.uint64(0xD1342543DE82EF95)
_LOWER = np.zeros(256, np.uint8)
_LOWER[48:58] = np.arange(48, 58)
_LOWER[65:91] = _LOWER[97:123] = np.arange(97, 123)
_LOWER[128:] = np.arange(128, 256)
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64))
#: Bytes whose hashes are worked out at once.
CHUNK = 1 << 18


@functools.cache
def _first_powers(base: int) -> np.ndarray:
    return _run_of_powers(base, CHUNK)


def _run_of_powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64; the first CHUNK are remembered."""
    return _first_powers(base)[:n] if n <= CHUNK else _run_of_powers(base, n)


@dataclass
class Words:
    """Words of a batch in order: byte span, hash and row; `first` has the n+1 numbers of the rows' first words."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    first: np.ndarray
    offsets: np.ndarray  # bytes where the rows begin

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, a: int, b: int) -> bytes:
        """Words a to b - 1, lower-cased, joined by a blank."""
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), strict=True))


def words(column: pa.Array) -> Words:
    return words_of(*utf8(column))


def words_of(raw: np.ndarray, offsets: np.ndarray) -> Words:
    low = _LOWER[raw]
    inside, n = low != 0, len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(low, z, z, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), offsets)
    edges = offsets[(offsets > 0) & (offsets < n)]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edges] = after[edges - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(low, start, end, hashes_of(low, start, end), np.searchsorted(start, offsets), offsets)


def hashes_of(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: differences of the sums of a polynomial, brought to a common power; in chunks of bounded size."""
    out, i = np.empty(len(start), np.uint64), 0
    with np.errstate(over="ignore"):
        while i < len(start):
            lo = int(start[i])
            j = int(np.searchsorted(end, lo + CHUNK, "right"))
            if j <= i:
                out[i], i = long_sum(raw[lo : int(end[i])]), i + 1
                continue
            part = raw[lo : int(end[j - 1])]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_VALUE[part] * powers(_BASE, len(part)), out=sums[1:])
            a, b = start[i:j] - lo, end[i:j] - lo
            out[i:j] = (sums[b] - sums[a]) * powers(_INVERSE, CHUNK)[a]
            i = j
        return mixed(out + (end - start).astype(np.uint64))


def long_sum(raw: np.ndarray) -> int:
    """The polynomial's sum over one span longer than a chunk."""
    total = 0
    for at in range(0, len(raw), CHUNK):
        part = raw[at : at + CHUNK]
        own = int((_VALUE[part] * powers(_BASE, len(part))).sum(dtype=np.uint64))
        total = (total + own * pow(_BASE, at, 1 << 64)) & MASK
    return total


def shingles(key: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n keys that start at each place; shorter than key by n - 1. Order counts."""
    m = len(key) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = key[:m].copy()
        for i in range(1, n):
            total = total * _SHINGLE + key[i : i + m]
    return mixed(total + np.uint64(n))


def in_sorted(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value its place in the sorted keys, and whether it's there."""
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


class Filter:
    """A first, cheap test for membership in a fixed set of 64-bit hashes: one look-up in a bit table by 22 bits of the hash."""

    def __init__(self, keys: np.ndarray, bits: int = 22) -> None:
        self.shift, self.table = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        self.table[keys >> self.shift] = True

    def maybe(self, values: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.table[values >> self.shift])
