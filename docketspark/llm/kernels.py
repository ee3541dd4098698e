"""Vectorised hashing of words and character n-grams over the bytes of many texts at once.

All functions take one buffer of UTF-8 bytes and the offsets of its rows (see common.text_bytes)
and never look across a row's end.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

#: Byte tables: A-Z to a-z, and what counts as a byte of a word.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            made.append(np.cumprod(table))
        if n > 1 << 22:  # a single very long text: not kept
            return made[0], made[1]
        _powers = made[0], made[1]
    return _powers


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """len+1 polynomial prefix sums modulo 2**64, for range_hash."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power_tables(len(raw) + 1)[0][: len(raw)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes [start, end) of each range, the same wherever they stand."""
    return mix((sums[end] - sums[start]) * _power_tables(len(sums))[1][start] + _ODD * (end - start).astype(np.uint64))


def words(raw: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of `inside` bytes: (start, end, offsets of each row's first word; len(rows)+1)."""
    mask = np.zeros(len(raw) + 2, bool)
    mask[1:-1] = inside[raw]
    starts, ends = mask[1:-1] & ~mask[:-2], mask[1:-1] & ~mask[2:]
    edges = at[(at > 0) & (at < len(raw))]
    starts[edges] = mask[1:-1][edges]
    ends[edges - 1] = mask[1:-1][edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, at)


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each item, from the offsets of each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(word_hash: np.ndarray, n: int) -> np.ndarray:
    """The hash of n consecutive words at each position that has n words left in the buffer (rows not regarded)."""
    m = max(0, len(word_hash) - n + 1)
    total = np.zeros(m, np.uint64)
    for i in range(n):
        total = total * np.uint64(_BASE_INVERSE) + word_hash[i : i + m]
    return mix(total)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each row, empty rows 0."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def letter_grams(low: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-byte grams, n at most 8, that have no space inside, and the position each starts at.

    The byte before a word and the one after it count as the word's edge: grams may begin or end with one.
    """
    m = len(low) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = NOT_SPACE[low]
    edged = np.where(inside, low, np.uint8(32)).astype(np.uint64)
    code, ok = np.full(m, n, np.uint64), np.ones(m, bool)
    for i in range(n):
        code = (code << np.uint64(8)) | edged[i : i + m]
        if 0 < i < n - 1:
            ok &= inside[i : i + m]
    at = np.flatnonzero(ok)
    return (mix(code[at] * _ODD) >> np.uint64(64 - bits)).astype(np.int64), at
