"""SimHash over character n-grams, and its comparison, for document deduplication."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docketspark.functions.regexes import unicode_pattern


def normalised(text: Column) -> Column:
    """Lower case, runs of whitespace to one space, then everything but word characters and spaces away, then trimmed."""
    one = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), F.lit(unicode_pattern(r"\s+")), F.lit(" "))
    return F.trim(F.regexp_replace(one, F.lit(unicode_pattern(r"[^\w\s]")), F.lit("")))


def checked(bits: int, ngram: int) -> None:
    if bits not in (64, 128):
        raise ValueError(f"bits must be 64 or 128, not {bits}")
    if ngram < 1:
        raise ValueError(f"ngram must be positive, not {ngram}")


#: The signs with which each of the 256 values of a hash byte votes on its 8 bits.
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1
#: Code points that are worked on at a time; a longer text is a piece of its own.
_PIECE = 1 << 19


def _grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row of each n-gram, its number among the distinct ones, the distinct ones); a shorter text is one gram, an empty one has none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    count = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    row = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count - (np.cumsum(sizes) - sizes), count)
    length = np.minimum(sizes, n)[row]
    code = np.zeros(len(row), np.int64)
    for k in range(n):  # code points as digits of 21 bits; after every third, a number of what is before stands for it
        if k > 2:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        digit = np.where(k < length, points[np.minimum(start + k, len(points) - 1)].astype(np.int64) + 1, 0)
        code = (code << 21) | digit
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    whole = "".join(texts)
    return row, number, [whole[start[i] : start[i] + length[i]] for i in first.tolist()]


def _prints(texts: list[str], n: int) -> np.ndarray:
    """(rows, 16) bytes: each text's votes; every distinct n-gram of the piece is hashed once."""
    rows = len(texts)
    row, number, grams = _grams(texts, n)
    if not grams:
        return np.zeros((rows, 16), np.uint8)
    hashed = np.frombuffer(b"".join([hashlib.md5(g.encode("utf-8", "surrogatepass")).digest() for g in grams]), np.uint8).reshape(-1, 16)
    # an n-gram's occurrences in a text vote together
    cell, times = np.unique(row * len(grams) + number, return_counts=True)
    at, number = (cell // len(grams)) << 8, cell % len(grams)
    votes = np.empty((rows, 128))
    for k in range(16):
        votes[:, 8 * k : 8 * k + 8] = np.bincount(at | hashed[number, k], times, minlength=rows << 8).reshape(rows, 256) @ _SIGNS
    return np.packbits(votes > 0, axis=1)


def simhash(text: Column, bits: int = 128, ngram: int = 3, normalise: bool = True) -> Column:
    """struct<hi bigint, lo bigint>: a bit is set where the n-grams' MD5 bits vote above zero; hi is 0 for 64 bits.

    Votes need the bits of every n-gram, which no built-in aggregate gives without 128 sums over an
    exploded table; an Arrow UDF that counts the n-grams of many texts at once is several times faster.
    """
    checked(bits, ngram)

    @F.pandas_udf("hi long, lo long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            texts, out, i = [t or "" for t in series], [np.zeros((0, 16), np.uint8)], 0
            total = np.cumsum([len(t) for t in texts])
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + _PIECE, "right")))
                out.append(_prints(texts[i:j], ngram))
                i = j
            halves = np.concatenate(out).view(">i8").astype(np.int64)
            yield pd.DataFrame({"hi": halves[:, 0] if bits == 128 else 0 * halves[:, 0], "lo": halves[:, 1]})

    return run(normalised(text) if normalise else F.coalesce(text, F.lit("")))


def distance(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column) -> Column:
    return F.bit_count(a_hi.bitwiseXOR(b_hi)) + F.bit_count(a_lo.bitwiseXOR(b_lo))


def similarity(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column, bits: int = 128) -> Column:
    """1 - distance / bits; an empty fingerprint is like another empty one and unlike any other."""
    empty = [(hi == 0) & (lo == 0) for hi, lo in ((a_hi, a_lo), (b_hi, b_lo))]
    close = 1 - distance(a_hi, a_lo, b_hi, b_lo).cast("double") / bits
    return F.when(empty[0] & empty[1], 1.0).when(empty[0] | empty[1], 0.0).otherwise(close)


def hexadecimal(hi: Column, lo: Column, bits: int = 128) -> Column:
    parts = [F.lpad(F.lower(F.hex(x)), 16, "0") for x in ((hi, lo) if bits == 128 else (lo,))]
    return reduce(F.concat, parts)


def exact_hash(text: Column) -> Column:
    """SHA-256 of the text as it is; null for null and empty texts."""
    return F.when(F.length(text) > 0, F.sha2(text, 256))
