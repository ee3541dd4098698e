"""Fingerprints in tiles: packed, dealt so that each pair of tiles meets once, and compared 64 bits at a time."""

from __future__ import annotations

import math
from collections.abc import Iterator
from copy import copy

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.plans.stored import partitions, written

#: Fingerprints of a tile at most, on average: what is shuffled grows with the number of tiles, which a task compares by pieces.
TILE = 1 << 16
#: Pairs compared at a time: rows and columns of a piece of two tiles. Counts of a piece's rows fit in a byte.
ROWS, COLUMNS = 1 << 6, 1 << 12
#: Fingerprints of a tile whose distances to all others say which of them are too far apart to be compared.
PIVOTS = 16


def numbered(rows: DataFrame) -> DataFrame:
    """rows with `number`, in the order of ids: of two ids the smaller has the smaller number. Written, so that numbers stay."""
    ordered = rows.repartitionByRange(partitions(rows.sparkSession), "id").sortWithinPartitions("id")
    return written(ordered.withColumn("number", F.monotonically_increasing_id()), "prints")


def packed(rows: DataFrame, tiles: int, *more: str) -> DataFrame:
    """tile, number, hi, lo and more: the fingerprints of each tile as arrays in the order of their numbers; dealt by hash, so tiles are alike in size."""
    names = ("number", "hi", "lo", *more)
    dealt = rows.select(F.pmod(F.xxhash64("number"), F.lit(tiles)).cast("int").alias("tile"), F.struct(*names).alias("f"))
    return dealt.groupBy("tile").agg(F.array_sort(F.collect_list("f")).alias("t")).select("tile", *[f"t.{c}" for c in names])


def tiles_for(many: int, tile: int, n: int) -> int:
    """Tiles enough for every core even where texts are few; one key never holds more than its tile."""
    return max(math.ceil(many / tile), min(math.isqrt(4 * n) + 1, math.ceil(many / 64)), 1)


def met(tiled: DataFrame, tiles: int, *more: str) -> DataFrame:
    """part, left_side, same, tile, number, hi, lo and more: partitions sorted by part, each a left tile and then a run of right tiles.

    A pair of tiles is met once, the lower tile on the left; `same` says that the left one meets itself.
    """
    n, names = partitions(tiled.sparkSession), ("tile", "number", "hi", "lo", *more)
    run = max(1, math.ceil(tiles * (tiles + 1) / 2 / max(8 * n, tiles)))
    runs = math.ceil(tiles / run)
    part = lambda left, k: (left.cast("long") * runs + k).alias("part")
    own = (F.col("tile") / run).cast("int")
    lefts = tiled.select("*", F.explode(F.sequence(own, F.lit(runs - 1))).alias("k"))
    lefts = lefts.select(part(F.col("tile"), F.col("k")), F.lit(True).alias("left_side"), (F.col("k") == own).alias("same"), *names)
    rights = tiled.where("tile > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("tile") - 1)).alias("other"))
    rights = rights.select(part(F.col("other"), own), F.lit(False).alias("left_side"), F.lit(False).alias("same"), *names)
    return lefts.unionByName(rights).repartition(max(n, min(8 * n, tiles * runs)), "part").sortWithinPartitions("part", F.desc("left_side"), "tile")


def pieces(n: int, m: int) -> Iterator[tuple[int, int, int, int]]:
    """(i, j, a, b): rows i to j and columns a to b of n x m pairs, piece by piece, those of the same rows one after the other."""
    for i in range(0, n, ROWS):
        for a in range(0, m, COLUMNS):
            yield i, min(n, i + ROWS), a, min(m, a + COLUMNS)


def lots(left: tuple, right: tuple, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns): places of left and of right, ascending, a piece at a time; each pair at most that far apart is in one of them, once.

    Rows that are alike are a lot, by the nearest of a few pivots and its distance. A column whose distance to a
    pivot differs by more than `most` from those of the lot is farther than that from all of it (triangle
    inequality) and is left out. The lots come one after the other, the columns of a lot in ascending order.
    """
    n, m = len(left[0]), len(right[0])
    pivots = tuple(x[:: max(1, math.ceil(n / PIVOTS))] for x in left)
    rows_far, columns_far = (_to_pivots(side, pivots) for side in (left, right))
    order = np.lexsort((rows_far.min(axis=0), rows_far.argmin(axis=0)))
    possible, inside, shifted = np.empty(m, bool), np.empty(m, bool), np.empty(m, np.uint8)
    for i in range(0, n, ROWS):
        rows = np.sort(order[i : i + ROWS])
        far = rows_far[:, rows].astype(np.int64)
        low = np.maximum(far.min(axis=1) - most, 0)
        width = far.max(axis=1) + most - low
        possible[:] = True
        for k, away in enumerate(columns_far):  # low <= away <= low + width: as unsigned bytes, one comparison
            if width[k] < _BITS:
                np.subtract(away, np.uint8(low[k]), out=shifted)
                possible &= np.less_equal(shifted, np.uint8(width[k]), out=inside)
        columns = np.flatnonzero(possible)
        for a in range(0, len(columns), COLUMNS):
            yield rows, columns[a : a + COLUMNS]


#: Bits of a fingerprint at most.
_BITS = 128


def _to_pivots(side: tuple, pivots: tuple) -> np.ndarray:
    """The distances of a tile's fingerprints to each pivot, a row a pivot."""
    return np.stack([np.bitwise_count(side[1] ^ hi) + np.bitwise_count(side[2] ^ lo) for hi, lo in zip(pivots[1], pivots[2], strict=True)])


class Distances:
    """Hamming distances of the pieces of two tiles (number, hi, lo), as bytes in an array that the next piece overwrites."""

    def __init__(self, left: tuple, right: tuple):
        self.left, self.right = left, right
        size = min(ROWS, len(left[0])) * min(COLUMNS, len(right[0]))
        self._word, self._hi, self._lo = np.empty(size, np.uint64), np.empty(size, np.uint8), np.empty(size, np.uint8)

    def of(self, rows: np.ndarray, columns: np.ndarray) -> Distances:
        """The distances of these places only, in the same arrays; see `lots`."""
        some = copy(self)
        some.left, some.right = ((None, side[1][at], side[2][at]) for side, at in ((self.left, rows), (self.right, columns)))
        return some

    def _half(self, word: int, i: int, j: int, a: int, b: int, out: np.ndarray) -> np.ndarray:
        shape, size = (j - i, b - a), (j - i) * (b - a)
        differ, found = self._word[:size].reshape(shape), out[:size].reshape(shape)
        np.bitwise_xor(self.left[word][i:j, None], self.right[word][None, a:b], out=differ)
        return np.bitwise_count(differ, out=found)

    def whole(self, i: int, j: int, a: int, b: int) -> np.ndarray:
        found = self._half(1, i, j, a, b, self._hi)
        return np.add(found, self._half(2, i, j, a, b, self._lo), out=found)

    def within(self, most: int, i: int, j: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, distance) of the pairs at most that far apart; low halves are compared where few high ones are left."""
        found = self._half(1, i, j, a, b, self._hi)
        near = found <= most
        whole = 16 * np.count_nonzero(near) > found.size
        if whole:
            np.add(found, self._half(2, i, j, a, b, self._lo), out=found)
            np.less_equal(found, most, out=near)
        cell, starts = np.flatnonzero(near), np.arange(j - i + 1) * (b - a)
        row = np.repeat(np.arange(j - i), np.diff(np.searchsorted(cell, starts)))
        column, distance = a + cell - starts[row], found.ravel()[cell]
        row += i
        if whole:
            return row, column, distance
        distance += np.bitwise_count(self.left[2][row] ^ self.right[2][column])
        near = distance <= most
        return row[near], column[near], distance[near]
