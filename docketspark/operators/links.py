"""Near duplicates at low thresholds without their pairs: links counted, the nearest document, the group.

At a similarity of 0.85 a fifth of all pairs of short texts are near, so a list of pairs is the
square of the corpus whatever the join. Here fingerprints are packed in tiles, and a task compares
the fingerprints of a few tiles with those of others, 64 bits at a time. What leaves it is a row for
each document: how many it is linked with, the nearest of them, and an edge to the least document of
its group inside the task. No pair is ever a row; output and shuffle follow documents, not links.

The comparison itself is of all pairs of different texts, as the reference's is: its work is the
square of their number, spread over tasks of bounded memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketspark.operators.dedup import classes, members, most_distance
from docketspark.operators.graph import components
from docketspark.operators.tiles import TILE, Distances, lots, met, numbered, packed, pieces, tiles_for
from docketspark.plans.stored import partitions, written

_TILES = "part long, left_side boolean, same boolean, tile int, number array<long>, hi array<long>, lo array<long>"
_FOUND = "number long, links long, distance int, nearest long, root long"


class _Groups:
    """Union-find over the places of two tiles, whole rows at a time: the root of a group is its least place."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, places: np.ndarray) -> np.ndarray:
        found = self.parent[places]
        while True:
            up = self.parent[found]
            if np.array_equal(up, found):
                self.parent[places] = found
                return found
            found = up

    def join(self, some: np.ndarray, others: np.ndarray) -> None:
        """Makes one group of the groups of some[k] and others[k], for each k."""
        while len(some):
            some, others = self.roots(some), self.roots(others)
            apart = some != others
            some, others = some[apart], others[apart]
            np.minimum.at(self.parent, np.maximum(some, others), np.minimum(some, others))

    def join_near(self, near: np.ndarray, ours: np.ndarray, theirs: np.ndarray) -> bool:
        """Joins what is near: places of rows and of columns, by the groups known of them. False if all of it was one before.

        Each row is joined with the first column of another group, then each column with such a row, until none is left.
        """
        joined, axis = False, 1
        while True:
            if (ours == ours[0]).all():  # most often one group already: few columns are not of it
                some = np.flatnonzero(theirs != ours[0])
                near, theirs = near[:, some], theirs[some]
            near &= ours[:, None] != theirs
            apart = np.flatnonzero(near.any(axis=axis))
            if not len(apart):
                return joined
            if axis:
                self.join(ours[apart], theirs[near[apart].argmax(axis=1)])
            else:
                self.join(theirs[apart], ours[near[:, apart].argmax(axis=0)])
            ours, theirs = self.roots(ours), self.roots(theirs)
            joined, axis = True, 1 - axis


def _compared(one: tuple, two: tuple | None, most: int) -> Iterator[tuple]:
    """(numbers, links, distance, nearest, roots) of what has links in tile one against tile two, or against itself.

    Tiles are in order of their numbers, so the first of equally near fingerprints of a lot has the least number.
    """
    left, right = one, two or one
    n, m = len(left[0]), len(right[0])
    links = [np.zeros(n, np.int64), np.zeros(m, np.int64)]
    best = [np.full(n, most + 1, np.uint8), np.full(m, most, np.uint8)]
    nearest = [np.full(n, _NONE), np.full(m, _NONE)]
    # places in order of number, so that the root of a group is its least number whichever tile holds it
    order = np.argsort(np.concatenate([left[0], right[0]]) if two else left[0], kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    groups, distances = _Groups(len(order)), Distances(left, right)
    # what is known of each place's group: two that are one here are one, others may have become one since
    known = [place[:n].astype(np.int32), place[n if two else 0 :].astype(np.int32)]
    for rows, columns in lots(left, right, most):
        distance = distances.of(rows, columns).whole(0, len(rows), 0, len(columns))
        if two is None:
            own = np.flatnonzero(np.isin(rows, columns, assume_unique=True))
            distance[own, np.searchsorted(columns, rows[own])] = _FAR
        near = distance <= most
        links[0][rows] += np.bitwise_count(np.packbits(near, axis=1)).sum(axis=1, dtype=np.int64)
        least = distance.min(axis=1)
        closer = np.flatnonzero(least < best[0][rows])
        best[0][rows[closer]], nearest[0][rows[closer]] = least[closer], right[0][columns[distance[closer].argmin(axis=1)]]
        if two is not None:
            links[1][columns] += np.add.reduce(near.view(np.uint8), axis=0, dtype=np.uint8)
            least = distance.min(axis=0)
            closer = np.flatnonzero(least <= best[1][columns])
            found, at = left[0][rows[distance[:, closer].argmin(axis=0)]], columns[closer]
            # lots are not in the order of numbers
            least = least[closer]
            better = (least < best[1][at]) | (found < nearest[1][at])
            best[1][at[better]], nearest[1][at[better]] = least[better], found[better]
        if groups.join_near(near, known[0][rows], known[1][columns]):
            known[0][rows], known[1][columns] = groups.roots(known[0][rows]), groups.roots(known[1][columns])
    number = np.concatenate([left[0], right[0]])[order] if two else left[0][order]
    root = number[groups.roots(place)]
    for side, tile in enumerate((left, right) if two else (left,)):
        some = nearest[side] != _NONE
        yield tile[0][some], links[side][some], best[side][some], nearest[side][some], root[side * n : side * n + len(tile[0])][some]


#: Larger than any number of a fingerprint.
_NONE = (1 << 63) - 1
#: Farther than any two fingerprints are.
_FAR = 255


def _comparison(most: int):
    """Rows of _TILES sorted by part, the left tiles of a part first, to rows of _FOUND."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, left = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                number, hi, lo = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("number", "hi", "lo"))
                tile = (number, hi.view(np.uint64), lo.view(np.uint64))
                own, same = row.column("part")[0].as_py(), row.column("same")[0].as_py()
                if row.column("left_side")[0].as_py():
                    part, left = own, tile
                    found = _compared(tile, None, most) if same else ()
                else:
                    assert part == own, "a part's left tile comes first"
                    found = _compared(left, tile, most)
                for numbers, links, distance, nearest, root in found:
                    columns = [numbers, links, distance.astype(np.int32), nearest, root]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["number", "links", "distance", "nearest", "root"])

    return run


def link_summary(prints: DataFrame, threshold: float = 0.85, bits: int = 128, tile: int = TILE) -> DataFrame:
    """id, representative, copies, n_links, nearest, similarity, group_id of every document.

    copies: other documents of the same text; n_links: different texts at least that similar;
    nearest and similarity: the representative of the most similar of those, the smallest id among equals,
    null if there is none; group_id: the smallest representative reachable over links.
    Texts without a hash are one class, and an empty fingerprint is linked with nothing.
    """
    n, most = partitions(prints.sparkSession), most_distance(threshold, bits)
    prints = written(prints.select("id", "sha", "hi", "lo"), "fingerprints")  # read several times, computed once
    texts = numbered(classes(prints).select(F.col("representative").alias("id"), "members", "hi", "lo"))
    compared = texts.where(F.lit(most >= 0)).where("hi <> 0 or lo <> 0")
    tiles = tiles_for(compared.count(), tile, n)
    found = met(written(packed(compared, tiles), "tiles"), tiles).mapInArrow(_comparison(most), _FOUND)
    # a text has a row from each pair of tiles; its least root stands for its others from here on
    gathered = found.groupBy("number").agg(
        F.sum("links").alias("n_links"), F.min(F.struct("distance", "nearest")).alias("best"), F.min("root").alias("least"), F.collect_set("root").alias("roots")
    )
    summed = written(gathered, "compared")
    roots = components(summed.select(F.explode(F.array_union("roots", F.array("number"))).alias("a"), F.col("least").alias("b")))
    named = texts.select("number", F.col("id").alias("representative"), "members")
    near = texts.select(F.col("number").alias("near"), F.col("id").alias("nearest"))
    group = texts.select(F.col("number").alias("of"), F.col("id").alias("group_id"))
    linked = summed.select("number", "n_links", "best.distance", F.col("best.nearest").alias("near")).join(near, "near").drop("near")
    linked = linked.join(roots.select(F.col("node").alias("number"), F.col("root").alias("of")).join(group, "of").drop("of"), "number", "left")
    whole = named.join(linked, "number", "left").select(
        "representative", (F.col("members") - 1).alias("copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "nearest",
        (1 - F.col("distance").cast("double") / bits).alias("similarity"), F.coalesce("group_id", "representative").alias("group_id"),
    )
    copied = members(prints).select("id", "representative")
    single = whole.select(F.col("representative").alias("id"), "*")
    others = copied.where(F.col("id") != F.col("representative")).join(whole, "representative").select("id", *whole.columns)
    return single.unionByName(others)


def _closest(one: tuple, two: tuple, k: int, bits: int, best: np.ndarray, number: np.ndarray) -> None:
    """Puts what tile two has among the k nearest of each fingerprint of tile one into best (distances) and number, by distance, then number.

    From a piece only what is as near as the k-th so far is ordered.
    """
    left, right, distances = one, two, Distances(one, two)
    empty, bare = (right[1] == 0) & (right[2] == 0), (left[1] == 0) & (left[2] == 0)
    odd = empty.any() or bare.any()
    at = np.minimum(np.searchsorted(right[0], left[0]), len(right[0]) - 1)
    own = np.where(right[0][at] == left[0], at, -1)
    for i, j, a, b in pieces(len(left[0]), len(right[0])):
        distance = distances.whole(i, j, a, b)
        if odd:  # an empty fingerprint is like no other
            distance[bare[i:j, None] != empty[None, a:b]] = bits
        itself = np.flatnonzero((own[i:j] >= a) & (own[i:j] < b))
        distance[itself, own[i + itself] - a] = _FAR
        worst = np.minimum(best[i:j, -1], bits).astype(np.uint8)
        if (best[i:j, -1] == _SELF).any():  # not yet k: no more than the k-th of the piece itself can be among them
            some = min(k, b - a) - 1
            worst = np.minimum(worst, np.partition(distance, some, axis=1)[:, some])
            worst[best[i:j, -1] == _SELF] = bits if b - a < k else worst[best[i:j, -1] == _SELF]
        row, column = np.nonzero(distance <= worst[:, None])
        if not len(row):
            continue
        rows = np.unique(row)
        place = np.concatenate([np.repeat(rows, k), row])
        far = np.concatenate([best[i + rows].ravel(), distance[row, column].astype(np.int64)])
        of = np.concatenate([number[i + rows].ravel(), right[0][a + column]])
        order = np.lexsort((of, far, place))
        place = place[order]
        first = np.searchsorted(place, rows)
        chosen = order[(first[:, None] + np.arange(k)).ravel()]
        best[i + rows], number[i + rows] = far[chosen].reshape(-1, k), of[chosen].reshape(-1, k)


#: Stands for the distance of a fingerprint to itself, and for a place that nothing has taken.
_SELF = 1 << 20


def _nearest(k: int, bits: int):
    """Rows of _TILES sorted by part, its queries first, to (number, near, distance): the k nearest of each query in a part."""

    def emitted(queries: tuple, best: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(best), 4096):
            some = best[i : i + 4096] < _SELF
            own = np.repeat(queries[0][i : i + 4096], some.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(number[i : i + 4096][some]), pa.array(best[i : i + 4096][some].astype(np.int32))], ["number", "near", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best, number = None, None, None
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                own, hi, lo = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("number", "hi", "lo"))
                tile = (own, hi.view(np.uint64), lo.view(np.uint64))
                if row.column("left_side")[0].as_py():
                    if queries:
                        yield from emitted(queries, best, number)
                    queries = tile
                    best, number = np.full((len(own), k), _SELF), np.full((len(own), k), (1 << 63) - 1)
                else:
                    _closest(queries, tile, k, bits, best, number)
        if queries:
            yield from emitted(queries, best, number)

    return run


def most_similar(prints: DataFrame, asked: str, k: int = 10, bits: int = 128, tile: int = TILE) -> DataFrame:
    """query, id, rank, similarity: the k documents most like each document for which `asked` holds, exactly, ties by id.

    prints (id, hi, lo) are stored fingerprints, none is computed again. Each tile of queries meets every
    tile of documents, dealt to a few tasks for each core; a task gives on k rows for each of its queries.
    """
    n = partitions(prints.sparkSession)
    rows = numbered(prints.select("id", "hi", "lo"))
    chosen = rows.where(asked)
    many, few = rows.count(), chosen.count()
    tiles = max(math.ceil(many / tile), min(4 * n, math.ceil(many / 64)), 1)
    lots = max(math.ceil(few / tile), 1)
    runs = max(1, min(tiles, math.ceil(4 * prints.sparkSession.sparkContext.defaultParallelism / lots)))
    rights = written(packed(rows, tiles), "tiles").select("*", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"))
    lefts = packed(chosen, lots).select("*", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    part = lambda lot, run: F.col(lot).cast("long") * runs + run
    shape = ("tile", "number", "hi", "lo")
    lefts = lefts.select(part("tile", F.col("run")).alias("part"), F.lit(True).alias("left_side"), *shape)
    rights = rights.select(part("lot", F.col("tile") % runs).alias("part"), F.lit(False).alias("left_side"), *shape)
    dealt = lefts.unionByName(rights).repartition(max(n, min(8 * n, lots * runs)), "part").sortWithinPartitions("part", F.desc("left_side"), "tile")
    found = dealt.where(F.lit(few > 0)).mapInArrow(_nearest(k, bits), "number long, near long, distance int")
    order = Window.partitionBy("number").orderBy("distance", "near")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = rows.select(F.col("number").alias("near"), "id")
    queries = chosen.select("number", F.col("id").alias("query"))
    return top.join(queries, "number").join(names, "near").select("query", "id", "rank", (1 - F.col("distance").cast("double") / bits).alias("similarity"))
