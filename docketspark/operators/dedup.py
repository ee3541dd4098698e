"""Exact and near duplicates of documents by hash and SimHash.

Copies of one text are one class with the smallest id as its representative, so no group of copies
is expanded into its pairs; near pairs are those between representatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions import fingerprint as fp
from docketspark.operators.tiles import TILE, Distances, lots, met, numbered, packed, tiles_for
from docketspark.plans.stored import partitions, written

EXACT, NEAR = "exact_hash", "simhash"


def fingerprints(
    cases: DataFrame, bits: int = 128, ngram: int = 3, normalise: bool = True, id_: str = "id", text: str = "text", order: str | None = None
) -> DataFrame:
    """id, sha, hi, lo of every row with an id; a null text has the empty fingerprint.

    With `order`, the row of an id that is last by this column takes the place of its others (ties: by hash).
    """
    own = F.col(id_).cast("string")
    place = F.col(order) if order else F.lit(None)
    rows = cases.select(own.alias("id"), F.col(text).alias("_t"), place.alias("_o")).where(F.coalesce("id", F.lit("")) != "")
    marked = rows.select("id", fp.exact_hash(F.col("_t")).alias("sha"), fp.simhash(F.col("_t"), bits, ngram, normalise).alias("f"), "_o")
    prints = marked.select("id", "sha", "f.hi", "f.lo", "_o")
    return upserted(prints, "_o") if order else prints.drop("_o")


def upserted(prints: DataFrame, order: str | None = None) -> DataFrame:
    """id, sha, hi, lo: one row for each id, the last by `order`, then by hash; fingerprints alone are shuffled, and aggregated before."""
    place = F.struct(*([order] if order else []), "sha", "hi", "lo")
    last = prints.groupBy("id").agg(F.max_by(F.struct("sha", "hi", "lo"), place).alias("r"))
    return last.select("id", "r.sha", "r.hi", "r.lo")


def classes(prints: DataFrame) -> DataFrame:
    """sha, representative, members, hi, lo: one row for each distinct text; texts without a hash are one class."""
    grouped = prints.groupBy("sha").agg(F.min("id").alias("representative"), F.count(F.lit(1)).alias("members"), F.first("hi").alias("hi"), F.first("lo").alias("lo"))
    return grouped.select("sha", "representative", "members", "hi", "lo")


def members(prints: DataFrame, id_classes: DataFrame | None = None) -> DataFrame:
    """id, representative, method for every document that has copies."""
    known = (id_classes or classes(prints)).where("members > 1").select(F.col("sha").alias("s"), "representative")
    joined = prints.join(known, F.col("sha").eqNullSafe(F.col("s")))
    return joined.select("id", "representative", F.when(F.col("sha").isNull(), NEAR).otherwise(EXACT).alias("method"))


def most_distance(threshold: float, bits: int) -> int:
    """The largest Hamming distance d with 1 - d / bits >= threshold."""
    return max(d for d in range(bits + 1) if 1 - d / bits >= threshold) if threshold <= 1 else -1


_PAIRS = "firsts array<string>, seconds array<string>, pairs array<int>"
#: Pairs that leave a task at a time, in lists, a piece more at most; the bits that each place of a pair takes in its number, of 32.
_AT_ONCE, _PLACE = 1 << 17, 12


def _near(most: int):
    """Parts of tiles (see `tiles.met`), with ids, to the pairs at most that far apart: the ids of a piece's rows and columns, and a number for each pair.

    A number holds the distance and the places of the smaller and of the larger id in the two lists, so that
    an id leaves the task twice for a piece at most, not once for each pair.
    """

    def lists(kind: pa.DataType, parts: list) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(x) for x in parts]), pa.int32()), pa.concat_arrays(parts).cast(kind))

    def batch_of(held: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int32())
        return pa.RecordBatch.from_arrays([lists(kind, parts) for kind, parts in zip(kinds, zip(*held, strict=True), strict=True)], ["firsts", "seconds", "pairs"])

    def numbers(distance: np.ndarray, first: np.ndarray, second: np.ndarray) -> pa.Array:
        return pa.array(((distance.astype(np.uint32) << 2 * _PLACE) | (first << _PLACE).astype(np.uint32) | second.astype(np.uint32)).view(np.int32))

    def compared(left: tuple, right: tuple, same: bool) -> Iterator[pa.RecordBatch]:
        distances, held, many = Distances(left, right), [], 0
        for rows, columns in lots(left, right, most):
            x, y, distance = distances.of(rows, columns).within(most, 0, len(rows), 0, len(columns))
            in_order = left[0][rows][x] < right[0][columns][y]  # numbers are in the order of ids
            used = np.zeros(len(columns), bool)
            used[y] = True
            y, theirs, ours = (np.cumsum(used) - 1)[y], right[3].take(pa.array(columns[used])), left[3].take(pa.array(rows))
            if in_order.any():
                held.append((ours, theirs, numbers(distance[in_order], x[in_order], y[in_order])))
            if not same and not in_order.all():  # the square of a tile has each pair in both orders
                turned = ~in_order
                held.append((theirs, ours, numbers(distance[turned], y[turned], x[turned])))
            many += len(x)
            if many >= _AT_ONCE and held:
                yield batch_of(held)
                held, many = [], 0
        if held:
            yield batch_of(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            for row in (batch.slice(k, 1) for k in range(batch.num_rows)):
                number, hi, lo = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("number", "hi", "lo"))
                right = (number, hi.view(np.uint64), lo.view(np.uint64), row.column("id").flatten())
                same = row.column("same")[0].as_py()
                if row.column("left_side")[0].as_py():
                    left = right
                if same or left is not right:
                    yield from compared(left, right, same)

    return run


def near_pairs(prints: DataFrame, threshold: float = 0.85, bits: int = 128, tile: int = TILE) -> DataFrame:
    """id_a, id_b, similarity, method of representatives at least that similar, id_a < id_b; exact at every threshold.

    Fingerprints of natural texts agree on most of their bits, so bands of them single out little: all
    fingerprints are compared, 64 bits at a time, in tiles that meet once, but for those that a few
    distances to pivots show to be too far apart (`tiles.lots`). Work is the square of the number of
    different texts, in tasks of bounded memory; a pair is a row once, and candidates are none.
    """
    n, most = partitions(prints.sparkSession), most_distance(threshold, bits)
    # empty fingerprints are one class already, and unlike any other
    rows = classes(prints).where("hi <> 0 or lo <> 0").select(F.col("representative").alias("id"), "hi", "lo")
    texts = numbered(rows if most >= 0 else rows.limit(0))
    tiles = tiles_for(texts.count(), tile, n)
    near = met(written(packed(texts, tiles, "id"), "tiles"), tiles, "id").mapInArrow(_near(most), _PAIRS)
    pairs = near.select("firsts", "seconds", F.explode("pairs").alias("pair"))
    place = lambda low: F.shiftright("pair", low).bitwiseAND((1 << _PLACE) - 1)
    like = 1 - F.shiftrightunsigned("pair", 2 * _PLACE).cast("double") / bits
    return pairs.select(F.get("firsts", place(_PLACE)).alias("id_a"), F.get("seconds", place(0)).alias("id_b"), like.alias("similarity"), F.lit(NEAR).alias("method"))


def find_duplicates(cases: DataFrame, threshold: float = 0.85, bits: int = 128, ngram: int = 3, id_: str = "id", text: str = "text") -> DataFrame:
    """id_a, id_b, similarity, method: near pairs of representatives, and each copy with its representative; a repeated id is one document."""
    prints = written(upserted(fingerprints(cases, bits, ngram, id_=id_, text=text)), "fingerprints")  # read several times, computed once
    copies = members(prints).where(F.col("id") != F.col("representative"))
    exact = copies.select(F.col("representative").alias("id_a"), F.col("id").alias("id_b"), F.lit(1.0).alias("similarity"), "method")
    return exact.unionByName(near_pairs(prints, threshold, bits))


def find_similar(prints: DataFrame, id_: str, k: int = 10, bits: int = 128) -> DataFrame:
    """id, similarity, method of the k documents most like the one with this id; KeyError without it."""
    own = prints.where(F.col("id") == id_).select("hi", "lo").first()
    if own is None:
        raise KeyError(id_)
    like = fp.similarity(F.col("hi"), F.col("lo"), F.lit(own.hi), F.lit(own.lo), bits)
    others = prints.where(F.col("id") != id_).select("id", like.alias("similarity"), F.lit(NEAR).alias("method"))
    return others.orderBy(F.desc("similarity"), "id").limit(k)


def dedup_stats(prints: DataFrame, threshold: float = 0.85, bits: int = 128) -> DataFrame:
    """One row: indexed documents, groups of exact copies, threshold, bits."""
    groups = classes(prints)
    return groups.agg(
        F.coalesce(F.sum("members"), F.lit(0)).alias("total_indexed"),
        F.count_if(F.col("sha").isNotNull() & (F.col("members") > 1)).alias("exact_duplicate_groups"),
    ).select("*", F.lit(float(threshold)).alias("threshold"), F.lit(bits).cast("long").alias("hash_bits"))


def rendered(pairs: DataFrame, bits: int = 128) -> DataFrame:
    """pairs with `line`, one readable line each.

    Formatting a number costs more than comparing its pair, so the percentages that fingerprints of so many bits
    can have are formatted once; any other similarity still is by itself.
    """
    percent = lambda similarity: F.format_string("%.1f", similarity * 100)
    percents = F.array(*[percent(F.lit(1 - d / bits)) for d in range(bits + 1)])
    distance = (1 - F.col("similarity")) * bits
    known = distance.between(0, bits) & (distance == F.floor(distance))
    like = F.when(known, F.element_at(percents, distance.cast("int") + 1)).otherwise(percent(F.col("similarity")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    return pairs.withColumn("line", F.concat(text("id_a"), F.lit(" <-> "), text("id_b"), F.lit(" ("), like, F.lit("% similar, "), text("method"), F.lit(")")))
