"""Hard negatives by a full sort of scores for each anchor.

Vectors become integers, floor(256 * x) each, and a row's score is its integer inner product with
the anchor. Higher scores come first, ties by the smaller id. An anchor's positives are its first
rows of the same label, itself left out; a positive's negatives are the first rows of other labels
whose scores lie between `low` and `high` hundredths of the positive's.

Every row meets every anchor, in blocks: anchors go out in chunks of bounded bytes, and tasks hold
a slab of rows at a time. A task scores a slab against an anchor, sorts it by (score, id),
finds a positive's upper limit by binary search and reads the next k rows of other labels down to
the lower limit. It keeps the best k of all its slabs for each anchor and positive, so what is
shuffled is k rows a task, and Spark's ranked windows choose among the tasks. No task and no group
follows the table's size: a row more is work more, not memory.

Each chunk of anchors takes two passes over the rows, since the limits follow from all rows'
scores. Rows and anchors are written to the shared folder first, so that passes don't read the
source and a row keeps its number if a task is run again.

Defined cases: rows with a null label, a null vector or any null or non-finite component take no
part; a row without an id is no anchor and ranks after rows that have one (2**63 - 1 stands for it);
repeated rows are rows of their own, and another row with the anchor's id may be its positive;
of vectors of different lengths the shorter is filled up with zeros; scores beyond a long are
computed exactly and shown as the nearest long; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketspark.llm.common import partitions, scratch, written

#: Bytes of anchors that one pass sends to all tasks, and of rows that a task scores at a time.
CHUNK_BYTES = 4 << 20
SLAB_BYTES = 4 << 20
#: Scores held at a time.
SCORES = 1 << 20
_NO_ID = (1 << 63) - 1
_EXACT = float(1 << 53)
_FOUND = "a int, p int, id long, score long"


def _matrix(vectors: pa.Array) -> np.ndarray:
    """floor(256 * x) of each component as doubles, rows filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(256 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    width = int(sizes.max()) if len(sizes) else 0
    if len(sizes) * width == len(values):
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _norm(rows: np.ndarray) -> float:
    return float(np.sqrt((rows * rows).sum(axis=1).max())) if rows.size else 0.0


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(anchors, rows) exact inner products: as doubles where no partial sum can pass 2**53, as Python integers otherwise."""
    width = min(anchors.shape[1], rows.shape[1])
    anchors, rows = anchors[:, :width], rows[:, :width]
    if _norm(anchors) * _norm(rows) < _EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return whole(anchors) @ whole(rows).T


def best(group: np.ndarray, score: np.ndarray, id_: np.ndarray, k: int) -> np.ndarray:
    """The places of the first k of each group, by descending score, then id."""
    order = np.lexsort((id_, -score, group))
    own = group[order]
    head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])[: len(own)]
    rank = np.arange(len(own)) - np.repeat(head, np.diff(np.append(head, len(own))))
    return order[rank < k]


def _pass(chunk, each, k: int):
    """Rows (row, id, label, vector) to (a, p, id, score): the best k of a task for each anchor a and positive p.

    each(a, scores, row, id, label) yields (p, places) of a slab for one anchor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = chunk.value
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object if anchors["wide"] else np.int64)]
        for batch in batches:
            width = int(pa.compute.max(batch.column("vector").value_lengths()).as_py() or 0) if batch.num_rows else 0
            step = max(1, SLAB_BYTES // (8 * max(width, 1)))
            for i in range(0, batch.num_rows, step):
                slab = batch.slice(i, step)
                rows = _matrix(slab.column("vector"))
                row, id_, label = (slab.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "label"))
                found = [[x] for x in kept]
                some = max(1, SCORES // max(1, len(rows)))
                for a0 in range(0, len(anchors["row"]), some):
                    scores = _scores(anchors["vector"][a0 : a0 + some], rows)
                    for a, own in enumerate(scores, a0):
                        for p, places in each(a, own, row, id_, label):
                            found[0].append(np.full(len(places), a << 16 | p))
                            found[1].append(id_[places])
                            found[2].append(own[places])
                group, ids, score = (np.concatenate(x) for x in found)
                at = best(group, score, ids, k)
                kept = [group[at], ids[at], score[at]]
        group, ids, score = kept
        for i in range(0, len(group), 1 << 16):
            part = slice(i, i + (1 << 16))
            long = np.array([min(max(int(x), -_NO_ID - 1), _NO_ID) for x in score[part]], np.int64) if score.dtype == object else score[part]
            columns = [pa.array(group[part] >> 16, pa.int32()), pa.array(group[part] & 0xFFFF, pa.int32()), pa.array(ids[part], pa.int64()), pa.array(long, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "p", "id", "score"])

    return run


def _positives(chunk, k: int):
    """For each anchor the first k other rows of its label."""

    def each(a: int, score, row, id_, label):
        same = np.flatnonzero((label == chunk.value["label"][a]) & (row != chunk.value["row"][a]))
        if len(same):
            yield 0, same[np.lexsort((id_[same], -score[same]))[:k]]

    return _pass(chunk, each, k)


def _negatives(chunk, positives, k: int, low: int, high: int):
    """For each anchor and positive the first k rows of other labels within its limits; positives: each anchor's positive scores."""

    def each(a: int, score, row, id_, label):
        wanted = positives.value.get(a)
        if not wanted:
            return
        order = np.lexsort((id_, -score))
        descending = -score[order]
        other = np.flatnonzero(label[order] != chunk.value["label"][a])
        for p, positive in enumerate(wanted):
            upper, lower = high * positive // 100, -(-low * positive // 100)
            start = np.searchsorted(descending, -upper, "left")
            end = np.searchsorted(descending, -lower, "right")
            first = np.searchsorted(other, start)
            places = other[first : first + k]
            places = places[places < end]
            if len(places):
                yield p, order[places]

    return _pass(chunk, each, k)


def _ranges(counts: list[tuple[int, int]], most: int) -> Iterator[tuple[int, int]]:
    """Ranges [from, to) of numbers that hold up to `most` anchors, of (partition, anchors) in order; a partition's numbers start at its own times 2**33."""
    low, held = None, 0
    for part, n in counts:
        base, done = part << 33, 0
        while done < n:
            low = base + done if low is None else low
            some = min(n - done, most - held)
            done, held = done + some, held + some
            if held == most:
                yield low, base + done
                low, held = None, 0
    if low is not None:
        yield low, base + n


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column | str = "vec_id % 100 = 0", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    id_: str = "vec_id", label: str = "label", vector: str = "embedding", chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the rows that `anchor`, a condition on id_, chooses."""
    if not 1 <= positives < 1 << 16 or negatives < 1:
        raise ValueError("positives must be from 1 to 65535, negatives at least 1")
    spark = rows.sparkSession
    kind = rows.schema[vector].dataType
    component = kind.elementType if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType)) else T.DoubleType()
    chosen = F.expr(anchor) if isinstance(anchor, str) else anchor
    plain = rows.select(
        F.coalesce(F.col(id_).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast(T.ArrayType(component)).alias("vector"), F.coalesce(chosen, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    taking_part = plain.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    outs = []
    with scratch(spark):  # rows and anchors go with the last pass
        held = written(taking_part.repartition(partitions(spark)).withColumn("row", F.monotonically_increasing_id()), "rows")
        anchors = written(held.where("anchor").withColumn("place", F.monotonically_increasing_id()), "anchors")
        counts = anchors.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).orderBy("part").collect()
        widest = max((c.width for c in counts), default=1)
        wide = held.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x).cast("double") * 256 + 1, F.lit(2))))).first()[0] or 0.0
        for start, end in _ranges([(c.part, c.n) for c in counts], max(1, chunk_bytes // (8 * max(widest, 1)))):
            own = anchors.where((F.col("place") >= start) & (F.col("place") < end)).orderBy("place").select("row", "id", "label", "vector").toArrow().combine_chunks()
            numbers = {c: own.column(c).to_numpy() for c in ("row", "id", "label")}
            chunk = spark.sparkContext.broadcast({**numbers, "vector": _matrix(own.column("vector").combine_chunks()), "wide": wide >= _EXACT})
            scored = held.select("row", "id", "label", "vector")
            first = _ranked(scored.mapInArrow(_positives(chunk, positives), _FOUND), ["a"], positives).orderBy("a", "rank").select("a", "id", "score").collect()
            by_anchor: dict[int, list] = {}
            for r in first:
                by_anchor.setdefault(r.a, []).append((r.id, r.score))
            scores = spark.sparkContext.broadcast({a: [s for _, s in v] for a, v in by_anchor.items()})
            named = [(a, p, int(numbers["id"][a]), i, s) for a, v in by_anchor.items() for p, (i, s) in enumerate(v)]
            names = spark.createDataFrame(named, "a int, p int, anchor_id long, positive_id long, positive_score long")
            found = _ranked(scored.mapInArrow(_negatives(chunk, scores, negatives, low, high), _FOUND), ["a", "p"], negatives)
            out = found.join(F.broadcast(names), ["a", "p"]).select(
                "anchor_id", F.nullif("positive_id", F.lit(_NO_ID)).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                F.nullif("id", F.lit(_NO_ID)).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
            )
            outs.append(written(out, "negatives", keep=True))
    if not outs:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, outs)
