"""What the label-trained operators share: the training split, a bounded labelled sample, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import pieces, text_bytes


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts))


def held(parts: int, held_fold: int) -> Column:
    """Whether a row is outside of training; a null id is never trained on and not held out either."""
    return F.coalesce(fold(F.col("doc_id"), parts) == held_fold, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held_fold: int, per_class: int, seed: int
) -> DataFrame:
    """(label, text) of at most per_class training ids of each of the labels 0 and 1, drawn by a seeded hash.

    The drawn ids, 2 * per_class rows at most, are what is broadcast. A doc_id labelled twice counts
    as the larger label; labels other than 0 and 1 and null ids are left out. An id that `docs` repeats
    gives one row, of its least text, so the result has 2 * per_class rows at most, too.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held(parts, held_fold))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    drawn = [
        usable.where(F.col("label") == k).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(per_class) for k in (0, 1)
    ]
    held_ = docs.select("doc_id", "text").join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id")
    return held_.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))


def scored(
    docs: DataFrame, parts: int, held_fold: int, threshold: float, score: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]]
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; score() makes, once a task, a function of (bytes, offsets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = score()
        for batch in batches:
            found = [apply(raw, at) for _, _, raw, at in pieces(*text_bytes(batch.column("text")))]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(values, pa.float64()),
                    pa.array((values >= threshold).astype(np.int32), pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held(parts, held_fold).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
