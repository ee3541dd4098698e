"""Quality classifier: supervised subword embeddings.

Words, pairs of words and character n-grams are hashed to buckets; each bucket has a learned vector;
a document is the mean of its features' vectors, and a softmax over the two labels reads that mean.
Vectors and output weights are trained by numpy stochastic gradient descent on a bounded sample of
labelled rows (`per_class` ids of each label). As the output is linear in the mean, scoring needs
one number per bucket: the bucket's vector times the difference of the two output rows.

A word that repeats the word before it is one shared pair, whatever the word.

Defined cases: null and empty texts have no feature and get the prior's score; repeated rows are
scored alike; without labelled rows of both labels every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docketspark.llm import kernels
from docketspark.llm.common import pieces, text_bytes
from docketspark.llm.labelled import labelled_sample, scored, sigmoid

GRAMS = (3, 4, 5)


@dataclass(frozen=True)
class Settings:
    """per_class bounds the labelled rows that the model is fitted on."""

    per_class: int = 1200
    bits: int = 17
    dim: int = 10
    epochs: int = 6
    rate: float = 1.0
    seed: int = 3


def features(raw: np.ndarray, at: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(bucket of each feature, offsets of each row's first feature)] of words, word pairs and n-grams."""
    start, end, first = kernels.words(raw, at, kernels.NOT_SPACE)
    down = np.uint64(64 - bits)
    hashed = kernels.range_hash(kernels.prefix_sums(raw), start, end)
    same = np.zeros(len(hashed), bool)
    same[1:] = hashed[1:] == hashed[:-1]
    pair = np.zeros(len(hashed), np.uint64)
    pair[1:] = kernels.mix(hashed[:-1] * np.uint64(3) + hashed[1:])
    pair[same] = 1
    heads = first[:-1][np.diff(first) > 0]
    pair[heads] = hashed[heads]  # a first word is paired with the text's start
    out = [((h >> down).astype(np.int64), first) for h in (hashed, kernels.mix(pair))]
    for n in GRAMS:
        bucket, where = kernels.letter_grams(raw, n, bits)
        row_end = at[1:][np.searchsorted(at[1:], where, "right")] if len(where) else where
        keep = where + n <= row_end
        bucket, where = bucket[keep], where[keep]
        out.append((bucket, np.searchsorted(where, at)))
    return out


def counted(raw: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of a single text."""
    found = np.concatenate([b for b, _ in features(raw, at, bits)])
    return np.unique(found, return_counts=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], s: Settings) -> tuple[np.ndarray, float]:
    """Fits vectors and softmax by SGD over (label, buckets, counts): (number of each bucket, bias)."""
    rng = np.random.default_rng(s.seed)
    vectors = ((rng.random((1 << s.bits, s.dim)) - 0.5) / s.dim).astype(np.float32)
    out, bias = np.zeros((2, s.dim), np.float32), np.zeros(2, np.float32)
    rows = [(y, ids, (c / c.sum()).astype(np.float32)) for y, ids, c in rows if len(ids)]
    if {y for y, _, _ in rows} != {0, 1}:
        return np.zeros(1 << s.bits, np.float32), 0.0
    share = np.bincount([y for y, _, _ in rows], minlength=2) / len(rows)
    steps, total = 0, s.epochs * len(rows)
    for _ in range(s.epochs):
        for k in rng.permutation(len(rows)):
            y, ids, weight = rows[k]
            rate = s.rate * (1 - steps / total) * 0.5 / share[y]
            steps += 1
            mean = weight @ vectors[ids]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= 0.1 * rate * p
            # a text's step is shared out over its features, so that long texts learn as fast as short ones
            vectors[ids] -= (rate / max(weight @ weight, 1e-3) * 0.1) * np.outer(weight, back)
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, held_fold: int = 0, s: Settings = Settings()):  # noqa: B008
    bits = s.bits

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column("text"))
            ids, counts = [], []
            for i in range(len(at) - 1):
                found = counted(raw[at[i] : at[i + 1]], np.array([0, at[i + 1] - at[i]]), bits)
                ids.append(found[0].astype(np.uint32).tobytes())
                counts.append(found[1].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["label", "ids", "counts"]
            )

    sample = labelled_sample(docs, labels, label, parts, held_fold, s.per_class, s.seed).select("label", "text")
    drawn = sample.mapInArrow(compact, "label int, ids binary, counts binary").collect()
    rows = [(r[0], np.frombuffer(r[1], np.uint32).astype(np.int32), np.frombuffer(r[2], np.uint32)) for r in drawn]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))  # the order of arrival must not count
    return train(rows, s)


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, held_fold: int = 0, threshold: float = 0.3,
    s: Settings = Settings(),  # noqa: B008
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    weight, bias = fit(docs, labels, label, parts, held_fold, s)
    model, bits = docs.sparkSession.sparkContext.broadcast(weight.astype(np.float32)), s.bits

    def score():
        number = model.value

        def apply(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
            total, n = np.zeros(len(at) - 1), np.zeros(len(at) - 1)
            for bucket, first in features(raw, at, bits):
                total += kernels.row_sums(number[bucket], first)
                n += np.diff(first)
            return sigmoid(total / np.maximum(n, 1) + bias)

        return apply

    return scored(docs, parts, held_fold, threshold, score)
