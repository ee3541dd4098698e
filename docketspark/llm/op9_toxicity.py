"""Toxicity: a counterfactual-regularised classifier.

A logistic model over hashed features that occur in a text or do not: words, word beginnings and
character n-grams. Buckets are chosen by chi-square on a bounded sample of labelled rows
(`per_class` ids of each label), so weights exist only where a feature tells the labels apart.
Each sampled text that names an identity group gets a twin with every such term swapped for another
of its list; training adds `penalty` times the squared change of the score between the two, so that
naming a group cannot move a score by itself.

Defined cases: null and empty texts have no feature and get the prior's score; repeated rows are
scored alike; without labelled rows of both labels every score is the prior of 0.5 and nothing is
predicted toxic; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm import kernels
from docketspark.llm.common import pieces, text_bytes
from docketspark.llm.labelled import held, labelled_sample, scored, sigmoid

#: Terms of one list stand for each other in a counterfactual text.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)
PREFIXES = (4, 5, 6, 7, 8, 9)
GRAMS = (4, 5)


@dataclass(frozen=True)
class Settings:
    """per_class bounds the labelled rows that the model is fitted on."""

    per_class: int = 2000
    bits: int = 20
    chosen: int = 3000
    least_rows: int = 4
    epochs: int = 12
    rate: float = 0.3
    ridge: float = 1e-4
    penalty: float = 1.0
    seed: int = 9


def swapped(text: str, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> str:
    """The text with each identity term replaced by the next one of its list; equal to it if it has none."""
    other = {t: group[(i + 1) % len(group)] for group in terms for i, t in enumerate(group)}
    return re.sub(r"\w+", lambda m: other.get(m[0].lower(), m[0]), text)


def present(raw: np.ndarray, at: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every feature's occurrences, one kind of feature after the other."""
    low = kernels.LOWER[raw]
    down = np.uint64(64 - bits)
    start, end, first = kernels.words(low, at, kernels.ALNUM)
    row = kernels.rows_of(first)
    sums = kernels.prefix_sums(low)
    yield row, (kernels.range_hash(sums, start, end) >> down).astype(np.int64)
    for n in PREFIXES:
        longer = end - start > n
        s = start[longer]
        yield row[longer], (kernels.mix(kernels.range_hash(sums, s, s + n) + np.uint64(n)) >> down).astype(np.int64)
    for n in GRAMS:
        bucket, where = kernels.letter_grams(low, n, bits)
        in_row = np.searchsorted(at[1:], where, "right")
        keep = where + n <= at[1:][in_row] if len(where) else np.zeros(0, bool)
        yield in_row[keep], bucket[keep]


def buckets_of(text: bytes, bits: int) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    found = [b for _, b in present(raw, np.array([0, len(raw)]), bits)]
    return np.unique(np.concatenate(found)).astype(np.int32)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float, s: Settings) -> tuple[np.ndarray, float]:
    """Fits (weight of each bucket, bias) over (label, buckets, buckets of the swapped text)."""
    weight = np.zeros(1 << s.bits)
    labels = np.array([y for y, _, _ in rows])
    if len(set(labels.tolist())) < 2:
        return weight, 0.0
    n1, n0 = labels.sum(), (1 - labels).sum()
    in1, in0 = (sum(np.bincount(ids, minlength=1 << s.bits) for y, ids, _ in rows if y == k) for k in (1, 0))
    rows_with = in1 + in0
    expected = rows_with * n1 / (n0 + n1)
    chi = (in1 - expected) ** 2 / np.maximum(expected * (1 - rows_with / (n0 + n1 + 1)), 1e-9)
    chi[rows_with < s.least_rows] = 0
    keep = np.sort(np.argsort(-chi, kind="stable")[: s.chosen])
    keep = keep[chi[keep] > 10]
    place = np.full(1 << s.bits, -1, np.int32)
    place[keep] = np.arange(len(keep))
    cut = lambda ids: (p := place[ids])[p >= 0]
    data = [(y, cut(a), cut(b) if b is not a else None) for y, a, b in rows]
    w, bias = np.zeros(len(keep)), 0.0
    seen, rng = np.full(len(keep), 1e-2), np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for k in rng.permutation(len(data)):
            y, a, b = data[k]
            importance = prior / (n1 / len(data)) if y else (1 - prior) / (n0 / len(data))
            score = sigmoid(w[a].sum() + bias)
            step = importance * (score - y)
            bias -= 0.02 * s.rate * step
            grad = np.full(len(a), step) + s.ridge * w[a]
            seen[a] += grad**2
            w[a] -= s.rate * grad / np.sqrt(seen[a])
            if b is not None and len(d := np.setxor1d(a, b)):
                twin = sigmoid(w[b].sum() + bias)
                sign = np.where(np.isin(d, a), score * (1 - score), -twin * (1 - twin))
                grad = 2 * s.penalty * (score - twin) * sign
                seen[d] += grad**2
                w[d] -= s.rate * grad / np.sqrt(seen[d])
    weight[keep] = w
    return weight, bias


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 3, held_fold: int = 1,
    s: Settings = Settings(), terms: Sequence[Sequence[str]] = IDENTITY_TERMS,  # noqa: B008
) -> tuple[np.ndarray, float]:
    bits, terms = s.bits, tuple(map(tuple, terms))

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                other = swapped(text, terms)
                ids.append(buckets_of(text.encode(), bits).tobytes())
                twins.append(buckets_of(other.encode(), bits).tobytes() if other != text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(ids, pa.binary()), pa.array(twins, pa.binary())], ["label", "ids", "twin"]
            )

    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held(parts, held_fold))
    prior = usable.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    sample = labelled_sample(docs, labels, label, parts, held_fold, s.per_class, s.seed).select("label", "text")
    rows = []
    for y, ids, twin in sample.mapInArrow(compact, "label int, ids binary, twin binary").collect():
        found = np.frombuffer(ids, np.int32)
        rows.append((y, found, found if twin is None else np.frombuffer(twin, np.int32)))
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))  # the order of arrival must not count
    return train(rows, float(prior), s)


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 3, held_fold: int = 1, threshold: float = 0.7,
    s: Settings = Settings(), terms: Sequence[Sequence[str]] = IDENTITY_TERMS,  # noqa: B008
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    weight, bias = fit(docs, labels, label, parts, held_fold, s, terms)
    return scored(docs, parts, held_fold, threshold, scorer(docs, weight, bias, s.bits))


def scorer(docs: DataFrame, weight: np.ndarray, bias: float, bits: int):
    model = docs.sparkSession.sparkContext.broadcast(weight.astype(np.float32))

    def score():
        number = model.value
        used = number != 0

        def apply(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
            keys = []
            for row, bucket in present(raw, at, bits):
                on = used[bucket]
                keys.append((row[on] << bits) | bucket[on])
            found = np.unique(np.concatenate(keys))
            total = np.bincount(found >> bits, number[found & ((1 << bits) - 1)], minlength=len(at) - 1)
            return sigmoid(total + bias)

        return apply

    return score


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """The rows of docs, all columns, that the classifier does not reject."""
    weight, bias = fit(docs, labels, **settings)
    bits = settings.get("s", Settings()).bits
    make, names = scorer(docs, weight, bias, bits), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            found = [apply(raw, at) for _, _, raw, at in pieces(*text_bytes(batch.column(names.index("text"))))]
            if found:
                yield batch.filter(pa.array(np.concatenate(found) < threshold))

    return docs.mapInArrow(run, docs.schema)
