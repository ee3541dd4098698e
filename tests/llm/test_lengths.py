"""Suffix dedup at short and long lengths, and with minimizers too common for one shard."""

import random

import pytest

from docketspark.llm import op4_suffix

from .conftest import prose
from .test_passages import removed, result


def spliced(seed, n):
    rng = random.Random(seed)
    passages = [prose(200 + k, rng.randint(20, 160)) for k in range(5)]
    rows = []
    for k in range(n):
        parts = [prose(k, rng.randint(0, 12)) if rng.random() < 0.5 else rng.choice(passages)[rng.randint(0, 30) :] for _ in range(rng.randint(1, 5))]
        rows.append((k * 7 % 61, " ".join(parts)))
    return [*rows, (500, "ab" * 300), (501, "ab" * 200 + "c"), (502, None), (None, "ab" * 150)]


@pytest.mark.parametrize("length", [1, 20, 32, 286, 287, 400])
def test_lengths(spark, length):
    rows = spliced(length, 25)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(op4_suffix.removals(df, length)) == removed(rows, length)


def test_common_minimizers(spark):
    line = "this work is licensed to the public under the terms that follow, without warranty of any kind"
    rows = [(k, f"{prose(k, 6)} {line} {prose(k % 9, 5)}") for k in range(50)] + spliced(3, 20)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot_bytes in (0, 2000):
        assert result(op4_suffix.removals(df, 100, hot_bytes)) == removed(rows, 100)


def test_lengths_out_of_range(none):
    for length in (0, 1 << 15):
        with pytest.raises(ValueError):
            op4_suffix.removals(none, length)
