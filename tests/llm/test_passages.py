"""Suffix dedup and decontamination, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketspark.llm import op4_suffix, op6_decontamination

from .conftest import prose


def removed(rows, length):
    """What goes of each row: a string goes that also starts at a smaller (id, start); null ids first."""
    key = lambda r: (r[0] is not None, r[0] or 0)
    first = {}
    for r in rows:
        b = (r[1] or "").encode()
        for i in range(len(b) - length + 1):
            s = (*key(r), i)
            first[b[i : i + length]] = min(first.get(b[i : i + length], s), s)
    out = []
    for r in rows:
        b = (r[1] or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (*key(r), i):
                gone[i : i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((r[0], len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_removals_match_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(op4_suffix.removals(documents)) == removed(rows, 100)


def test_removals_of_spliced_passages(spark):
    rng = random.Random(2)
    passages = [prose(100 + k, rng.randint(10, 40)) for k in range(6)]
    rows = []
    for k in range(60):
        parts = [prose(k, rng.randint(0, 12)) if rng.random() < 0.5 else rng.choice(passages)[rng.randint(0, 30) :] for _ in range(rng.randint(1, 6))]
        rows.append((k * 7 % 61, " ".join(parts)))
    rows += [(500, "ab" * 300), (501, "ab" * 200 + "c"), (502, "é" * 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for length in (40, 100):
        assert result(op4_suffix.removals(df, length)) == removed(rows, length)


def test_removals_of_odd_rows(odd, odd_rows, none):
    assert result(op4_suffix.removals(odd)) == removed([(r[0], r[1]) for r in odd_rows], 100)
    assert op4_suffix.removals(none).count() == 0
    cut = op4_suffix.deduplicated(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert op4_suffix.deduplicated(none).count() == 0
    texts = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert texts[0] == (None, None) and texts[6] == ("", 0)


@pytest.mark.parametrize("ids", [(1, 5, 5), (1, None, None)])
def test_texts_of_one_id_with_equal_short_hashes(spark, ids):
    """Two texts that 32 bits of hash don't tell apart, under one id: what repeats of the one is not cut from the other."""
    texts = spark.range(300_000).select(F.sha2(F.col("id").cast("string"), 512).alias("text"))
    a, b = texts.groupBy(F.hash("text")).agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").orderBy("a").select("a", "b").first()
    rows = list(zip(ids, (a, a, b), strict=True))
    assert result(op4_suffix.removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == removed(rows, 100)


def test_index_gives_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(1)
    for k in range(40):
        parts = [bytes(rng.choice([97, 98, 0, 255], rng.integers(1, 30)).tolist()) for _ in range(rng.integers(1, 6))]
        parts += parts if k % 3 == 0 else []
        text, ends = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
        index = op4_suffix.RunIndex(text, ends)
        suffixes = [(bytes(text[i : index.until[i]]), i) for i in range(len(text))]
        order = [i for _, i in sorted(suffixes)]
        assert index.order.tolist() == order
        common = [0] * len(text)
        for a, b in zip(order, order[1:], strict=False):
            x, y = suffixes[a][0], suffixes[b][0]
            common[b] = next((n for n, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert index.common_with_predecessor().tolist() == common


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def hits(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc_id, text in rows:
        w, hit, ids = words_of(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    ids |= {str(x) for x in found if x is not None}
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_matches_brute_force(documents, benchmark_items):
    rows, items = [(r.doc_id, r.text) for r in documents.collect()], [tuple(r) for r in benchmark_items.select("item_id", "text").collect()]
    want = hits(rows, items)
    assert any(r[-1] for r in want)
    assert result(op6_decontamination.contamination(documents, benchmark_items)) == want
    assert result(op6_decontamination.contamination(documents, benchmark_items, block_bytes=3000)) == want
    kept = {r.doc_id for r in op6_decontamination.decontaminated(documents, benchmark_items, block_bytes=3000).collect()}
    assert kept == {r[0] for r in want if not r[-1]}


def test_decontamination_of_odd_rows(spark, odd, odd_rows, none):
    items = [(1, None), (2, ""), (3, "..."), (4, "one"), (None, prose(2, 30)), (5, prose(2, 12)), (5, prose(2, 12)), (6, prose(1, 40)), (7, "Zwölf böcke")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(op6_decontamination.contamination(odd, bench)) == hits([(r[0], r[1]) for r in odd_rows], items)
    assert op6_decontamination.contamination(none, bench).count() == 0
    empty = bench.limit(0)
    assert not any(r.contaminated for r in op6_decontamination.contamination(odd, empty).collect())
    assert op6_decontamination.decontaminated(odd, empty).count() == odd.count()


def test_longest_matches(spark):
    item = "a b c d e f g h i j k l m n"
    docs = spark.createDataFrame([(1, "x y " + item + " z"), (2, "a b c d e f g h i j k q")], "doc_id long, text string")
    found = op6_decontamination.longest_matches(docs, spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert sorted(map(tuple, found.collect())) == [(1, "9", 2, 0, 14), (2, "9", 0, 0, 11)]
