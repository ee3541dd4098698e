"""Longest matches against brute force, in one block and in several; the permuted tables of fingerprints on documents."""

import itertools

from pyspark.sql import functions as F

from docketspark.llm import op6_decontamination as op
from docketspark.llm import op10_simhash, queries

from .test_passages import words_of


def maximal(docs, items, window):
    out = set()
    for doc_id, text in docs:
        w = words_of(text)
        for item, other in items:
            v = words_of(other)
            least = min(window, len(v))
            for i, j in itertools.product(range(len(w)), range(len(v))):
                if w[i] == v[j] and (not i or not j or w[i - 1] != v[j - 1]):
                    n = next((k for k in range(min(len(w) - i, len(v) - j)) if w[i + k] != v[j + k]), min(len(w) - i, len(v) - j))
                    if n >= least:
                        out.add((doc_id, str(item), i, j, n))
    return out


def test_longest_matches_are_maximal(spark):
    base = "a b c d e f g h i j k l m n o p q r s t".split()
    items = [(1, " ".join(base)), (2, " ".join(base[5:] + base[:5])), (3, "x y"), (4, None), (5, "")]
    docs = [(k, " ".join(base[k : k + 14] + ["z"] + base[: k + 3] + ["x", "y"] * (k % 2))) for k in range(6)] + [(9, None), (10, "")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = maximal(docs, items, 4)
    assert want
    for block_bytes in (op.BLOCK_BYTES, 20):
        assert set(map(tuple, op.longest_matches(d, b, 4, block_bytes).collect())) == want


def test_longest_matches_of_the_tables(documents, benchmark_items):
    found = op.longest_matches(documents, benchmark_items).select("doc_id").distinct()
    judged = op.contamination(documents, benchmark_items).where("contaminated and n_items > 0").select("doc_id")
    assert {r[0] for r in found.collect()} == {r[0] for r in judged.collect()}


def test_registered_matches_are_maximal(spark, sf_dir, documents, benchmark_items):
    """The query over whole tables, against brute force on the documents that hold any match and as many others."""
    found = {tuple(r) for r in queries.benchmark_longest_matches(spark, sf_dir).collect()}
    held = sorted({r[0] for r in found})
    assert len(held) > 1
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    some = {i: texts[i] for i in [*held[:3], *sorted(texts.keys() - set(held))[:3]] if len(texts[i] or "") < 4000}
    items = [tuple(r) for r in benchmark_items.select("item_id", "text").collect()]
    assert {r for r in found if r[0] in some} == maximal(some.items(), items, 10)


def test_tables_find_every_near_fingerprint_of_the_documents(documents):
    prints = op10_simhash.fingerprints(documents)
    values = {r.fingerprint: int(r.fingerprint, 16) for r in prints.select("fingerprint").distinct().collect()}
    want = {(a, b) for (a, x), (b, y) in itertools.combinations(sorted(values.items()), 2) if (x ^ y).bit_count() <= 3}
    got = op10_simhash.within_radius(prints).select("a", "b", F.col("distance")).collect()
    assert {(r.a, r.b) for r in got} == want and all(r.distance == (values[r.a] ^ values[r.b]).bit_count() for r in got)
