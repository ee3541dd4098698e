"""Links counted without pairs, and statistics of documents of mixed kinds."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketspark.operators import dedup, dynamic, links
from docketspark.sources.files import as_variants


def brute(rows, threshold, bits=128):
    """id -> (representative, copies, n_links, nearest, similarity, group_id) from (id, sha, fingerprint)."""
    classes = {}
    for i, sha, f in rows:
        classes.setdefault(sha, []).append((i, f))
    reps = {min(c)[0]: (len(c), c[0][1]) for c in classes.values()}
    like = {}
    for a, b in itertools.permutations(reps, 2):
        x, y = reps[a][1], reps[b][1]
        if x and y and 1 - (x ^ y).bit_count() / bits >= threshold:
            like.setdefault(a, []).append((-(1 - (x ^ y).bit_count() / bits), b))
    group = {r: r for r in reps}
    changed = True
    while changed:
        changed = False
        for a, near in like.items():
            for _, b in near:
                least = min(group[a], group[b])
                changed |= group[a] != least or group[b] != least
                group[a] = group[b] = least
    out = []
    for c in classes.values():
        r = min(c)[0]
        near = min(like.get(r, [(None, None)]), key=lambda x: (x[0] is None, x))
        out += [(i, r, len(c) - 1, len(like.get(r, [])), near[1], None if near[0] is None else -near[0], group[r]) for i, _ in c]
    return sorted(out)


def prints(n, seed, spread):
    """Fingerprints around a few centres, some equal, some empty, some texts copied."""
    rng = random.Random(seed)
    centres, rows = [rng.getrandbits(128) for _ in range(4)], []
    for k in range(n):
        f = rng.choice(centres)
        for _ in range(rng.randrange(spread)):
            f ^= 1 << rng.randrange(128)
        rows.append((f"d{k:03d}", f"sha{k}", f))
    rows += [(f"e{k}", "sha3", rows[3][2]) for k in range(3)] + [("f0", None, 0), ("f1", None, 0), ("g", "none", 0), ("h", "same print", rows[5][2])]
    return rows


def table(spark, rows):
    signed = lambda x: int(np.uint64(x).astype(np.int64))
    return spark.createDataFrame([(i, sha, signed(f >> 64), signed(f & ((1 << 64) - 1))) for i, sha, f in rows], "id string, sha string, hi long, lo long")


@pytest.mark.parametrize(("threshold", "tile"), [(0.85, 8192), (0.85, 16), (0.95, 30), (1.0, 8192)])
def test_link_summary(spark, threshold, tile):
    rows = prints(170, 7, 24)
    found = links.link_summary(table(spark, rows), threshold, tile=tile)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, threshold)


def test_link_summary_of_few(spark):
    one = table(spark, [("a", "s", 5)])
    assert [tuple(r) for r in links.link_summary(one).collect()] == [("a", "a", 0, 0, None, None, "a")]
    assert links.link_summary(one.limit(0)).collect() == []
    assert [r.n_links for r in links.link_summary(table(spark, prints(6, 1, 2)), 1.1).collect()] == [0] * 13


def test_link_summary_makes_no_pairs(spark):
    """Where all are linked with all, what the tasks give on follows documents, and the pairs are all counted."""
    rng = random.Random(3)
    rows = [(f"d{k:04d}", f"s{k}", (1 << 127 | 1 << 60) ^ (1 << rng.randrange(100)) ^ (1 << rng.randrange(100, 120))) for k in range(700)]
    seen = []
    real = links.components
    links.components = lambda edges: seen.append(edges.count()) or real(edges)
    try:
        found = links.link_summary(table(spark, rows), 0.85, tile=100).collect()
    finally:
        links.components = real
    assert sum(r.n_links for r in found) == 700 * 699 and {r.group_id for r in found} == {"d0000"}
    assert seen[0] <= 700 * 12


def test_same_links_as_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    p = dedup.fingerprints(docs, id_="doc_id").cache()
    pairs = dedup.near_pairs(p, 0.9).select(F.explode(F.array("id_a", "id_b")).alias("id")).groupBy("id").count()
    want = {r["id"]: r["count"] for r in pairs.collect()}
    assert want == {r.id: r.n_links for r in links.link_summary(p, 0.9).where("n_links > 0 and id = representative").collect()}
    p.unpersist()


MIXED = [
    '{"id": "1", "court": "High", "year": 2020, "judges": ["A", "B", null, 3], "text": "abcd"}',
    '{"id": "2", "court": "High", "year": "2020", "judges": "A", "text": "äöü"}',
    '{"id": "3", "court": null, "year": 2020.0, "judges": null, "text": null}',
    '{"id": "4", "year": 2021.5, "judges": [], "text": ""}',
    '{"id": "5", "court": 7, "year": null, "judges": {"name": "A"}, "text": ["x", "y"]}',
    '{"id": "6", "court": ["High"], "year": true, "judges": [["A"], "A", 3.0], "text": 12}',
    "[1, 2]",
    "not json",
]


def test_dynamic_statistics(spark):
    docs = as_variants(spark.createDataFrame([(x,) for x in MIXED], "value string"))
    got = lambda df: {(r[0], r[1]): r[2] for r in df.collect()}
    assert got(dynamic.court_distribution(docs)) == {("High", "text"): 2, (None, "null"): 1, ("Unknown", "text"): 1, ("7", "number"): 1, ('["High"]', "list"): 1}
    assert got(dynamic.year_distribution(docs)) == {("2020", "number"): 2, ("2020", "text"): 1, ("2021.5", "number"): 1, (None, "null"): 1, ("true", "truth"): 1}
    assert got(dynamic.judge_frequency(docs)) == {("A", "text"): 2, ("B", "text"): 1, (None, "null"): 1, ("3", "number"): 2, ('["A"]', "list"): 1}
    assert tuple(dynamic.text_stats(docs).first()) == (6, 3, 4, 2, 3)
    both = dynamic.compare_periods(docs, (2019, 2020), (2021, 2022)).first()
    assert (both.total_cases_1, both.total_cases_2, both.case_count_change, both.cases_with_text_1) == (2, 1, -1, 1)
    found = dynamic.corpus_stats(docs)
    assert found["total_cases"] == 6 and found["courts"][None] == 1 and found["years"]["true (truth)"] == 1
    assert dynamic.corpus_stats(docs.limit(0)) == {"error": "No cases found"}


@pytest.mark.parametrize("tile", [8192, 16, 3])
def test_most_similar(spark, tile):
    rows = prints(90, 5, 30) + [("z1", "e1", 0), ("z2", "e2", 0)]
    found = links.most_similar(table(spark, rows), "id like '%0' or id like 'z%' or id like 'e%'", 7, tile=tile)
    want = []
    for i, _, f in rows:
        if i.endswith("0") or i[0] in "ze":
            like = lambda g, f=f: 1.0 if f == g else 0.0 if not f or not g else 1 - (f ^ g).bit_count() / 128
            near = sorted((-like(g), j) for j, _, g in rows if j != i)[:7]
            want += [(i, j, k, -s) for k, (s, j) in enumerate(near, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_most_similar_of_few(spark):
    two = table(spark, [("a", "s", 5), ("b", "t", 7)])
    assert sorted(map(tuple, links.most_similar(two, "id = 'a'").collect())) == [("a", "b", 1, 1 - 1 / 128)]
    assert links.most_similar(two, "id = 'c'").collect() == [] and links.most_similar(two.limit(0), "true").collect() == []
