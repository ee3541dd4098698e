"""The Jaccard join and components, against brute force."""

import random
import re

import numpy as np

from docketspark.llm import op2_jaccard as op
from docketspark.llm.graph import components

from .conftest import SCHEMA, prose

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def words_of(text):
    return SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, words, percent):
    """(doc_id, size, component) by all pairs; rows with an id only."""
    sets = []
    for doc_id, text in rows:
        w = words_of(text)
        sets.append((doc_id, {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())))
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(i), top(j)
                up[p] = q
    smallest = {}
    for i, (a, _) in enumerate(sets):
        if a is not None:
            smallest[top(i)] = min(smallest.get(top(i), a), a)
    return sorted(((a, len(x), None if a is None else smallest[top(i)]) for i, (a, x) in enumerate(sets)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_matches_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(op.jaccard_join(documents, 4, 85)) == brute(rows, 4, 85)
    assert result(op.jaccard_join(documents)) == brute(rows, 5, 80)


def test_edited_copies_near_the_threshold(spark):
    rng, rows = random.Random(4), []
    for size in (3, 5, 6, 7, 9, 20, 33, 60, 150, 400):
        base = prose(size, size).split()
        for k in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 1 + size // 25)):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for words, percent in ((4, 85), (5, 80), (1, 50), (2, 97)):
        assert result(op.jaccard_join(df, words, percent)) == brute(rows, words, percent)


def test_odd_rows(odd, odd_rows, none):
    assert result(op.jaccard_join(odd)) == brute([(r[0], r[1]) for r in odd_rows], 5, 80)
    assert op.jaccard_join(none).count() == 0
    kept = op.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 not in ids and 7 not in ids and 5 in ids and 0 in ids and ids.count(None) == 2
    assert op.one_of_each(none).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = (prose(k, 60) for k in (101, 102, 103, 104))
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (3, a + " more", "x")]  # repeated rows and a near copy
    rows += [(5, b, "x"), (9, b, "x"), (5, c, "x"), (2, c, "x")]  # 5 has two texts: b stays with 5, c with 2
    rows += [(None, d, "x")] * 3 + [(None, d + " more", "x"), (None, None, "x"), (None, None, "x"), (7, "", "x"), (7, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = op.one_of_each(df.repartition(5)).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == [(1, a), (2, c), (5, b), (7, ""), (7, "")]
    nameless = [r.text for r in kept if r.doc_id is None]
    assert nameless.count(None) == 2 and len(nameless) == 3
    assert sorted(map(tuple, kept), key=repr) == sorted(map(tuple, op.one_of_each(df.coalesce(1)).collect()), key=repr)


def test_region_join_is_exact():
    rng = np.random.default_rng(0)
    for _ in range(60):
        base = rng.integers(0, 1 << 60, 40).astype(np.uint64)
        sets = []
        for _ in range(int(rng.integers(1, 30))):
            s = base.copy()
            s[rng.random(40) < rng.choice([0.02, 0.08, 0.2])] = rng.integers(0, 1 << 60)
            sets.append(np.unique(s))
        found = op.region_components(sets, 85)
        linked = [[100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in sets] for a in sets]
        want = list(range(len(sets)))
        for _ in sets:
            want = [min([want[i], *(want[j] for j in range(len(sets)) if linked[i][j])]) for i in range(len(sets))]
        assert found.tolist() == want


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 200), (300, 200), (7, 7)]
    random.Random(1).shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(found[k] == 0 for k in range(61)) and found[300] == found[200] == found[100] == 100


def test_schema_constant_is_used():
    assert "doc_id" in SCHEMA
