"""Fingerprints by plain votes, and the documents within a radius, against all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docketspark.llm import kernels, op10_simhash, queries
from docketspark.llm.common import text_bytes


def word_hash(word):
    raw = np.frombuffer(word, np.uint8)
    return kernels.range_hash(kernels.prefix_sums(raw), np.array([0]), np.array([len(raw)]))[0]


def plain(text):
    """The fingerprint by one vote of each distinct term on each bit, in Python."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    terms = [(int(word_hash(w)), min(12, len(w))) for w in words]
    for a, b in zip(words, words[1:], strict=False):
        terms.append((int(kernels.shingles(np.array([word_hash(a), word_hash(b)]), 2)[0]), min(12, min(12, len(a)) + min(12, len(b)))))
    votes = [0.0] * 128
    for (value, factor), n in sorted(Counter(terms).items()):
        second = int(kernels.mix(np.array([value], np.uint64) + np.uint64(1))[0])
        for bit in range(128):
            on = value >> (63 - bit) & 1 if bit < 64 else second >> (127 - bit) & 1
            votes[bit] += (1 if on else -1) * math.log1p(n) * factor
    return f"{sum((v > 1e-9) << (127 - k) for k, v in enumerate(votes)):032x}"


def all_pairs(rows, radius):
    """(number of other rows within the radius, least id) by the place of each row."""
    values = [None if p is None else int(p, 16) for _, p in rows]
    out = []
    for i, x in enumerate(values):
        near = [] if x is None else [j for j, y in enumerate(values) if j != i and y is not None and (x ^ y).bit_count() <= radius]
        ids = [rows[j][0] for j in [i, *near] if rows[j][0] is not None]
        out.append((*rows[i], len(near), min(ids) if ids else None))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "n_within", "least_within").collect()), key=repr)


def test_fingerprints_are_the_votes_of_all_terms(documents, odd_rows):
    texts = [r.text for r in documents.orderBy("doc_id").collect()[:40] if len(r.text or "") < 5000] + [r[1] for r in odd_rows[:6]]
    made = op10_simhash.simhash(*text_bytes(pa.array(texts, pa.string())))
    assert [bytes(x).hex() for x in made] == [plain(t) for t in texts]


def test_neighbours_of_the_registered_query(spark, sf_dir, documents):
    rows = queries.op10_fingerprints(spark, sf_dir)
    assert rows.count() == documents.count()
    assert found(rows) == all_pairs([(r.doc_id, r.fingerprint) for r in rows.collect()], 3)
    assert rows.where("n_within > 0").count() > 0


def test_neighbours_in_tiles_copies_and_rows_without_ids(spark):
    rng = random.Random(8)
    one = rng.getrandbits(128)
    values = [one] * 9
    for _ in range(90):  # one hot key: most of these share a block with `one`
        value = one
        for bit in rng.sample(range(128), rng.randint(1, 5)):
            value ^= 1 << bit
        values.append(value)
    values += [rng.getrandbits(128) for _ in range(30)] + [0, 0, 0]
    rows = [(k if k % 11 else None, f"{v:032x}") for k, v in enumerate(values)] + [(500, None), (None, None), (7, f"{one:032x}"), (7, f"{one:032x}")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string").repartition(3)
    for radius, blocks, tile in ((3, 4, 1 << 13), (3, 4, 5), (0, 1, 4), (5, 8, 7), (2, 4, 3)):
        assert found(op10_simhash.with_neighbours(df, radius, blocks, tile)) == all_pairs(rows, radius), (radius, blocks, tile)
    with pytest.raises(ValueError):
        op10_simhash.with_neighbours(df, 4, 4)


def test_neighbours_without_rows_and_beside_clashing_columns(spark, odd, none):
    assert op10_simhash.with_neighbours(op10_simhash.with_edits(none)).count() == 0
    clash = op10_simhash.fingerprints(odd).selectExpr("*", "1 as part", "2 as own", "'x' as hi", "3 as least", "4 as copies")
    got = op10_simhash.with_neighbours(clash)
    assert got.columns == [*clash.columns, "n_within", "least_within"]
    assert found(got) == all_pairs([(r.doc_id, r.fingerprint) for r in clash.collect()], 3)
