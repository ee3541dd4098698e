"""Operators that judge each row: classifiers, languages, fingerprints; held-out accuracy and brute force."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docketspark.llm import kernels, op3_quality, op8_language, op9_toxicity, op10_simhash
from docketspark.llm.common import text_bytes
from docketspark.llm.labelled import labelled_sample

from .conftest import prose

SMALL = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def held_out(found, labels, label):
    rows = found.where("held_out").join(labels, "doc_id").select(label, "score", "predicted").collect()
    good = [r.score for r in rows if r[0] == 1]
    bad = [r.score for r in rows if r[0] == 0]
    ranked = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    return ranked, np.mean([r[0] == r.predicted for r in rows])


def test_quality_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    found = op3_quality.classify(docs, labels)
    assert found.count() == docs.count()
    ranked, right = held_out(found, labels, "quality")
    assert ranked > 0.97 and right > 0.93


def test_toxicity_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    ranked, right = held_out(op9_toxicity.classify(docs, labels), labels, "toxic")
    assert ranked > 0.85 and right > 0.9
    clean = op9_toxicity.without_toxic(docs, labels)
    assert clean.columns == docs.columns and 0 < clean.count() < docs.count()


def test_counterfactual_penalty_keeps_identity_terms_apart_from_the_score():
    """A term that comes with toxic labels only by chance must not decide: its swapped twin pulls it back."""
    rng = random.Random(0)
    texts = []
    for k in range(400):
        toxic = k % 2
        group = "muslims" if (rng.random() < (0.9 if toxic else 0.1)) else "christians"
        texts.append((toxic, f"{prose(k, 8)} {group} {'vile' if toxic and k % 4 == 1 else prose(k + 1, 1)}"))
    s = op9_toxicity.Settings(bits=16, least_rows=2)
    rows = lambda pairs: [(y, op9_toxicity.buckets_of(t.encode(), 16), op9_toxicity.buckets_of(op9_toxicity.swapped(t).encode(), 16)) for y, t in pairs]
    plain = [(y, a, a) for y, a, _ in rows(texts)]
    gaps = []
    for data in (plain, rows(texts)):
        weight, bias = op9_toxicity.train(data, 0.5, s)
        one, two = (op9_toxicity.buckets_of(f"the court heard {g} today".encode(), 16) for g in ("muslims", "christians"))
        gaps.append(abs(weight[one].sum() - weight[two].sum()))
    assert gaps[1] < 0.5 * gaps[0]
    assert op9_toxicity.swapped("Women and men") == "men and women" and op9_toxicity.swapped("nothing here") == "nothing here"


def test_classifiers_take_odd_rows(spark, odd, odd_labels, none):
    for op in (op3_quality, op9_toxicity):
        rows = op.classify(odd, odd_labels).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert op.classify(none, odd_labels).count() == 0
        unlabelled = op.classify(odd, odd_labels.limit(0)).collect()
        assert {r.score for r in unlabelled} == {0.5}
    assert op9_toxicity.without_toxic(odd, odd_labels.limit(0)).count() == odd.count()


def test_a_labelled_sample_is_bounded_in_rows(spark):
    texts = [(1, "b"), (1, "a"), (1, None), (2, None), (3, "c"), (None, "d")] + [(4, "e")] * 500
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in (1, 2, 3, 4, None)], "doc_id long, toxic int")
    every = labelled_sample(docs, labels, "toxic", 1, 1, 10, 7).select("doc_id", "label", "text").collect()
    assert sorted(map(tuple, every), key=repr) == [(1, 1, "a"), (2, 1, None), (3, 1, "c"), (4, 1, "e")]
    assert labelled_sample(docs, labels, "toxic", 1, 1, 2, 7).count() == 2


def test_a_fingerprint_does_not_depend_on_the_rows_beside_it():
    texts = [f"{prose(k, 30)} {prose(k + 1, 5)}" for k in range(50)]
    alone = np.concatenate([op10_simhash.simhash(*text_bytes(pa.array([t]))) for t in texts])
    many = op10_simhash.simhash(*text_bytes(pa.array(texts + ["x"] * 5000)))
    assert (many[:50] == alone).all()


def test_languages(spark, odd, none):
    docs = table(spark, "documents")
    found = op8_language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    share = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    rows = {r.doc_id: r for r in op8_language.identify(odd).collect()}
    assert all(rows[k].lang_pred == "und" and rows[k].score == 0 for k in (0, 1, 2, 12))
    assert rows[5].lang_pred in ("en", "de", "fr") and op8_language.identify(none).count() == 0
    untrained = op8_language.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untrained.collect()} == {"und"}


def test_mixed_text_is_split_into_spans(spark):
    docs = table(spark, "documents")
    long = {r.lang: r.text for r in docs.where("n_chars > 2000").select("lang", "text").collect()}
    mixed = spark.createDataFrame([(-1, " ".join(long[k][:600] for k in ("de", "fr", "en")), None)], "doc_id long, text string, lang string")
    spans = op8_language.language_spans(docs.select("doc_id", "text", "lang").unionByName(mixed)).where("doc_id = -1").orderBy("span").collect()
    big = [r.lang for r in spans if r.n_words > 20]
    assert big == ["de", "fr", "en"]


def test_viterbi_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = rng.integers(0, 8, 6)
        first = np.r_[0, np.cumsum(lengths)]
        scores = (rng.normal(size=(first[-1], 3)) * 2).astype(np.float32)
        path = op8_language.viterbi(scores, first, 2.0)
        for a, b in zip(first, first[1:], strict=False):
            value = lambda p, x=scores[a:b]: sum(x[i][k] for i, k in enumerate(p)) - 2 * sum(p != q for p, q in itertools.pairwise(p))
            if b > a:
                assert abs(value(path[a:b].tolist()) - max(map(value, itertools.product(range(3), repeat=int(b - a))))) < 1e-4


def edited(rows):
    out = {}
    rows = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in rows))
    for (known, k, text), after in zip(rows, rows[1:] + rows[:1], strict=True):
        n = len(text) // 4
        out.setdefault(k if known else None, []).append((len(text), hashlib.sha256((text[: len(text) - n] + after[2][:n]).encode()).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def test_fingerprints(documents, odd, odd_rows, none, spark):
    found = op10_simhash.with_edits(documents).collect()
    assert {r.doc_id: [(r.n_chars, r.edited_sha256)] for r in found} == edited([(r.doc_id, r.text) for r in documents.collect()])
    assert np.mean([r.near_edited > r.near_next for r in found]) > 0.97
    assert dict(map(tuple, op10_simhash.fingerprints(documents).collect())) == {r.doc_id: r.fingerprint for r in found}
    rows = {}
    for r in op10_simhash.with_edits(odd).collect():
        rows.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256))
    assert {k: sorted(v) for k, v in rows.items()} == edited([(r[0], r[1]) for r in odd_rows])
    prints = {r.doc_id: r.fingerprint for r in op10_simhash.fingerprints(odd).collect()}
    assert prints[5] == prints[6] and prints[1] == "0" * 32
    assert op10_simhash.with_edits(none).count() == 0
    one = op10_simhash.with_edits(odd.where("doc_id = 5").limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_search_finds_all_fingerprints_within_the_radius(spark):
    rng = random.Random(3)
    prints = {f"{rng.getrandbits(128):032x}" for _ in range(60)}
    for p in list(prints):
        for flips in (1, 2, 3, 4):
            value = int(p, 16)
            for bit in rng.sample(range(128), flips):
                value ^= 1 << bit
            prints.add(f"{value:032x}")
    prints = sorted(prints)
    for radius in (0, 3):
        want = {(a, b, d) for a, b in itertools.combinations(prints, 2) if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= radius}
        df = spark.createDataFrame([(p,) for p in prints * 2], "fingerprint string")
        assert set(map(tuple, op10_simhash.within_radius(df, radius).collect())) == want


def test_word_hashes_depend_on_content_alone():
    texts = ["a bb ccc", "", "ccc bb a", None, "bb"]
    raw, at = text_bytes(pa.array(texts))
    start, end, first = kernels.words(raw, at, kernels.NOT_SPACE)
    h = kernels.range_hash(kernels.prefix_sums(raw), start, end).tolist()
    assert first.tolist() == [0, 3, 3, 6, 6, 7] and h[:3] == h[3:6][::-1] and h[6] == h[1] and len(set(h)) == 3
