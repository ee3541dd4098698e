"""Texts of megabytes among ordinary ones: each operator takes them whole."""

import hashlib

import pytest
from pyspark.sql import functions as F

from docketspark.llm import op3_quality, op6_decontamination, op7_mixing, op8_language, op9_toxicity, op10_simhash, op12_filters, op13_pii

from .conftest import prose

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
LONG = {
    900_001: prose(5, 150_000) + " " + ITEM,
    900_002: "x" * 1_000_000,
    900_003: "Der Hund und die Katze laufen über die grüne Wiese. " * 20_000,
    900_004: "mail me@there.example.org now. " * 5_000 + prose(6, 60_000),
}


@pytest.fixture(scope="module")
def mixed(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [(k, t, None, "src0") for k, t in [*LONG.items(), (900_005, LONG[900_001])]]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema)).repartition(3)


def of(df, *columns):
    return {r[0]: r[1:] for r in df.where("doc_id > 900000").select("doc_id", *columns).collect()}


def test_classifiers(mixed, labels):
    for operator in (op3_quality, op9_toxicity):
        found = of(operator.classify(mixed, labels), "score", "predicted")
        assert len(found) == 5 and all(0 <= s <= 1 for s, _ in found.values()) and found[900_001] == found[900_005]


def test_languages(mixed):
    found = of(op8_language.identify(mixed), "lang_pred", "score")
    assert len(found) == 5 and found[900_003][0] == "de" and found[900_001] == found[900_005]


def test_languages_in_slices(mixed):
    whole, sliced = (op8_language.identify(mixed, s=op8_language.Settings(slice_bytes=n)) for n in (8 << 20, 5_000))
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, sliced.collect()), key=repr)


def test_contamination(spark, mixed):
    items = spark.createDataFrame([(1, ITEM), (2, "not there at all " * 4)], "item_id long, text string")
    found = of(op6_decontamination.contamination(mixed, items), "n_words", "n_hit", "n_items")
    assert found[900_001] == found[900_005] == (len(LONG[900_001].split()), 12, 1) and found[900_003][1:] == (0, 0)
    matches = op6_decontamination.longest_matches(mixed, items).where("doc_id > 900000").collect()
    assert {(r.doc_id, r.item_id, r.doc_word, r.item_word, r.n_words) for r in matches} == {(k, "1", 150_000, 0, 12) for k in (900_001, 900_005)}


def test_mixing(mixed):
    found = of(op7_mixing.mix(mixed), "size", "taken")
    assert {k: v[0] for k, v in found.items()} == {k: len(t.split()) for k, t in [*LONG.items(), (900_005, LONG[900_001])]}
    assert all(taken <= 3 * size for size, taken in found.values())


def test_fingerprints(mixed):
    found = of(op10_simhash.with_edits(mixed), "n_chars", "edited_sha256", "fingerprint", "near_edited")
    assert found[900_001][2] == found[900_005][2] and all(0 <= v[3] <= 1 for v in found.values())
    text, following = LONG[900_002], LONG[900_003]
    cut = len(text) // 4
    assert found[900_002][:2] == (len(text), hashlib.sha256((text[:-cut] + following[:cut]).encode()).hexdigest())


def test_filters_and_spans(mixed):
    masks = of(op12_filters.masked(mixed), "mask")
    assert masks[900_005][0] == masks[900_001][0] + 16 and masks[900_002][0] == 1
    spans = of(op13_pii.digests(mixed), "n_email", "n_phone", "n_ip", "n_card")
    assert spans[900_004] == (5_000, 0, 0, 0) and spans[900_002] == (0, 0, 0, 0)
    redacted = op13_pii.redacted(mixed.where("doc_id = 900004")).select(F.regexp_count("text", F.lit(r"\[EMAIL\]"))).first()[0]
    assert redacted == 5_000
