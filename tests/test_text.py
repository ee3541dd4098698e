"""Citations, text quality, fingerprints: literal cases and properties."""

import hashlib
import itertools
import re

import pytest
from pyspark.sql import functions as F

from docketspark.functions import citations as cite
from docketspark.functions import fingerprint as fp
from docketspark.functions.regexes import result_group
from docketspark.operators import citations, dedup
from docketspark.operators.textquality import text_quality


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_extract_by_type(spark):
    text = "Under Article 14 and Section 302 (a), see 2023 SC 445 and 2022 HC 112; 2023 SC 445 again. Order III Rule 5."
    assert one(spark, text, cite.extract) == {
        "case_citation": ["2022 HC 112", "2023 SC 445"], "statute_section": ["Section 302 (a)"], "article": ["Article 14"], "order_rule": ["Order III Rule 5"],
    }
    assert one(spark, "nothing", cite.extract) == {} and one(spark, None, cite.extract) == {}
    assert one(spark, "Section  302 section 302 Section 302", cite.extract_all) == ["Section  302", "Section 302", "section 302"]


def test_custom_patterns_override_and_add(spark):
    found = one(spark, "Article 9a and § 12", lambda c: cite.extract(c, {"article": r"Article \d+", "para": r"§ (\d+)"}))
    assert found == {"article": ["Article 9"], "para": ["12"]}
    with pytest.raises(ValueError):
        result_group(r"(\d+) (\w+)")


def test_most_cited_counts_documents_and_breaks_ties_by_text(spark):
    rows = [("a", "2001 SC 1 2001 SC 1"), ("b", "2001 SC 1 and 2002 SC 2"), ("c", "2000 SC 9"), ("d", None), ("e", "")]
    cases = spark.createDataFrame(rows, "id string, text string")
    assert [tuple(r) for r in citations.most_cited(cases).collect()] == [("2001 SC 1", 2), ("2000 SC 9", 1), ("2002 SC 2", 1)]
    total = citations.citation_summary(cases).first()
    assert (total.cases_analyzed, total.cases_with_citations, total.total_citations, total.unique_citations, total.avg_per_case) == (5, 3, 4, 3, 0.8)
    empty = citations.citation_summary(cases.limit(0)).first()
    assert (empty.cases_analyzed, empty.total_citations, empty.avg_per_case) == (0, 0, 0.0)


def test_text_quality(spark):
    good = "The court considered the appeal and gave its reasons in full. " * 50
    texts = {"empty": "", "null": None, "good": good, "short": "Too short.", "html": "<div class='x'>a</div> " * 10, "space": "a" + " " * 20 + "b", "dots": good + "... \n", "boiler": "Click here. All rights reserved. Disclaimer. " * 5, "misread": good + "œ"}
    rows = {r.id: r for r in text_quality(spark.createDataFrame(list(texts.items()), "id string, text string")).collect()}
    assert rows["empty"].is_empty and rows["null"].is_empty and rows["empty"].quality_score == 0 and rows["null"].word_count is None
    assert rows["good"].quality_score == 1.0 and rows["good"].sentence_count == 50 and rows["good"].artifact_count == 0
    assert rows["short"].truncated and rows["short"].quality_score == 0.45
    assert rows["html"].html_tags and rows["space"].excessive_whitespace and rows["dots"].truncated and rows["boiler"].boilerplate_heavy
    assert rows["misread"].encoding_errors and rows["misread"].quality_score == 0.85
    for name, text in texts.items():
        if text:
            assert rows[name].word_count == len(text.split())
            assert rows[name].sentence_count == sum(bool(s.strip()) for s in re.split(r"[.!?]+", text))


def plain_simhash(text, bits, n=3):
    if not text:
        return 0
    grams = [text[i : i + n] for i in range(len(text) - n + 1)] or [text]
    votes = [0] * bits
    for g in grams:
        value = int(hashlib.md5(g.encode()).hexdigest(), 16) % (1 << bits)
        for b in range(bits):
            votes[b] += 1 if value >> b & 1 else -1
    return sum(1 << b for b in range(bits) if votes[b] > 0)


def test_simhash_is_that_of_the_definition(spark):
    texts = ["the court held that the appeal fails", "ab", "", "été à la cour", "x" * 300]
    for bits in (64, 128):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fp.simhash(F.col("t"), bits).alias("f"))
        rows = {r.t: r.f for r in df.select("t", fp.hexadecimal(F.col("f.hi"), F.col("f.lo"), bits).alias("f")).collect()}
        assert {t: int(v, 16) for t, v in rows.items()} == {t: plain_simhash(t, bits) for t in texts}
    with pytest.raises(ValueError):
        fp.checked(32, 3)
    with pytest.raises(ValueError):
        fp.checked(128, 0)


def test_normalisation_order(spark):
    assert one(spark, "A - B", fp.normalised) == "a  b"
    assert one(spark, "  Été,\n\tOK!  ", fp.normalised) == "été ok" and one(spark, None, fp.normalised) == ""


def prints_of(spark, texts, **kw):
    return dedup.fingerprints(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), **kw)


BASE = "the petitioner filed an appeal against the order of the high court dated 12 march and it was heard at length "


def test_similarity_of_pairs(spark):
    p = prints_of(spark, [BASE * 3, BASE.replace("appeal", "apeal") * 3, "income tax is levied upon residents of the state by statute " * 4, BASE.upper() * 3, "", ""])
    like = {(r.a, r.b): r.s for r in p.alias("x").join(p.alias("y"), F.col("x.id") < F.col("y.id")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), fp.similarity(F.col("x.hi"), F.col("x.lo"), F.col("y.hi"), F.col("y.lo")).alias("s")).collect()}
    assert like["0", "1"] > 0.7 and like["0", "2"] < 0.9 and like["0", "3"] == 1.0 and like["4", "5"] == 1.0 and like["0", "4"] == 0.0


def test_near_pairs_are_all_pairs_of_representatives(spark):
    texts = [BASE * 2 + f"word{k} " * (k % 5) + "tail " * (k % 3) for k in range(24)] + ["other text entirely " * 9, "", "", None]
    for bits in (64, 128):
        p = prints_of(spark, texts, bits=bits).cache()
        reps = {}
        for r in p.collect():
            if r.sha not in reps or r.id < reps[r.sha].id:
                reps[r.sha] = r
        value = {r.id: (r.hi % (1 << 64)) << 64 | r.lo % (1 << 64) for r in reps.values()}
        for threshold in (0.5, 0.85, 0.95, 1.0):
            want = {(a, b) for a, b in itertools.combinations(sorted(value), 2) if value[a] and value[b] and 1 - (value[a] ^ value[b]).bit_count() / bits >= threshold}
            got = [(r.id_a, r.id_b) for r in dedup.near_pairs(p, threshold, bits).collect()]
            assert len(got) == len(set(got)) and set(got) == want
        p.unpersist()
    assert dedup.most_distance(0.85, 128) == 19 and dedup.most_distance(0.95, 128) == 6 and dedup.most_distance(0.85, 64) == 9


def test_members_similar_and_stats(spark):
    p = prints_of(spark, ["same text here"] * 4 + ["another one", "", None])
    assert sorted(map(tuple, dedup.members(p).collect())) == [*((str(k), "0", "exact_hash") for k in range(4)), ("5", "5", "simhash"), ("6", "5", "simhash")]
    top = dedup.find_similar(p, "0", 2).collect()
    assert [(r.id, r.similarity) for r in top] == [("1", 1.0), ("2", 1.0)]
    with pytest.raises(KeyError):
        dedup.find_similar(p, "99")
    assert tuple(dedup.dedup_stats(p).first()) == (7, 1, 0.85, 128)
    found = dedup.rendered(dedup.find_duplicates(spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (None, "a b c d"), ("", "x")], "id string, text string")))
    assert [r.line for r in found.collect()] == ["1 <-> 2 (100.0% similar, exact_hash)"]
