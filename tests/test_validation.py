"""Validation, reports, statistics."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketspark.operators import report, stats
from docketspark.operators.validate import issue_rows, validate
from docketspark.plans.schema import CASE_SCHEMA, FieldSpec, with_field, without_field
from docketspark.sources.files import CASE_TYPE, read_dynamic, read_json

FULL = {
    "id": "case_001", "title": "Smith v. Jones", "citation": "2023 SC 445", "court": "Supreme Court", "date": "2023-05-01",
    "year": 2023, "judges": ["A", "B"], "text": "word " * 300, "headnotes": "Held.", "statutes_cited": ["Act 1"], "_scraped_at": None,
}


def frame(spark, *rows):
    return spark.createDataFrame([tuple({**dict.fromkeys(FULL), **r}[f] for f in CASE_TYPE.names) for r in rows], CASE_TYPE)


def test_whole_case_is_valid(spark):
    r = validate(frame(spark, FULL)).first()
    assert r.valid and r.issues == [] and 0.94 < r.completeness_score <= 1
    assert set(r.field_scores) == {s.name for s in CASE_SCHEMA} and r.field_scores["id"] == 0.9


def test_cascade(spark):
    rows = [
        {"id": "m", "title": "Small case", "text": "x" * 120},
        {"id": "", "title": "Ab", "text": "Short", "citation": "no-digits-here", "date": "15th March"},
        {"text": "y" * 2000},
    ]
    got = {r.case_id: r for r in validate(frame(spark, *rows)).collect()}
    assert got["m"].valid and 0.3 < got["m"].completeness_score < 0.9
    issues = {(i.field, i.severity): (i.message, i.value) for i in got[""].issues}
    assert not got[""].valid
    assert issues["id", "error"][0] == "Too short: 0 chars (min: 1)" and issues["title", "error"][0] == "Too short: 2 chars (min: 5)"
    assert issues["text", "error"][0] == "Too short: 5 chars (min: 100)" and issues["citation", "warning"] == ("Does not match expected pattern", "no-digits-here")
    assert got[""].field_scores["text"] == 0.05 and got[""].field_scores["title"] == 0.4 and got[""].field_scores["date"] == 0.7
    assert {i.field for i in got["<unknown>"].issues} == {"id", "title"} and got["<unknown>"].field_scores["text"] == 1.0


def test_longest_length_check_and_weights(spark):
    schema = with_field(without_field(CASE_SCHEMA, "court"), FieldSpec("court", max_length=5, weight=3.0))
    r = validate(frame(spark, FULL), schema).first()
    assert r.field_scores["court"] == 0.9 and r.issues[0].message == "Too long: 13 chars (max: 5)"
    checked = (FieldSpec("title", check=lambda c: F.when(c.contains("v."), F.lit("has a v."))),)
    r = validate(frame(spark, FULL).select("id", "title"), checked).first()
    assert r.field_scores == {"title": 0.8} and r.issues[0].message == "has a v." and r.valid
    assert validate(frame(spark, FULL), ()).first().completeness_score == 0.0


def test_wrong_kind_and_strict(spark):
    cases = frame(spark, FULL).withColumn("judges", F.lit(12345))
    for strict, severity in ((False, "warning"), (True, "error")):
        r = validate(cases, strict=strict).first()
        assert r.field_scores["judges"] == 0.2 and r.valid is not strict
        assert [(i.severity, i.message) for i in r.issues] == [(severity, "Expected type list or str, got int")]


def test_dynamic_documents(spark, tmp_path):
    docs = [{**FULL, "year": "2023", "custom_field": 1, "_note": 2}, {**FULL, "id": "b", "judges": 7, "year": True}, {**FULL, "id": "c", "year": 2.5, "text": None}]
    for k, d in enumerate(docs):
        (tmp_path / f"{k}.json").write_text(json.dumps(d))
    (tmp_path / "bad.json").write_text("{invalid json content")
    (tmp_path / "list.json").write_text("[1, 2]")
    rows = {r.case_id: r for r in validate(read_dynamic(spark, str(tmp_path)), raw="_raw").collect()}
    assert set(rows) == {"case_001", "b", "c"}
    assert [(i.field, i.severity) for i in rows["case_001"].issues] == [("custom_field", "info")] and rows["case_001"].valid
    assert [(i.field, i.severity) for i in rows["b"].issues] == [("judges", "warning")]
    assert {(i.field, i.message) for i in rows["c"].issues} == {("year", "Expected type int or str, got float"), ("text", "Required field is missing")}


def test_json_folder_strict_and_tolerant(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": "a", "year": 2020}, indent=1))
    assert [r.id for r in read_json(spark, str(tmp_path)).collect()] == ["a"]
    (tmp_path / "bad.json").write_text("{invalid json content")
    assert [r.id for r in read_json(spark, str(tmp_path), tolerant=True).collect()] == ["a"]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json(spark, str(tmp_path)).collect()


def test_report(spark, tmp_path):
    rows = [FULL, {**FULL, "id": "2", "text": None}, {"id": "3", "title": "Small case", "text": "x" * 120}]
    found = report.report(frame(spark, *rows))
    assert (found["total_cases"], found["valid_cases"], found["invalid_cases"], found["pass_rate"]) == (3, 2, 1, 0.6667)
    assert found["severity_counts"] == {"error": 1} and found["top_issues"] == [{"field": "text", "message": "Required field is missing", "severity": "error", "count": 1}]
    assert sum(found["completeness_distribution"].values()) == 3 and list(found["completeness_distribution"]) == list(report.BUCKETS)
    report.save(found, str(tmp_path / "x" / "r.json"))
    assert json.loads((tmp_path / "x" / "r.json").read_text())["total_cases"] == 3 and "cases 3" in report.as_text(found)
    empty = report.report(frame(spark, FULL).limit(0))
    assert empty["total_cases"] == 0 and empty["pass_rate"] == 0 and empty["field_completeness"] == {}
    change = {r.metric: r.delta for r in report.compare(validate(frame(spark, *rows)), validate(frame(spark, FULL, FULL))).collect()}
    assert change["cases"] == -1 and change["pass_rate"] > 0 and change["field:text"] > 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.fixed_dictionaries({}, optional={"id": st.text(max_size=4), "title": st.text(max_size=12), "citation": st.text(max_size=8), "text": st.text(max_size=150), "year": st.integers(0, 3000)}), max_size=8))
def test_scores_are_bounded_and_issues_decide(spark, rows):
    clean = [{k: v.encode("utf-8", "ignore").decode() if isinstance(v, str) else v for k, v in r.items()} for r in rows]
    validated = validate(frame(spark, *clean)) if clean else validate(frame(spark, FULL).limit(0))
    found = validated.collect()
    for r in found:
        assert 0 <= r.completeness_score <= 1 and all(0 <= s <= 1 for s in r.field_scores.values())
        assert r.valid == (not any(i.severity == "error" for i in r.issues)) and len({i.field for i in r.issues}) == len(r.issues)
    assert sum(r.n for r in report.completeness_distribution(validated).collect()) == len(found)
    assert issue_rows(validated).count() == sum(len(r.issues) for r in found)


def test_statistics(spark):
    rows = [{"id": str(k), "court": c, "year": y, "text": t, "judges": j} for k, (c, y, t, j) in enumerate([("A", 2000, "xx", ["p", "q"]), ("A", 2001, "xxx", ["p"]), (None, None, "", None), ("B", 2001, None, [])])]
    found = stats.corpus_stats(frame(spark, *rows))
    assert found["courts"] == {"A": 2, "B": 1, "Unknown": 1} and found["years"] == {"2000": 1, "2001": 2, "Unknown": 1}
    assert found["text_stats"] == {"avg_length": 2, "max_length": 3, "min_length": 2, "cases_with_text": 2} and found["top_judges"] == {"p": 2, "q": 1}
    assert stats.corpus_stats(frame(spark, FULL).limit(0)) == {"error": "No cases found"}
    both = stats.compare_periods(frame(spark, *rows), (1999, 2000), (2001, 2002)).first()
    assert (both.total_cases_1, both.total_cases_2, both.case_count_change, both.avg_length_change) == (1, 2, 1, 1)
    none = stats.compare_periods(frame(spark, *rows), (1, 2), (3, 4)).first()
    assert (none.total_cases_1, none.avg_length_change) == (0, 0)
