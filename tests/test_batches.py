"""Limits of successes, budgets, resumed ingest, one case validated, folders reported."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docketspark import cli
from docketspark.operators import report
from docketspark.operators.validate import validate, validate_case
from docketspark.plans.cases_view import cases
from docketspark.sources import batches, connectors, store
from docketspark.sources.files import CASE_TYPE, read_documents, write_documents
from docketspark.streaming.ingest import ingest


def ids(spark, n):
    return spark.createDataFrame([(f"c{k:03d}",) for k in range(n)], "id string").repartition(3)


@pytest.fixture
def source(spark):
    """Every fifth id is absent; asked for is counted."""
    asked = spark.sparkContext.accumulator(0)

    def fetch(wanted):
        def run(batches_):
            for batch in batches_:
                asked.add(batch.num_rows)
                yield batch

        found = wanted.mapInArrow(run, "id string").where("cast(substr(id, 2) as int) % 5 <> 0")
        return found.select("id", F.lit("t").alias("title"), F.lit(2000).alias("year"))

    return fetch, asked


@pytest.mark.parametrize(("limit", "budget", "want"), [(None, 500, (80, 100, False)), (20, 500, (20, 25, False)), (0, 30, (24, 30, True)), (20, 10, (8, 10, True)), (500, 100, (80, 100, False)), (7, 0, (0, 0, True))])
def test_limits_and_budgets(spark, tmp_path, source, limit, budget, want):
    fetch, asked = source
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    found = batches.fetch_batch(s, ids(spark, 100), fetch, limit, budget)
    assert (found["fetched"], found["requests"], found["exhausted"]) == want and found["remaining"] == budget - want[1]
    # one by one in the order of ids, the same number of requests would have been made
    assert asked.value == found["requests"] <= budget and s.ledger().count() == want[0] and s.requests() == want[1]


def test_batches_skip_what_is_there(spark, tmp_path, source):
    fetch, _ = source
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    asked = ids(spark, 20).union(ids(spark, 4)).union(spark.createDataFrame([(None,), ("",)], "id string"))
    assert batches.fetch_batch(s, asked, fetch, 5)["fetched"] == 5
    assert batches.fetch_batch(s, asked, fetch)["fetched"] == 11
    assert batches.fetch_batch(s, asked, fetch)["fetched"] == 0
    again = batches.fetch_batch(s, ids(spark, 4), fetch, skip_existing=False)
    assert again["fetched"] == 3 and s.ledger().count() == 16
    assert batches.fetch_batch(s, ids(spark, 0), fetch) == {"fetched": 0, "requests": 0, "remaining": 500, "exhausted": False}


def test_fetching_from_the_command_line(spark, tmp_path, capsys):
    def run(*a):
        assert cli.main(["--store", str(tmp_path / "s"), *a], spark) == 0
        return json.loads(capsys.readouterr().out)

    found = run("parallel-fetch", "--year", "2023", "--to", "2024", "--limit", "12", "--workers", "3")
    assert (found["saved"], found["requests"], found["tracked"]) == (12, 12, 12)
    assert run("fetch", "--id", "case_2023_001")["saved"] == 0
    assert run("fetch", "--id", "case_2023_001", "--again")["saved"] == 1
    status = run("status")
    assert (status["requests_today"], status["remaining"], status["total_cases"]) == (13, 487, 12)
    used_up = run("fetch", "--year", "2024", "--budget", "15")
    assert (used_up["saved"], used_up["exhausted"], used_up["tracked"]) == (2, True, 14)
    with pytest.raises(ValueError, match="fetch needs"):
        cli.main(["--store", str(tmp_path / "s"), "fetch"], spark)
    assert connectors.fetched(ids(spark, 0), "sample").count() == 0


def test_ingest_leaves_repeated_and_late_lines_out(spark, tmp_path):
    (tmp_path / "in").mkdir()
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    runs = (
        [("a", "one", "10:00"), ("b", "one", "10:50"), ("a", "two", "10:05")],
        [("b", "two", "10:55"), ("c", "one", "11:30"), ("d", "late", "09:00")],
        [("c", "two", "11:40"), ("e", "one", "11:20")],
    )
    for k, lines in enumerate(runs):
        text = "".join(json.dumps({f: None for f in CASE_TYPE.names} | {"id": i, "title": t, "_scraped_at": f"2024-01-01 {at}:00"}) + "\n" for i, t, at in lines)
        (tmp_path / "in" / f"{k}.json").write_text(text)
        ingest(spark, str(tmp_path / "in"), s, str(tmp_path / "c"), late="30 minutes").awaitTermination(120)
    got = {r.id: r.title for r in s.cases().collect()}
    assert got.pop("a") in ("one", "two") and got == {"b": "one", "c": "one", "e": "one"}


def test_validate_one_case(spark):
    found = validate_case(spark, {"id": "1", "title": "A title", "text": "x" * 120, "year": "2020", "judges": ["A"]})
    assert found["case_id"] == "1" and found["valid"] and found["error_count"] == 0 and 0 < found["completeness_score"] < 1
    bad = validate_case(spark, {"title": 5, "text": None})
    assert not bad["valid"] and bad["error_count"] >= 2 and {i["field"] for i in bad["issues"]} >= {"id", "title", "text"}


def test_report_of_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"id": str(k), "title": "A title", "text": "x" * (90 + 10 * k)}))
    (tmp_path / "in" / "bad.json").write_text("{broken")
    out = tmp_path / "deep" / "er" / "report.json"
    found = report.report_folder(spark, str(tmp_path / "in"), str(out))
    assert (found["total_cases"], found["valid_cases"]) == (3, 2) and json.loads(out.read_text())["pass_rate"] == found["pass_rate"]
    assert "cases 3" in report.as_text(found)


def test_partial_reports_merge(spark, sf_dir):
    """Any cut into batches, merged in any order, gives the report of all; an empty batch adds nothing."""
    checked = validate(cases(spark, sf_dir)).cache()
    parts = [report.partial(checked.where(f"pmod(hash(case_id), 3) = {k}")) for k in range(4)]
    whole = report.merged(parts[2].unionByName(report.merged(parts[0].unionByName(parts[3]))).unionByName(parts[1]))
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, report.partial(checked).collect()), key=repr)
    one, two = report.summary_of(whole).first(), report.summary(checked).first()
    assert one.total_cases == two.total_cases and one.valid_cases == two.valid_cases and one.avg_completeness == pytest.approx(two.avg_completeness)
    buckets = {r.field: r.n for r in whole.where("kind = 'bucket'").collect()}
    assert buckets == {r.bucket: r.n for r in report.completeness_distribution(checked).where("n > 0").collect()}
    none = report.partial(checked.limit(0))
    assert none.count() == 0 and report.summary_of(none).first().total_cases == 0 and report.top_issues_of(none).count() == 0
    checked.unpersist()


def test_documents_by_id(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.createDataFrame([("a/1", "A", 1), ("b:2", "B", 2), ("c", "Größe", 3), (None, "x", 4), ("", "y", 5)], "id string, title string, year int")
    write_documents(rows, path)
    assert sorted(map(tuple, read_documents(spark, path).select("id", "title", "year").collect())) == [("a/1", "A", 1), ("b:2", "B", 2), ("c", "Größe", 3)]
    write_documents(rows.where("id = 'c'").withColumn("title", F.lit("new")), path)
    with pytest.raises(Exception, match="broken"):
        write_documents(rows.withColumn("title", F.when(F.col("id") == "b:2", F.raise_error(F.lit("broken"))).otherwise(F.lit("bad"))), path)
    kept = {r.id: r.title for r in read_documents(spark, path).collect()}
    assert kept == {"a/1": "A", "b:2": "B", "c": "new"}


def test_documents_are_written_by_many_tasks(spark, tmp_path):
    """Small documents are many files all the same: AQE must not leave them to one task."""
    rows = spark.range(64).selectExpr("concat('a/', id) as id", "'x' as title", "cast(id as int) as year")
    write_documents(rows, str(tmp_path / "d"))
    tasks = Counter(f.name.split("-")[1] for f in (tmp_path / "d").rglob("part-*.json"))
    assert sum(tasks.values()) == 64 and len(tasks) >= 4 and max(tasks.values()) <= 32


def test_conditions_on_the_year_are_pushed(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    listed = connectors.enumerate_years(spark, "orders", 1990, 2004, path=path)
    assert listed.rdd.getNumPartitions() == 15
    for where, years in (("year between 1996 and 1997", 2), ("year > 2000 and year < 2004", 3), ("year in (1995, 2001, 3000)", 2), ("year = 1999 and id like '1%'", 1), ("year is not null and year <= 1991", 2), ("year <> 1999", 15)):
        assert listed.where(where).rdd.getNumPartitions() == years, where
    orders = spark.read.parquet(path).selectExpr("cast(o_orderkey as string) as id", "o_orderpriority as title", "year(o_orderdate) as year")
    for where in ("true", "year between 1996 and 1997", "year <> 1999 and title like '1%'", "year = 1998 or id = '4'"):
        assert sorted(map(tuple, listed.where(where).collect())) == sorted(map(tuple, orders.where(where).collect())), where
    assert next(connectors.connector("orders", path=path).enumerate_by_year(1996))[2] == 1996
    assert connectors.enumerate_years(spark, "sample", 2020, 2030).where("year = 2025").rdd.getNumPartitions() == 1
