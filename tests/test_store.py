"""Store, connectors, resume, resilience, streaming, command line."""

import json

import pytest
from pyspark.sql import functions as F

from docketspark import cli
from docketspark.functions import resilience as rs
from docketspark.operators import breaker
from docketspark.sources import connectors, store
from docketspark.sources.files import CASE_TYPE, read_jsonl
from docketspark.streaming.breaker import replay_stream
from docketspark.streaming.ingest import ingest

ROWS = [("case_001", "Smith v. Jones", 2024), ("case_002", "Müller gegen Staat", 2023), ("case_003", "No year", None), ("", "No id", 2024), (None, "No id", 2024)]


def rows(spark, data=ROWS):
    return spark.createDataFrame(data, "id string, title string, year int")


def test_store(spark, tmp_path):
    s = store.CaseStore(spark, str(tmp_path / "s"))
    assert s.cases() is None and s.load("x") is None and s.stats() == {"total_cases": 0, "years": 0, "tracked": 0}
    s.save(rows(spark))
    s.save(rows(spark, [("case_001", "Smith v. Jones (corrected)", 2024), ("case_004", "New", 2023)]))
    assert s.stats() == {"total_cases": 4, "years": 3, "tracked": 4}
    assert s.load("case_001").first().title == "Smith v. Jones (corrected)" and s.load("none").first() is None
    assert s.is_fetched("case_004") and not s.is_fetched("case_9")
    lines = read_jsonl(spark, str(tmp_path / "s" / "jsonl"))
    assert {r.year_key for r in lines.select("year_key").distinct().collect()} == {"2024", "2023", "unknown"}
    assert lines.where("id = 'case_002'").first().title == "Müller gegen Staat"
    assert [r.id for r in store.next_batch(rows(spark, [("b", "", 1), ("case_001", "", 1), ("a", "", 1)]), s.ledger(), 1).collect()] == ["a"]
    assert store.next_batch(rows(spark), s.ledger(), 0).count() == 2
    with pytest.raises(ValueError):
        store.CaseStore(spark, "x", "csv")


def test_connectors(spark):
    found = connectors.enumerate_years(spark, "sample", 2022, 2024)
    assert found.count() == 30 and found.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, connectors.listed_years(spark, 2022, 2024).collect()))
    detailed = connectors.enumerate_years(spark, "sample", 2024, 2024, detail=True)
    assert detailed.where("length(text) > 100").count() == 10
    with pytest.raises(ValueError):
        connectors.connector("missing")
    bare = connectors.Connector()
    with pytest.raises(NotImplementedError):
        bare.enumerate_by_year(2024)
    assert bare.courts() == [] and connectors.connector("sample").courts()


def test_backoff(spark):
    policy = rs.RetryPolicy(5, 2.0, 2.0, 15.0, 0.0)
    assert [policy.delay(k) for k in range(6)] == [0, 2, 4, 8, 15, 15]
    assert [rs.RetryPolicy(4, 1.0, 3.0, 60.0, 0.0).delay(k) for k in (1, 2, 3)] == [1, 3, 9]
    assert rs.RetryPolicy(jitter=0.5).delay(1, lambda: 0.5) == 1.25
    assert [r.delay for r in rs.schedule(spark, 5, policy).orderBy("attempt").collect()] == [policy.delay(k) for k in range(6)]
    for bad in ({"max_attempts": 0}, {"base_delay": -1}, {"max_delay": 0.5}, {"multiplier": 0.5}):
        with pytest.raises(ValueError):
            rs.RetryPolicy(**bad)


def test_retry_and_breaker():
    waits, calls, now = [], [], [0.0]

    def flaky(fail):
        calls.append(1)
        if len(calls) <= fail:
            raise ConnectionError("no")
        return "ok"

    policy = rs.RetryPolicy(3, 2.0, 2.0, 60.0, 0.0, (ConnectionError,))
    assert rs.with_retry(policy, sleep=waits.append)(flaky)(2) == "ok" and waits == [2.0, 4.0]
    calls.clear()
    with pytest.raises(rs.RetryExhausted) as gone:
        rs.with_retry(policy, sleep=waits.append)(flaky)(9)
    assert gone.value.attempts == 3
    assert rs.with_retry(policy, sleep=waits.append, raises=False)(lambda: flaky(99)) () is None

    def wrong():
        raise KeyError("x")

    with pytest.raises(KeyError):
        rs.with_retry(policy, sleep=waits.append)(wrong)()
    b = rs.Breaker(2, 60.0, clock=lambda: now[0], expected=(ConnectionError,))
    for _ in range(2):
        with pytest.raises(ConnectionError):
            b.call(flaky, 10**6)
    assert b.state == rs.OPEN
    with pytest.raises(rs.CircuitOpenError):
        rs.with_retry(policy, b, sleep=waits.append)(flaky)(0)
    now[0] = 61.0
    assert b.state == rs.HALF_OPEN and b.call(lambda: 5) == 5 and b.state == rs.CLOSED
    b.trip()
    now[0] = 130.0
    with pytest.raises(ConnectionError):
        b.call(flaky, 10**6)
    assert b.state == rs.OPEN
    b.reset()
    with pytest.raises(KeyError):
        b.call(wrong)
    assert b.state == rs.CLOSED and b.failures == 0


EVENTS = [(1, 0, True), (1, 10, True), (1, 20, False), (1, 80, True), (1, 150, False), (1, 160, True), (2, 5, True), (2, 6, False), (2, 7, True)]
WANT = {
    1: [("closed", "closed", 1), ("closed", "open", 2), ("open", "open", 2), ("half_open", "open", 3), ("half_open", "closed", 0), ("closed", "closed", 1)],
    2: [("closed", "closed", 1), ("closed", "closed", 0), ("closed", "closed", 1)],
}


def events(spark):
    data = [(k, n, t, bad) for n, (k, t, bad) in enumerate(EVENTS)]
    return spark.createDataFrame(data, "k long, n long, t long, bad boolean").withColumn("ts", F.timestamp_seconds("t"))


def test_replay(spark):
    found = breaker.replay(events(spark).repartition(3), "k", "ts", F.col("bad"), "n", threshold=2, recovery=60.0).orderBy("key", "event").collect()
    assert {k: [(r.met, r.state, r.failures) for r in found if r.key == k] for k in WANT} == WANT
    assert breaker.replay(events(spark).limit(0), "k", "ts", F.col("bad"), "n").count() == 0


def test_replay_as_a_stream(spark, tmp_path):
    for part, where in enumerate(("n < 3", "n >= 3 and n < 7", "n >= 7")):
        events(spark).where(where).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema(events(spark).schema).parquet(str(tmp_path / "in"))
        out = replay_stream(arriving, "k", "ts", F.col("bad"), "n", threshold=2, recovery=60.0)
        query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None, part
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("key", "event").collect()
    assert {k: [(r.met, r.state, r.failures) for r in found if r.key == k] for k in WANT} == WANT


def test_ingest_resumes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    for k in range(2):
        line = json.dumps({f: None for f in CASE_TYPE.names} | {"id": f"c{k}", "year": 2000 + k, "title": "t"})
        (tmp_path / "in" / f"{k}.json").write_text(line + "\n")
        ingest(spark, str(tmp_path / "in"), s, str(tmp_path / "c")).awaitTermination(120)
        assert s.stats()["tracked"] == k + 1
    assert spark.read.parquet(str(tmp_path / "s" / "versions")).count() == 2


def test_command_line(spark, tmp_path, capsys):
    run = lambda *a: cli.main(["--store", str(tmp_path / "s"), *a], spark)
    said = lambda: capsys.readouterr().out
    assert run("analyze", "stats") == 0 and "No cases found" in said()
    run("fetch", "--year", "2024", "--limit", "3")
    assert json.loads(said())["tracked"] == 3
    run("fetch", "--id", "case_2023_004")
    said()
    run("status")
    assert json.loads(said())["total_cases"] == 4
    run("search", "appeal", "--limit", "1", "--output", str(tmp_path / "hits"))
    assert len(json.loads(said())) == 1 and spark.read.json(str(tmp_path / "hits")).count() == 2
    run("enumerate", "--year", "2021")
    assert len(json.loads(said())) == 10
    run("analyze", "citations")
    assert json.loads(said())["cases_analyzed"] == 4
    run("report", "--output", str(tmp_path / "r.json"))
    assert "cases 4" in said() and (tmp_path / "r.json").exists()
    run("dedup", "--threshold", "0.9")
    assert isinstance(json.loads(said()), list)
