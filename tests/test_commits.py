"""The store's log: retries, overlapping batches, snapshots, savers at once, folded files, lookups."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from docketspark.sources import store


def rows(spark, ids, title="t"):
    return spark.createDataFrame([(i, title, 2000) for i in ids], "id string, title string, year int")


def held(s, **kw):
    return sorted((r.id, r.title) for r in s.cases(**kw).collect())


def known(s, **kw):
    return sorted((r.id, r.batch) for r in s.ledger(**kw).collect())


@pytest.mark.parametrize("shape", store.FORMATS)
def test_a_retry_with_fewer_rows_leaves_what_other_batches_hold(spark, tmp_path, shape):
    s = store.CaseStore(spark, str(tmp_path / "s"), shape)
    s.save(rows(spark, "12"), "first")
    s.save(rows(spark, "1"), "second")
    s.save(rows(spark, "2"), "first")
    assert known(s) == [("1", "second"), ("2", "first")]
    if shape != "jsonl":
        assert [i for i, _ in held(s)] == ["1", "2"] and s.is_fetched("1")
    s.save(rows(spark, ""), "second")
    assert known(s) == [("2", "first")] and not s.is_fetched("1")


def test_first_saved_outlives_a_retry(spark, tmp_path):
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    s.save(rows(spark, "12"), "first")
    before = {r.id: r.first_saved_at for r in s.ledger().collect()}
    s.save(rows(spark, "12", "again"), "first")
    assert {r.id: r.first_saved_at for r in s.ledger().collect()} == before
    assert held(s) == [("1", "again"), ("2", "again")]


def test_snapshots(spark, tmp_path):
    s = store.CaseStore(spark, str(tmp_path / "s"))
    assert s.cases() is None and s.ledger().count() == 0 and s.log.last() == 0
    one, two = s.save(rows(spark, "12", "old"), "a"), s.save(rows(spark, "2", "new"), "b")
    early = s.cases(as_of=one)
    s.save(rows(spark, "3"), "a")
    assert (one, two) == (1, 2) and held(s, as_of=0 + one) == [("1", "old"), ("2", "old")]
    assert held(s, as_of=two) == [("1", "old"), ("2", "new")] and held(s) == [("2", "new"), ("3", "t")]
    assert sorted(r.id for r in early.collect()) == ["1", "2"]  # a snapshot stays readable
    assert known(s, as_of=one) == [("1", "a"), ("2", "a")] and s.cases(as_of=0) is None
    with pytest.raises(ValueError, match="no commit 9"):
        s.cases(as_of=9)


def test_two_savers_at_once(spark, tmp_path):
    stores = [store.CaseStore(spark, str(tmp_path / "s"), "table") for _ in range(2)]
    failed = []

    def work(k):
        try:
            for n in range(4):
                stores[k].save(rows(spark, [f"{k}-{n}", "both"], f"{k}-{n}"), f"{k}-{n}")
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and stores[0].log.last() == 8
    assert sorted(r.id for r in stores[1].cases().collect()) == sorted(["both", *(f"{k}-{n}" for k in range(2) for n in range(4))])
    assert stores[0].ledger().count() == 9


def test_a_number_is_taken_once(spark, tmp_path):
    log = store.CommitLog(spark, str(tmp_path / "log"))
    assert log._created(1, '{"k": 1}') and not log._created(1, '{"k": 2}')
    assert log.read(1) == {"k": 1} and log.append(lambda n: {"k": n}) == 2
    assert sorted(os.listdir(tmp_path / "log")) == sorted(f for f in os.listdir(tmp_path / "log") if "draft" not in f)


def test_a_failed_save_changes_nothing(spark, tmp_path):
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    s.save(rows(spark, "12"), "a")
    broken = rows(spark, "345").withColumn("title", F.when(F.col("id") == "4", F.raise_error(F.lit("no"))).otherwise(F.col("title")))
    with pytest.raises(Exception, match="no"):
        s.save(broken, "a")
    assert held(s) == [("1", "t"), ("2", "t")] and s.log.last() == 1


def test_compaction(spark, tmp_path):
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    assert s.compact() == 0
    s.save(rows(spark, "12", "old"), "a")
    s.save(rows(spark, "23", "new"), "b")
    before, ledger = held(s), known(s)
    number = s.compact(files=2)
    assert held(s) == before and known(s) == ledger and held(s, as_of=number - 1) == before
    s.save(rows(spark, "3", "newer"), "b")  # sealed: adds a version, takes nothing back
    assert held(s) == [("1", "old"), ("2", "new"), ("3", "newer")] and [i for i, _ in known(s)] == ["1", "2", "3"]
    s.compact(files=1)
    assert held(s) == [("1", "old"), ("2", "new"), ("3", "newer")]
    # versions and ids of three batches, what was folded first and its ledger
    assert s.vacuum(s.log.last()) == 8 and held(s) == [("1", "old"), ("2", "new"), ("3", "newer")] and known(s) == [("1", "a"), ("2", "a"), ("3", "b")]


def test_compaction_keeps_first_times_and_requests(spark, tmp_path):
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    s.save(rows(spark, "12"), "a", requests=3)
    before = {r.id: r.first_saved_at for r in s.ledger().collect()}
    s.compact()
    s.save(rows(spark, "24"), "b", requests=4)
    s.save(rows(spark, "4"), "b", requests=5)
    after = {r.id: r.first_saved_at for r in s.ledger().collect()}
    assert {k: after[k] for k in before} == before and known(s) == [("1", "a"), ("2", "a"), ("4", "b")]
    s.compact()
    assert s.requests() == 12 and known(s) == [("1", "a"), ("2", "a"), ("4", "b")] and s.log.upto()[0]["since"] == []


def test_compaction_beside_a_save(spark, tmp_path):
    """A batch committed while files are folded stays; one that was folded and saved again makes the folding fail."""
    s, other = (store.CaseStore(spark, str(tmp_path / "s"), "table") for _ in range(2))
    s.save(rows(spark, "12", "old"), "a")
    real = s.log.append

    def after(save):
        def append(make):
            s.log.append = real
            save()
            return real(make)

        return append

    s.log.append = after(lambda: other.save(rows(spark, "3"), "b"))
    s.compact()
    assert held(s) == [("1", "old"), ("2", "old"), ("3", "t")]
    s.log.append = after(lambda: other.save(rows(spark, "4"), "b"))
    with pytest.raises(RuntimeError, match="meanwhile"):
        s.compact()
    assert held(s) == [("1", "old"), ("2", "old"), ("4", "t")]


def scanned(df):
    """Rows that the Parquet scans of an executed plan gave on."""

    def leaves(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            return leaves(plan.executedPlan())
        if "QueryStage" in plan.nodeName():
            return leaves(plan.plan())
        below = [plan.children().apply(k) for k in range(plan.children().size())]
        return [x for p in below for x in leaves(p)] if below else [plan]

    return sum(p.metrics().apply("numOutputRows").value() for p in leaves(df._jdf.queryExecution().executedPlan()) if "Scan" in p.nodeName())


def test_lookups_read_few_row_groups(spark, tmp_path):
    s = store.CaseStore(spark, str(tmp_path / "s"), "table")
    every = spark.range(20_000).select(F.format_string("c%06d", F.col("id") * 2).alias("id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("title"), F.lit(2000).alias("year"))
    s.save(every, "all")
    s.compact(files=4, row_group_bytes=100_000)
    one = s.load("c002000")
    assert one.count() == 1
    one = s.load("c002000")
    assert len(one.collect()) == 1 and scanned(one) <= 1_000
    absent = s.load("c002001")  # between two ids: only the Bloom filter knows
    assert absent.collect() == [] and scanned(absent) <= 100
    some = [f"c{k:06d}" for k in range(0, 40_000, 4_000)]
    ten = s.load_all(some)
    assert sorted(r.id for r in ten.collect()) == some and scanned(ten) <= 10_000
    assert s.load_all([]).count() == 0
