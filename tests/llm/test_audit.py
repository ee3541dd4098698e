"""The audit on negative and null ids, its plans, and the registered SQL of this subpackage."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from docketspark.llm import op5_warc
from docketspark.llm import queries as registered


def pages_of(spark, ids):
    rows = [(k, f"u{n}", f"<p>{n}</p>" * (n % 9)) for n, k in enumerate(ids)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_negative_and_null_ids(spark):
    pages = pages_of(spark, [-1, -999, -1000, -70_000, 5, 5, 70_000, *[None] * 60])
    archive = op5_warc.archived(pages)
    assert archive.where("page_id is null").select("file").distinct().count() > 20
    assert {r.file for r in archive.where("page_id in (-1, -999, -1000)").collect()} == {-1}
    assert op5_warc.audit(archive, archive).count() == 0
    rot = archive.withColumn("digest", F.when(F.coalesce(F.col("page_id") < 0, F.lit(False)), F.lit("x")).otherwise(F.col("digest")))
    assert [r.status for r in op5_warc.audit(archive, rot).collect()] == ["corrupt"] * 4


def test_deep_trees_are_planned_level_by_level(spark):
    """600 files of two records: joins of the last plan don't grow with the levels."""
    archive = op5_warc.archived(pages_of(spark, range(1200)), per_file=2)
    rot = archive.withColumn("digest", F.when(F.col("page_id") % 4 == 1, F.lit("x")).otherwise(F.col("digest")))
    found = op5_warc.audit(archive, rot)
    assert found.count() == 300 and found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_intact_replicas_read_roots_only(spark, monkeypatch):
    archive = op5_warc.archived(pages_of(spark, range(500)), per_file=50)
    read = []
    real = op5_warc._below
    monkeypatch.setattr(op5_warc, "_below", lambda *a: read.append(a) or real(*a))
    assert op5_warc.audit(archive, archive).count() == 0 and not read
    rot = archive.withColumn("digest", F.when(F.col("page_id") == 77, F.lit("x")).otherwise(F.col("digest")))
    assert op5_warc.audit(archive, rot).count() == 1 and {tuple(a[3]) for a in read if a[3] is not None} == {(1,)}


def test_a_shift_is_no_damage(spark):
    """A lost or added record leaves the others whole; damage and shifts in one file are told apart."""
    pages = pages_of(spark, [*range(200), 7, None, None])
    counts = lambda replica: {r.status: r.n for r in op5_warc.reconciled(*[op5_warc.archived(x, own=True) for x in (pages, replica)]).groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert counts(pages) == {"intact": 203}
    lost = counts(pages.where("coalesce(page_id, 0) <> 10"))
    assert lost.pop("missing") == 1 and set(lost) == {"intact", "moved"} and sum(lost.values()) == 202
    added = counts(pages.unionByName(pages.where("url in ('u0', 'u20')")))
    assert added.pop("extra") == 2 and set(added) == {"intact", "moved"} and sum(added.values()) == 203
    worse = counts(pages.where("coalesce(page_id, 0) <> 10").withColumn("html", F.when(F.col("url").isin("u3", "u150"), F.lit("rot")).otherwise(F.col("html"))))
    assert worse.pop("missing") == 1 and worse.pop("corrupt") == 2 and sum(worse.values()) == 200
    assert counts(pages.limit(0)) == {"missing": 203}


def test_long_texts_and_clashing_columns(spark):
    rows = [(1, "u", "<p>" + "é" * 200_000, "f", 9), (2, None, None, "g", 8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file string, record long")
    archive = op5_warc.archived(pages)
    assert archive.columns == ["page_id", "file", "record", "offset", "length", "digest"]
    assert {r.status for r in op5_warc.audited(archive, archive).collect()} == {"intact"}


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_registered_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from read_parquet('{sf_dir}/{file}')")
    df = registered.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = con.sql(registered.ORACLES[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
