"""What queries shuffle: texts once or not at all, and each store and batch is made once."""

import re

from pyspark.sql import functions as F

from docketspark.operators import report
from docketspark.operators.validate import validate
from docketspark.plans import registry
from docketspark.plans.cases_view import cases
from docketspark.sources import store


def shuffles(df):
    """The columns of each shuffle by a key in a physical plan."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    steps = [p for p in plan.split("\n\n") if ") Exchange\n" in p and "RoundRobin" not in p]
    assert steps
    return [re.search(r"Input \[\d+\]: \[(.*)\]", p)[1] for p in steps]


def test_texts_are_shuffled_once_at_most(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = lambda df: sum("text#" in columns for columns in shuffles(df))
        assert texts(cases(spark, sf_dir).select("id", "title", "year")) == 0
        assert texts(cases(spark, sf_dir)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_latest_shuffles_the_columns_used(spark):
    rows = [("a", "old", "long text", 1), ("a", "new", "longer text", 2), ("b", "only", None, 1)]
    versions = spark.createDataFrame(rows, "id string, title string, text string, _scraped_at int")
    newest = store.latest(versions)
    assert sorted(map(tuple, newest.collect())) == [("a", "new", "longer text", 2), ("b", "only", None, 1)]
    [wide], [narrow] = shuffles(store.latest(versions)), shuffles(newest.select("id", "title"))
    assert wide.count("value") == 3 and narrow.count("value") == 1


def test_a_store_is_filled_once(spark, sf_dir, monkeypatch):
    saves = []
    real = store.CaseStore.save
    monkeypatch.setattr(store.CaseStore, "save", lambda self, rows, batch=None, requests=0: saves.append(batch) or real(self, rows, batch, requests))
    registry.QUERIES["store_stats"](spark, sf_dir).collect()
    assert saves == ["first", "second"]


def test_partial_reports_of_batches_in_one_pass(spark, sf_dir):
    rows = cases(spark, sf_dir).withColumn("_half", F.col("id") > "D0000100")
    together = report.partial(validate(rows, keep=("_half",)), by=("_half",))
    for half in (False, True):
        alone = report.partial(validate(rows.where(F.col("_half") == half).drop("_half")))
        assert sorted(map(repr, together.where(F.col("_half") == half).drop("_half").collect())) == sorted(map(repr, alone.collect()))
