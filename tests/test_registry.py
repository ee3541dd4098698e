"""Registered queries: each runs, and those with an oracle equal DuckDB's rows."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from docketspark.plans import registry


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{sf_dir}/{name}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.ORACLES:
        assert got
        return
    want = oracle.sql(registry.ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
