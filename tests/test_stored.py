"""Tables stored between steps: writes at once, blocks that delete."""

import threading

import pytest

from docketspark.operators.graph import components
from docketspark.plans import stored


def test_writes_at_once_leave_the_session_as_it_was(spark):
    before = spark.conf.get(stored._CLEANUP)
    inside, seen = threading.Barrier(2, timeout=60), []

    def work(first: bool):
        with stored._shuffles_dropped(spark):
            inside.wait()
            if first:
                inside.wait()  # the other has left by then
            seen.append(spark.conf.get(stored._CLEANUP))
        if not first:
            inside.wait()

    threads = [threading.Thread(target=work, args=(k == 0,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert seen == ["true", "true"] and spark.conf.get(stored._CLEANUP) == before and not stored._open
    with pytest.raises(RuntimeError), stored._shuffles_dropped(spark):
        raise RuntimeError
    assert spark.conf.get(stored._CLEANUP) == before


def test_nested_blocks(spark):
    df = spark.range(3)
    with stored.scratch(spark):
        with stored.scratch(spark):
            inner, passed = stored.written(df, "t"), stored.written(df, "t", keep=True)
        assert passed.count() == 3
        with pytest.raises(Exception, match="(?i)not.*exist"):
            inner.count()
    with pytest.raises(Exception, match="(?i)not.*exist"):
        passed.count()


def test_components(spark):
    path = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (102, 101), (50, 50)]
    found = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 103), 100)}
