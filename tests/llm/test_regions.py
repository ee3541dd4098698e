"""The Jaccard join's recursion into cells and blocks, and tables in the shared folder."""

import random

import numpy as np
import pytest

import corpus_pipeline
from docketspark.llm import common, op4_suffix
from docketspark.llm import op2_jaccard as op
from docketspark.plans import stored

from .conftest import prose
from .test_pairs import brute, result


def copies(seed, sizes, each, edits):
    rng, rows = random.Random(seed), []
    for size in sizes:
        base = prose(size, size).split()
        for _ in range(each):
            w = list(base)
            for _ in range(rng.randint(0, edits(size))):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    return rows


def test_regions_cut_by_pivots_are_exact(spark):
    rows = copies(4, (9, 33, 60, 150), 40, lambda n: 1 + n // 20)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(op.jaccard_join(df, 4, 85, most_sets=5)) == brute(rows, 4, 85)
    assert result(op.jaccard_join(df, 2, 70, most_shingles=600)) == brute(rows, 2, 70)


@pytest.mark.parametrize("percent", [30, 60, 100])
def test_every_threshold_is_exact(spark, percent):
    rows = copies(5, (2, 5, 8, 40), 15, lambda n: 1 + n // 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert result(op.jaccard_join(df, 1, percent, most_sets=9 if percent == 60 else op.REGION_SETS)) == brute(rows, 1, percent)


def test_thresholds_out_of_range(none):
    for words, percent in ((0, 80), (4, 0), (4, 101)):
        with pytest.raises(ValueError):
            op.jaccard_join(none, words, percent)


def test_signatures_stay_few_at_low_thresholds():
    hashes = np.sort(np.random.default_rng(3).integers(0, 1 << 62, 400).astype(np.uint64))
    for percent, most in ((85, 400), (70, 3000), (50, 4000)):
        assert len(op.signatures(hashes, np.array([0, 400]), percent)[0]) < most


def test_the_largest_group_is_no_region_of_one_task(spark):
    """Near copies whose distances no pivot tells apart end in blocks of few sets."""
    rows = copies(6, (80,), 120, lambda n: 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = []
    real = op._in_blocks
    op._in_blocks = lambda sized: seen.append(1) or real(sized)
    try:
        assert result(op.jaccard_join(df, 3, 85, most_sets=10)) == brute(rows, 3, 85)
    finally:
        op._in_blocks = real
    assert seen


def test_lazy_results_survive_the_pipeline(spark, sf_dir, documents):
    found = op.jaccard_join(documents)
    corpus_pipeline.run(spark, sf_dir)
    assert found.count() == documents.count()


def test_two_lazy_stage_results(spark, sf_dir, documents):
    """A stage's result stays good while other stages run, on its result or on other documents."""
    near = corpus_pipeline.without_near_duplicates(spark, documents, sf_dir)
    passages = [corpus_pipeline.without_repeats(spark, x, sf_dir) for x in (documents.limit(50), near)]
    mixed = corpus_pipeline.mixed(spark, passages[1], sf_dir)
    assert passages[0].count() == 50 and mixed.count() == passages[1].count() == near.count() < documents.count()


def test_an_operator_leaves_small_tables_only(spark, documents, tmp_path, monkeypatch):
    """Of all its tables the join keeps its rows, the dedup its spans; blocks around them delete those too."""
    monkeypatch.setattr(stored, "shared_folder", lambda _: str(tmp_path))
    with common.scratch(spark):
        assert op.one_of_each(documents).count() and op4_suffix.removals(documents).count()
        assert sorted(x.name.split("-")[0] for x in tmp_path.iterdir()) == ["keyed", "spans", "stay"]
    assert list(tmp_path.iterdir()) == []


def test_tables_of_a_block_go_at_its_end(spark):
    df = spark.range(3)
    before = common.written(df, "t")
    with common.scratch(spark):
        inside, kept = common.written(df, "t"), common.written(df, "t", keep=True)
        assert inside.count() == 3
    assert before.count() == kept.count() == 3
    with pytest.raises(Exception, match="(?i)not.*exist"):
        inside.count()


def test_a_cluster_needs_the_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        common.shared_folder(Session())


def test_totals_of_groups(spark):
    rows = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    import pyspark.sql.functions as F

    got = {(r.k, r.most, r.n) for r in common.with_group(rows, ["k"], "v", most=(F.max, F.col("v")), n=(F.sum, F.lit(1))).collect()}
    assert got == {(0, 999, 334), (1, 997, 333), (2, 998, 333)}
