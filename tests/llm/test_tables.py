"""Mixing, WARC audit, chat roles and the pipeline."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docketspark.llm import op1_chat, op5_warc, op7_mixing
from docketspark.llm import queries as registered

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling by repeated resharing."""
    names = sorted(k for k in sizes if k is not None) + ([None] if None in sizes else [])
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    open_, out, left = set(names), {}, float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[k] for k in open_)
        full = {k for k in open_ if level * weight[k] > most * sizes[k]}
        if not full:
            return out | {k: level * weight[k] for k in open_}
        out |= {k: float(most * sizes[k]) for k in full}
        left -= sum(most * sizes[k] for k in full)
        open_ -= full
    return out


@pytest.mark.parametrize("name", ["documents", "skewed", "odd"])
def test_mixing(spark, documents, odd, name):
    if name == "skewed":
        rng = random.Random(5)
        docs = spark.createDataFrame([(k, rng.choice(["big"] * 30 + ["b", "c", "d", None]), "w " * rng.randint(0, 400)) for k in range(900)], "doc_id long, source string, text string")
    else:
        docs = documents if name == "documents" else odd
    found = op7_mixing.mix(docs).collect()
    sizes = {}
    for r in docs.select("source", "text").collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(SPLIT.findall(r.text or ""))
    want = targets(sizes)
    assert len(found) == docs.count()
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for k, t in taken.items():
        assert abs(t - want[k]) <= max(0.02 * want[k], 200)
    key = lambda rows: sorted(((r.doc_id, r.size, r.taken) for r in rows), key=repr)
    assert key(found) == key(op7_mixing.mix(docs.repartition(7)).collect())


@pytest.mark.parametrize("large", [0, 40_000])
def test_small_sources_get_their_targets(spark, large):
    """Sources of 5 to 200 words, of few or many short texts: alone, and beside a large one, where all are at their caps."""
    texts = [("b%03d" % n, "w " * n) for n in (5, 10, 20, 33, 77, 200)]
    texts += [("s%d" % n, "w " * n) for n in (1, 2, 3, 8) for _ in range(25)] + [(None, "w w w")] * 9
    texts += [("a", "w " * 400)] * (large // 400)
    docs = spark.createDataFrame([(k, s, t) for k, (s, t) in enumerate(texts)], "doc_id long, source string, text string")
    rows = [(r, source) for r, (source, _) in zip(sorted(op7_mixing.mix(docs).collect(), key=lambda r: r.doc_id), texts, strict=True)]
    sizes, taken = {}, {}
    for r, s in rows:
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = targets(sizes)
    assert sum(taken.values()) == sum(sizes.values())
    for s, t in taken.items():
        assert abs(t - want[s]) <= max(1, 0.01 * want[s]), s
    if large:
        assert all(r.taken == 3 * r.size for r, s in rows if s != "a")


def test_seats_of_full_parties_go_to_the_next_quotients(spark):
    rng = random.Random(6)
    rows = [(g, k, rng.choice([0, 4, 9, 10, 11, 20, 21, 300])) for g in range(30) for k in range(rng.randint(1, 9))]
    votes = {g: {k: v for h, k, v in rows if h == g} for g in range(30)}
    seats = {g: int(rng.choice([0.3, 1, 2, 2.9, 3]) * sum(v.values()) / 32) for g, v in votes.items()}
    df = spark.createDataFrame([(*r, seats[r[0]]) for r in rows], "g long, k long, v long, seats long")
    found = {(r.g, r.k): r.quota for r in op7_mixing.apportioned(df, ["g"], F.col("seats"), F.col("v"), F.floor(F.col("v") * 3 / 32), [F.col("k")]).collect()}
    for g, own in votes.items():
        won = dict.fromkeys(own, 0)
        for _ in range(seats[g]):
            open_ = [k for k in own if won[k] < own[k] * 3 // 32]
            if open_:
                won[max(open_, key=lambda k: (own[k] / (2 * won[k] + 1), -k))] += 1
        assert {k: found[g, k] for k in own} == won


def test_mixing_of_nothing(none, odd):
    assert op7_mixing.mix(none).count() == 0
    assert {r.taken for r in op7_mixing.mix(odd.where("text is null")).collect()} == {0}


def test_quotas_are_those_of_highest_quotients(spark):
    rng = random.Random(1)
    rows = [(g, k, rng.choice([0, 1, 3, 10, 500, 777])) for g in range(12) for k in range(rng.randint(1, 9))]
    seats = {g: rng.choice([0, 1, 2, 7, 50, 333]) for g in range(12)}
    df = spark.createDataFrame([(*r, seats[r[0]]) for r in rows], "g long, k long, v long, seats long")
    got = op7_mixing.apportioned(df, ["g"], F.col("seats"), F.col("v"), F.lit(10**9), [F.col("k")])
    found = {(r.g, r.k): r.quota for r in got.collect()}
    for g in range(12):
        votes = {k: v for h, k, v in rows if h == g}
        won = dict.fromkeys(votes, 0)
        for _ in range(seats[g] if sum(votes.values()) else 0):
            best = max(votes, key=lambda k: (votes[k] / (2 * won[k] + 1), -k))
            won[best] += 1
        assert {k: found[g, k] for k in votes} == won


def test_audit_finds_the_damaged_records(spark):
    pages = spark.createDataFrame([(k, f"u{k}", f"<p>{k}</p>" * (k % 7)) for k in range(2300)] + [(None, None, None), (5, "u5", "again")], "page_id long, url string, html string")
    archive = op5_warc.archived(pages, per_file=200)
    assert op5_warc.audit(archive, archive).count() == 0
    rot = archive.withColumn("digest", F.when(F.col("page_id").isin(17, 1999), F.sha2("digest", 256)).otherwise(F.col("digest")))
    lost = rot.where("not (file = 3 and record = 9) and file <> 11")
    found = {(r.file, r.record): r.status for r in op5_warc.audit(archive, lost).collect()}
    assert sum(v == "corrupt" for v in found.values()) == 2 and found[3, 9] == "missing"
    assert sum(v == "missing" for v in found.values()) == 1 + archive.where("file = 11").count()
    back = {(r.file, r.record): r.status for r in op5_warc.audit(lost, archive).collect()}
    assert back[3, 9] == "extra"
    status = op5_warc.audited(archive, lost).groupBy("status").count().collect()
    assert sum(r["count"] for r in status) == archive.count()
    none = archive.limit(0)
    assert op5_warc.audit(none, none).count() == 0
    assert {r.status for r in op5_warc.audit(archive, none).select("status").distinct().collect()} == {"missing"}


def test_offsets_are_where_the_bytes_are(spark):
    pages = spark.createDataFrame([(k, f"ü{k}", "é" * k) for k in range(9)], "page_id long, url string, html string")
    rows = op5_warc.archived(pages, per_file=4).join(pages.select("page_id", op5_warc.framed(F.col("url"), F.col("html")).alias("b")), "page_id").collect()
    for number in {r.file for r in rows}:
        own = sorted((r for r in rows if r.file == number), key=lambda r: r.record)
        whole = b"".join(r.b.encode() for r in own)
        assert all(whole[r.offset : r.offset + r.length] == r.b.encode() for r in own)


def test_chat_roles(spark, none):
    talk = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = op1_chat.recover(talk)
    rows = found.collect()
    assert np.mean([r.role == r.recorded for r in rows if r.held_out]) > 0.9
    # the block size changes how the work is cut, and nothing else
    key = lambda xs: sorted((r.conv_id, r.turn, r.seg, r.role, r.rendered) for r in xs)
    assert key(op1_chat.recover(talk, block=2).collect()) == key(rows)
    assert op1_chat.recover(talk.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, None, None), (None, 0, "user", "Hi?"), (None, 0, "user", "Hi?"), (2, 5, "assistant", ""), (2, 1, "user", "User: a\n\nAssistant: b\nmore\n\n\nHuman: c")], "conv_id long, turn long, role string, text string")
    odd = op1_chat.recover(odd).collect()
    assert len(odd) == 7
    bodies = [r.rendered.split("|>\n")[-1] for r in sorted((r for r in odd if r.conv_id == 2 and r.turn == 1), key=lambda r: r.seg)]
    assert bodies == ["a\n", "b\nmore\n", "c\n"]


def test_chat_blocks_hold_few_segments_whatever_the_turns(spark):
    """A conversation without an id whose turns repeat or are null, one of a single turn, one of a single text."""
    rng = random.Random(8)
    says = ["User: why?", "Assistant: since it is so.", "and more\nof it", "", "System: be brief\n\nplain"]
    rows = [(None, rng.choice([None, 0, 1, 2]), rng.choice(["user", "assistant", None]), rng.choice(says)) for _ in range(900)]
    rows += [(1, 3, "user", "same")] * 300 + [(2, 0, "user", "a\n\n" * 400)] + [(k, 0, "user", "b") for k in range(3, 20)]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    placed = op1_chat.in_blocks(op1_chat.cut(talk), 16)
    sizes = placed.groupBy("conv_id", "block").count()
    assert sizes.agg(F.max("count")).first()[0] <= 16 and sizes.count() < placed.count() / 8
    key = lambda found: sorted(map(tuple, found.collect()), key=repr)
    got = key(op1_chat.recover(talk, block=16))
    assert len(got) == sum(len(op1_chat.segments(r[3])) for r in rows)
    assert got == key(op1_chat.recover(talk, block=10**6))


def test_chat_viterbi_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n, k = int(rng.integers(1, 6)), 3
        scores, moves, start = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
        value = lambda p: start[p[0]] + sum(scores[i][s] for i, s in enumerate(p)) + sum(moves[a, b] for a, b in itertools.pairwise(p))  # noqa: E731, B023
        best = max(itertools.product(range(k), repeat=n), key=value)
        assert tuple(op1_chat.viterbi(scores, start, moves, best[-1])) == best


def test_pipeline_stages(spark, sf_dir, documents):
    docs, columns = documents, documents.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema) if len(kept) < 4 else stage(spark, docs, sf_dir)
        kept.append(docs.count())
        if len(kept) < 5:
            assert docs.columns == columns, name
    assert kept[0] < documents.count() and kept[1] < kept[0] and kept[2] == kept[1] and kept[3] <= kept[2] and kept[4] == kept[3]
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[4]


def test_pipeline_stages_take_odd_rows(spark, sf_dir, odd, none):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, sf_dir).count() <= odd.count()
        assert stage(spark, none, sf_dir).count() == 0


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in registered.QUERIES if k.startswith("op")} == set(range(1, 14))
    assert list(corpus_pipeline.QUERIES) == ["pipeline"]
