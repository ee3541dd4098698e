"""op11 to op13 against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketspark.llm import op11_negatives, op12_filters, op13_pii, queries


def brute_negatives(rows, every=100, positives=5, negatives=5, low=80, high=100):
    """rows of (id, vector, label) that take part."""
    kept = [(i, [math.floor(256 * float(x)) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    last = lambda x: (x[0] is None, x[0] or 0)
    for n, (i, v, y) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(j, sum(a * b for a, b in zip(v, w, strict=False)), z) for m, (j, w, z) in enumerate(kept) if m != n]
        scored.sort(key=lambda x: (-x[1], last(x)))
        for p, s, _ in [x for x in scored if x[2] == y][:positives]:
            own = [x for x in scored if x[2] != y and low * s <= 100 * x[1] <= high * s][:negatives]
            out += [(i, p, k, j, s, t) for k, (j, t, _) in enumerate(own, 1)]
    return sorted(out, key=repr)


def vectors(n, seed, width=6, labels=3):
    rng = random.Random(seed)
    return [(k, [round(rng.gauss(0.2, 0.5), 2) for _ in range(width)], rng.randrange(labels)) for k in range(n)]


SHAPE = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("chunk", [op11_negatives.CHUNK_BYTES, 6 * 8 * 4])
def test_negatives(spark, chunk):
    rows = vectors(240, 1)
    rows += [(3, rows[5][1], 1), (10, rows[5][1], 1), (10, rows[5][1], 1), (None, rows[7][1], 2), (100, rows[0][1], 0), (20, [], 1), (21, [0.5], 2)]
    odd = [(None, None, None), (30, None, 1), (31, [0.1, None], 1), (32, [float("nan")], 1), (33, [float("inf")], 1), (40, [0.1] * 6, None)]
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows + odd]
    found = op11_negatives.mine(spark.createDataFrame(rows + odd, SHAPE), "vec_id % 10 = 0", chunk_bytes=chunk)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_negatives(exact, every=10)


def test_negatives_wide_numbers(spark):
    """Scores beyond 2**53, where doubles would round."""
    rng = random.Random(2)
    rows = [(k, [rng.choice([-1, 1]) * rng.randrange(1 << 20, 1 << 22) * 1.0 for _ in range(9)], k % 2) for k in range(60)]
    found = op11_negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id % 20 = 0", low=1)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_negatives(rows, every=20, low=1)


def test_negatives_odd_tables(spark):
    assert op11_negatives.mine(spark.createDataFrame([], SHAPE)).collect() == []
    alone = spark.createDataFrame([(0, [0.5, 0.5], 1, "x")], SHAPE + ", score string")
    assert op11_negatives.mine(alone).collect() == []
    with pytest.raises(ValueError, match="positives"):
        op11_negatives.mine(alone, positives=0)


def test_ranges_hold_all_anchors():
    counts = [(0, 3), (2, 7), (5, 1)]
    places = [(p << 33) + k for p, n in counts for k in range(n)]
    for most in (1, 2, 4, 50):
        ranges = list(op11_negatives._ranges(counts, most))
        inside = [[x for x in places if a <= x < b] for a, b in ranges]
        assert sorted(sum(inside, [])) == places and max(map(len, inside)) <= most


def brute_audit(docs, labels):
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    rows = []
    for i, t, part in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > smallest[t],
        }
        rows.append((part or "", "".join(f for f in "ABCDE" if fails[f]), i is not None and i in good, i is not None and i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, shapley, some = [r for r in rows if r[0] == part], Counter(), []
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [r for r in own if f in r[1] and not before & set(r[1])]
                shapley[f] += len(removed)
                some.append((f, [part, "".join(order), step, sum(not (before | {f}) & set(r[1]) for r in own), len(removed), sum(f in r[1] and bool(before & set(r[1])) for r in own), sum(r[1] == f for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed)]))
        out += [(*x, shapley[f]) for f, x in some]
    return sorted(out)


AUDITED = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit(spark, odd, odd_rows, odd_labels, none):
    found = op12_filters.audit(odd, odd_labels)
    assert sorted(map(tuple, found.select(*AUDITED).collect())) == brute_audit([(r[0], r[1], r[2]) for r in odd_rows], [r[:3] for r in odd_labels.collect()])
    assert op12_filters.audit(none, odd_labels).collect() == []


def test_audit_of_many_copies(spark):
    """A text that half of the rows hold, ids that repeat and are null; parts of copies meet their smallest id."""
    rng = random.Random(3)
    docs = [(rng.choice([None, *range(150)]), "Copied TEXT # one" if k % 2 else f"words {rng.randrange(40)} " * rng.choice([1, 110]), rng.choice(["en", None, "fr"])) for k in range(300)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(150)] + [(3, 1, 1), (None, 1, 1)]
    found = op12_filters.audit(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, found.select(*AUDITED).collect())) == brute_audit(docs, labels)


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    )
    for k, (kind, pattern, holds) in enumerate(rules):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if holds(m[0])]
    return [x[2] for x in sorted(out)]


def test_pii_base_on_documents(spark, documents):
    found = {r.doc_id: r for r in op13_pii.digests(documents).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert found.keys() == texts.keys()
    total = 0
    for i, text in texts.items():
        want = brute_base(text)
        assert found[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        counts = Counter(w.split(":")[0] for w in want)
        assert [found[i][f"n_{k}"] for k in op13_pii.BASE] == [counts[k] for k in op13_pii.BASE]
        assert set(want) <= set(found[i].spans.split(","))
        total += len(want)
    assert total > 20


def test_pii_base_on_noise(spark):
    """Texts made of the patterns' own characters, control characters and characters outside of the plane."""
    rng = random.Random(4)
    bits = ["a@b.c", "@", ".", "-", " ", "+", "1", "25", "255", "256", "0", "(017)", "+1 (017) 555-7713", "4111111111111111", "4111 1111 1111 1111", "x_y", "%", "é", "😀", "\x01", "\x02", "\n", "1.2.3.4", "001.2.3.255", "a.b@c-d.e.f", "_", "AB12"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    texts += [None, "", *[x * 300 for x in RUNS]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in op13_pii.digests(df).collect():
        want = brute_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert set(want) <= set(r.spans.split(",")) | {""}
        starts = [int(s.split(":")[1]) for s in r.spans.split(",") if s]
        assert starts == sorted(starts)


RUNS = ("a", "1", "1 ", "a@", "1.", "+1", "a@b.c ", "(", "AB12 ", "+1 (017) 555-7713 ")


def test_pii_long_runs(spark):
    """Very long texts of one pattern's characters, which a search entered at every place would take hours for."""
    df = spark.createDataFrame([(k, x * 20_000) for k, x in enumerate(RUNS)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in op13_pii.digests(df).collect()}
    assert [got[k].n_email for k in range(len(RUNS))] == [0, 0, 0, 0, 0, 0, 20_000, 0, 0, 0]
    assert [got[k].n_phone for k in range(len(RUNS))] == [0] * 9 + [20_000] and got[4].n_ip == 5_000


def test_pii_added(spark):
    texts = [
        "Account DE89 3704 0044 0532 0130 00, please.",
        "Not one: DE88370400440532013000.",
        "GB82WEST12345698765432",
        "Pay 7536784127813050 4845168114407329 now",
        "Call me: (212) 555-0199.",
        "Section (212) 555-0199.",
        "Number 212 555 0199 alone",
        "phone +1 (017) 555-7713",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in op13_pii.digests(df).collect()}
    spans = lambda k, kind, s: f"{kind}:{texts[k].index(s)}:{texts[k].index(s) + len(s)}"
    assert got[0].split(",")[0] == spans(0, "iban", "DE89 3704 0044 0532 0130 00") and got[1] == "" and got[2] == "iban:0:22"
    cards = [s for s in ("7536784127813050", "4845168114407329") if luhn(s)]
    assert cards and got[3] == ",".join(spans(3, "card", s) for s in cards)
    assert got[4] == spans(4, "phone", "(212) 555-0199") and got[5] == "" and got[6] == ""
    assert got[7] == "phone:6:23"
    found = op13_pii.find(df).where("doc_id = 4").first().pii
    assert found[0].score == pytest.approx(0.55) and not found[0].base


def test_pii_redacted(spark, odd, odd_rows):
    df = spark.createDataFrame([(1, "mail a@b.cd, or 10.0.0.1 then +1 (017) 555-7713!", "k"), (2, None, "k"), (3, "none", "k"), (4, "😀 a@b.cd", "k")], "doc_id long, text string, _plain string")
    out = op13_pii.redacted(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "mail [EMAIL], or [IP] then [PHONE]!", 2: None, 3: "none", 4: "😀 [EMAIL]"}
    kept = op13_pii.redacted(odd)
    assert kept.columns == odd.columns and sorted(map(repr, kept.select("doc_id", "text").collect())) == sorted(map(repr, odd.select("doc_id", "text").collect()))


def test_pii_is_native(spark, sf_dir):
    plan = queries.op13_pii_spans(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    assert F.lit(1) is not None
