"""Tiles of fingerprints compared piece by piece give what all pairs give, whatever the pieces."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketspark.operators import dedup, links, tiles
from tests.test_links import prints, table


def tile(seed, n, first):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, (2, 3), dtype=np.uint64)
    which = rng.integers(0, 3, n)
    noise = lambda: np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 63, (4, n)).astype(np.uint64))
    return first + 2 * np.arange(n), centres[0][which] ^ noise(), centres[1][which] ^ noise()


def far(one, two):
    return np.bitwise_count(one[1][:, None] ^ two[1]).astype(int) + np.bitwise_count(one[2][:, None] ^ two[2])


@pytest.fixture(params=[(3, 5), (64, 4096)])
def sized(request, monkeypatch):
    monkeypatch.setattr(tiles, "ROWS", request.param[0])
    monkeypatch.setattr(tiles, "COLUMNS", request.param[1])


def test_within(sized):
    one, two = tile(1, 70, 0), tile(1, 41, 1)
    d, distances = far(one, two), tiles.Distances(one, two)
    for most in (3, 11, 128):
        found = [x for p in tiles.pieces(70, 41) for x in zip(*(c.tolist() for c in distances.within(most, *p)), strict=True)]
        assert sorted(found) == [(x, y, d[x, y]) for x, y in np.argwhere(d <= most).tolist()]


def test_compared(sized):
    one, two, most = tile(2, 70, 0), tile(2, 41, 1), 9
    d = far(one, two)
    (a, a_links, a_best, a_near, a_root), (b, b_links, b_best, b_near, b_root) = links._compared(one, two, most)
    for own, other, d, number, n_links, best, near in ((one, two, d, a, a_links, a_best, a_near), (two, one, d.T, b, b_links, b_best, b_near)):  # noqa: B020
        some = (d <= most).any(axis=1)
        assert own[0][some].tolist() == number.tolist() and (d <= most).sum(axis=1)[some].tolist() == n_links.tolist()
        assert d.min(axis=1)[some].tolist() == best.tolist() and other[0][d.argmin(axis=1)][some].tolist() == near.tolist()
    root = {n: n for n in (*one[0].tolist(), *two[0].tolist())}
    pairs = [(int(one[0][x]), int(two[0][y])) for x, y in np.argwhere(far(one, two) <= most).tolist()]
    for _ in range(len(root)):
        for x, y in pairs:
            root[x] = root[y] = min(root[x], root[y])
    assert [root[n] for n in (*a.tolist(), *b.tolist())] == [*a_root.tolist(), *b_root.tolist()]


@pytest.mark.parametrize("k", [1, 7, 200])
def test_closest(sized, k):
    one, parts = tile(3, 70, 0), [tile(3, 41, 1), tile(3, 70, 0)]
    best, number = np.full((70, k), links._SELF), np.full((70, k), (1 << 63) - 1)
    for two in parts:
        links._closest(one, two, k, 128, best, number)
    for x in range(70):
        want = sorted((far(one, two)[x, y], n) for two in parts for y, n in enumerate(two[0].tolist()) if n != one[0][x])[:k]
        assert want == [(d, n) for d, n in zip(best[x].tolist(), number[x].tolist(), strict=True) if d < links._FAR]


def test_near_pairs_of_many_tiles(spark):
    rows = prints(90, 4, 24)
    reps = {}
    for i, sha, f in rows:
        reps[sha] = min(reps.get(sha, (i, f)), (i, f))
    reps = [r for r in reps.values() if r[1]]
    want = sorted((a, b, 1 - (x ^ y).bit_count() / 128) for a, x in reps for b, y in reps if a < b and (x ^ y).bit_count() <= 19)
    found = dedup.near_pairs(table(spark, rows), 0.85, tile=9).select("id_a", "id_b", "similarity")
    assert sorted(map(tuple, found.collect())) == want


@pytest.mark.parametrize("most", [0, 6, 19, 128])
def test_lots_hold_each_near_pair_once(sized, most):
    one, two = tile(5, 90, 0), tile(5, 75, 1)
    d, seen = far(one, two), np.zeros((90, 75), int)
    for rows, columns in tiles.lots(one, two, most):
        assert len(rows) <= tiles.ROWS and len(columns) <= tiles.COLUMNS
        assert (np.diff(rows) > 0).all() and (np.diff(columns) > 0).all()
        assert (tiles.Distances(one, two).of(rows, columns).whole(0, len(rows), 0, len(columns)) == d[np.ix_(rows, columns)]).all()
        seen[np.ix_(rows, columns)] += 1
    assert seen.max() == 1 and (seen[d <= most] == 1).all()


def clustered(n):
    """Texts around three far centres, in no order; all near pairs are within a centre."""
    rng = np.random.default_rng(8)
    which, bit = rng.integers(0, 3, n), rng.integers(0, 64, n).astype(np.uint64)
    words = np.array([0x0, 0xFFFFFFFFFFFFFFFF, 0xFFFFFFFF], np.uint64)[which] ^ (np.uint64(1) << bit)
    return np.arange(n), words, words ^ (np.uint64(3) << np.minimum(bit, np.uint64(62)))


def test_far_clusters_are_not_compared(monkeypatch):
    """Of three equal clusters a third of the pairs is compared, for links as for pairs."""
    monkeypatch.setattr(tiles, "ROWS", 8)
    cells, real = [], tiles.Distances._half
    monkeypatch.setattr(tiles.Distances, "_half", lambda self, word, i, j, a, b, out: cells.append((j - i) * (b - a) if word == 1 else 0) or real(self, word, i, j, a, b, out))
    one, n = clustered(1200), 1200
    links_found = sum(int(n_links.sum()) for _, n_links, *_ in links._compared(one, None, 12))
    assert links_found == (far(one, one) <= 12).sum() - n and sum(cells) < 0.4 * n * n
    cells.clear()
    ids = pa.array([f"{k:04d}" for k in range(n)])
    row = {"left_side": [True], "same": [True], "number": [one[0]], "hi": [one[1].view(np.int64)], "lo": [one[2].view(np.int64)], "id": pa.ListArray.from_arrays([0, n], ids)}
    found = list(dedup._near(12)(iter([pa.RecordBatch.from_pydict(row)])))
    assert sum(len(b.column("pairs").values) for b in found) == links_found // 2 and sum(cells) < 0.4 * n * n
    assert sum(len(b.column(c).values) for b in found for c in ("firsts", "seconds")) < links_found // 2 // 2, "an id leaves a task for several pairs"


def test_groups_are_joined_by_rounds():
    """Joins of a piece are a few rounds over arrays, not one for each row, and find the groups that one by one would."""
    rng = np.random.default_rng(4)
    near = rng.random((64, 500)) < 0.004
    groups, root = links._Groups(564), list(range(564))
    calls, real = [], groups.join
    groups.join = lambda some, others: calls.append(1) or real(some, others)
    assert groups.join_near(near.copy(), np.arange(64), np.arange(64, 564)) and len(calls) < 16
    assert not groups.join_near(near.copy(), groups.roots(np.arange(64)), groups.roots(np.arange(64, 564)))
    for _ in range(564):
        for x, y in np.argwhere(near).tolist():
            root[x] = root[64 + y] = min(root[x], root[64 + y])
    assert groups.roots(np.arange(564)).tolist() == root


def test_rendered_formats_no_pair(spark):
    rows = [("a", "b", 1 - d / 128, "simhash") for d in range(129)] + [("a", "b", 0.123, "x"), ("a", None, None, None)]
    pairs = spark.createDataFrame(rows, "id_a string, id_b string, similarity double, method string")
    want = F.format_string("%s <-> %s (%.1f%% similar, %s)", "id_a", "id_b", F.col("similarity") * 100, "method")
    lines = dedup.rendered(pairs)
    assert lines.where(~F.col("line").eqNullSafe(want)).count() == 0 and lines.count() == 131
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_string") == 1, "only what no fingerprint can have is formatted"
