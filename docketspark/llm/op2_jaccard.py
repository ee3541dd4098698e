"""N-gram Jaccard join: a metric-space join over pivots and Voronoi regions, exact.

Jaccard distance is a metric, but between texts that share no shingle it is 1 whatever the pivots,
so pivots are drawn where the metric can tell texts apart. The universe of shingles is cut into more
slices than two linked sets can differ in elements, so linked sets agree on a slice that is not
empty. The least set with a slice's content is the pivot of all sets that have it: a set belongs to
the region of each pivot it has a slice in common with, and every linked pair meets in one region.

Regions are joined recursively:

1. Distances to the region's pivot are computed by parts of it. What lies within the link radius (the
   pivot's ball) is linked to it; two members of the ball need no comparison any more. A region that
   its ball covers is done, and of the ball only the members that the triangle inequality leaves
   within reach of one outside are kept.
2. A region that is small enough is joined by one task: pairs that share one of their rarest shingles,
   whose distances to the pivot differ by at most the radius, are compared exactly.
3. A larger one draws pivots of its own; a set goes to the cell of its nearest pivot, and is copied
   to an earlier pivot's cell where its distance is at most two radii above that to its own pivot and
   one radius above that of the cell's farthest member. Cells are regions of the next round.
4. Cells that don't shrink (the metric can't tell their members apart) are cut into blocks, and each
   pair of blocks is joined by one task: exact and of bounded memory, but quadratic in the cell.

Texts with equal sets are one node, and the nodes that a slice of a batch has in common send one
entry, so that no slice content, however common, is one task's.

Defined cases: null, empty and wordless texts have no shingle, link with nothing and are their own
component; a text with fewer words than a shingle has the whole sequence as its one shingle; rows
with one id are joined as rows of their own; a null id gets a null component and links nothing; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm import kernels
from docketspark.llm.common import fresh, partitions, pieces, scratch, sliced, text_bytes, with_group, written
from docketspark.llm.graph import components

#: A region that has more shingles, or more sets, is cut by pivots.
REGION_SHINGLES = 1 << 20
REGION_SETS = 1 << 12
#: Pivots that a region draws, as expected.
PIVOTS = 16
#: Salts after which a set that never fills enough slices has its shingles themselves as signatures.
SALTS = 3
#: Rows of a slice of a batch: a node is the slice's number and 16 bits for the row's place.
_SLICE_ROWS = 1 << 16


def shingle_sets(raw: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each row, offsets of each row's first)."""
    low = kernels.LOWER[raw]
    start, end, first = kernels.words(low, at, kernels.NOT_SPACE)
    row, word = kernels.rows_of(first), kernels.range_hash(kernels.prefix_sums(low), start, end)
    found = kernels.shingles(word, words)
    whole = row[: len(found)] == row[words - 1 :] if len(found) else np.zeros(0, bool)
    rows, hashes = row[: len(found)][whole], found[whole]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < words))
    if len(short):
        one = []
        for r in short.tolist():
            total = np.uint64(0)
            for h in word[first[r] : first[r + 1]]:
                total = kernels.mix(np.array([total], np.uint64) + np.uint64(0x5851F42D4C957F2D))[0] ^ h
            one.append(total)
        rows, hashes = np.concatenate([rows, short]), np.concatenate([hashes, np.array(one, np.uint64)])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[new], hashes[new]
    return hashes, np.searchsorted(rows, np.arange(len(at)))


def _wrapped_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def set_keys(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's set; equal sets have equal ones."""
    return tuple(_wrapped_sums(kernels.mix(hashes + np.uint64(k)), first) for k in (11, 12))


def differences(n: np.ndarray, percent: int) -> np.ndarray:
    """How many elements a set of n and a linked one of at least n can differ in, at most."""
    return n * (100 - percent) // percent


@functools.cache
def _slice_counts(most: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of slices, how many differences plus one each is enough for), up to `most`; about 100 / percent apart.

    Of many slices some stay empty, so there are a few more of them than differences.
    """
    counts = [1]
    while (counts[-1] if counts[-1] <= 16 else int(0.95 * counts[-1])) < most:
        counts.append(max(counts[-1] + 1, counts[-1] * 100 // percent))
    found = np.array(counts, np.int64)
    return found, np.where(found <= 16, found, (0.95 * found).astype(np.int64))


def signatures(hashes: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the slices that are not empty.

    A set is sliced at every level from that of the smallest size it may link with to that of its
    own. A set with no more filled slices than it can have differences could agree with another one
    on empty slices alone; it is sliced again with another salt until it has more. Two such sets meet
    at the first salt that is enough for either, as both go on until then; where none of SALTS is,
    as at low thresholds, both have each of their shingles for a signature and meet at a shared one.
    """
    n = np.diff(first)
    rows_out, found_out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if not (n > 0).any():
        return rows_out[0], found_out[0]
    counts, enough = _slice_counts(1 << int(differences(n.max(), percent) + 1).bit_length(), percent)
    low, high = (np.searchsorted(enough, differences(x, percent) + 1) for x in (-(-n * percent // 100), n))
    scarce = np.zeros(len(n), bool)
    for lv in range(int(low[n > 0].min()), int(high.max()) + 1):
        todo = np.flatnonzero((n > 0) & (low <= lv) & (lv <= high))
        slices = int(counts[lv])
        # at a lower level the smaller partner, whose own level it is, bounds the differences
        most = np.minimum(differences(n[todo], percent), enough[lv] - 1)
        for salt in range(SALTS):
            if not len(todo):
                break
            take = _spans(first[todo], n[todo])
            row = np.repeat(np.arange(len(todo)), n[todo])
            value = kernels.mix(hashes[take] + np.uint64(1000003 * (salt + 1)))
            key = row * slices + (((value >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(key, kind="stable")
            key, value = key[order], kernels.mix(value[order] + np.uint64(77))
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            content = np.add.reduceat(value, heads)
            key = key[heads]
            tag = np.uint64((slices * 64 + salt) * 0x9E3779B97F4A7C15 % (1 << 64))
            rows_out.append(todo[key // slices])
            found_out.append(kernels.mix(content + tag + (key % slices).astype(np.uint64)))
            again = np.bincount(key // slices, minlength=len(todo)) <= most
            todo, most = todo[again], most[again]
        scarce[todo] = True
    todo = np.flatnonzero(scarce)
    if len(todo):
        rows_out.append(np.repeat(todo, n[todo]))
        found_out.append(kernels.mix(hashes[_spans(first[todo], n[todo])] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return np.concatenate(rows_out), np.concatenate(found_out)


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each of the runs, one after the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - start, count)


#: Shingles that a comparison has in arrays at a time.
_AT_ONCE = 1 << 20


def _shared_with(pivot: np.ndarray, sets: list[np.ndarray], members: np.ndarray) -> np.ndarray:
    """The size of the intersection of a set with each member's."""
    out = np.zeros(len(members), np.int64)
    sizes = np.array([len(sets[i]) for i in members], np.int64)
    total, i = np.cumsum(sizes), 0
    while i < len(members):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + _AT_ONCE, "right")))
        flat = np.concatenate([sets[k] for k in members[i:j]])
        at = np.minimum(np.searchsorted(pivot, flat), len(pivot) - 1)
        out[i:j] = np.add.reduceat((pivot[at] == flat).astype(np.int64), np.r_[0, np.cumsum(sizes[i : j - 1])])
        i = j
    return out


def _measured(pivot: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(distance of each set to the pivot, whether the two are linked)."""
    shared = _shared_with(pivot, sets, np.arange(len(sets)))
    union = len(pivot) + np.array([len(s) for s in sets], np.int64) - shared
    return 1 - shared / union, 100 * shared >= percent * union


def _reach(percent: int) -> float:
    return 1 - percent / 100 + 1e-9


def links_within(sets: list[np.ndarray], percent: int, far: np.ndarray, ball: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the sets of a region into its components, exact.

    far: distances to the region's pivot (nan: unknown); ball: what is linked to it, and so one
    component already; two sets of one side other than 0 are not to be compared. Linked sets share
    one of their rarest shingles, as many as either can do without and one more.
    """
    n, found = len(sets), []
    label = np.arange(n)
    if ball.any():
        label[ball] = np.flatnonzero(ball)[0]
    groups = len(np.unique(label))
    if groups < 2:
        return found
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rare = times[code]
    order = np.lexsort((code, rare, owner))
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    early = (place < (size - -(-size * percent // 100) + 1)[owner]) & (rare[order] > 1)
    own, code = owner[early], code[order][early]
    by = np.lexsort((own, code))
    own, code = own[by], code[by]
    cuts = np.flatnonzero(np.r_[True, code[1:] != code[:-1], True]) if len(code) else np.zeros(1, np.int64)
    slot = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    of = np.argsort(own, kind="stable")
    first = np.searchsorted(own[of], np.arange(n + 1))
    common = np.bincount(label).argmax()  # pairs inside the largest component needn't be looked at
    settled = label == common
    for q in np.flatnonzero(~settled).tolist():
        near = np.zeros(n, bool)
        for k in slot[of[first[q] : first[q + 1]]].tolist():
            near[own[cuts[k] : cuts[k + 1]]] = True
        near[: q + 1] &= settled[: q + 1]
        c = np.flatnonzero(near)
        c = c[(label[c] != label[q]) & ((side[c] != side[q]) | (side[c] == 0))]
        c = c[(100 * np.minimum(size[c], size[q]) >= percent * np.maximum(size[c], size[q])) & ~(np.abs(far[c] - far[q]) > _reach(percent))]
        if not len(c):
            continue
        shared = _shared_with(sets[q], sets, c)
        for k in c[100 * shared >= percent * (size[c] + size[q] - shared)].tolist():
            if label[k] != label[q]:
                found.append((q, k))
                label[label == label[k]] = label[q]
                groups -= 1
        if groups == 1:
            break
    return found


def region_components(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The component of each set of a region, named by its first member; the first set is the pivot."""
    n = len(sets)
    if n < 2:
        return np.zeros(n, np.int64)
    far, ball = _measured(sets[0], sets, percent)
    label = np.where(ball, 0, np.arange(n))
    for a, b in links_within(sets, percent, far, ball, np.zeros(n, np.int64)):
        low, high = sorted((label[a], label[b]))
        label[label == high] = low
    return label


_ROW = np.dtype([("id", "<i8"), ("ok", "?"), ("n", "<i8"), ("rep", "<i4")])
_REP = np.dtype([("id", "<i8"), ("n", "<i8"), ("one", "<u8"), ("two", "<u8")])


_SLICE = "bucket int, slice long, kind int, a binary, b binary, c binary, d binary, e binary"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * 8
    kinds = pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["bucket", "slice", "kind", "a", "b", "c", "d", "e"])


def _slices(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """Of each slice of a batch: each signature and each set once, by the bucket it falls in (kind 0: keys in two parts, owners, sets, their
    places), and its rows, its distinct sets (the smallest id of each) and the signatures that several of them have (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        for big in sliced(batches, "text"):
            for k in range(0, big.num_rows, _SLICE_ROWS):
                batch = big.slice(k, _SLICE_ROWS)
                column = batch.column("doc_id")
                valid = np.asarray(column.is_valid())
                ids = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                sizes, one, two, rows, found = [], [], [], [], []
                for i, _, raw, at in pieces(*text_bytes(batch.column("text"))):
                    hashes, first = shingle_sets(raw, at, words)
                    x, y = set_keys(hashes, first)
                    row, signature = signatures(hashes, first, percent)
                    sizes.append(np.diff(first)), one.append(x), two.append(y), rows.append(row + i), found.append(signature)
                sizes, one, two, rows, found = map(np.concatenate, (sizes, one, two, rows, found))
                known = np.zeros(len(ids), _ROW)
                known["id"], known["ok"], known["n"], known["rep"] = ids, valid, sizes, -1
                use = np.flatnonzero(valid & (sizes > 0))
                order = use[np.lexsort((ids[use], two[use], one[use]))]
                new = _heads(one[order], two[order])
                known["rep"][order] = np.cumsum(new) - 1
                head = order[new]
                rep = np.zeros(len(head), _REP)
                rep["id"], rep["n"], rep["one"], rep["two"] = ids[head], sizes[head], one[head], two[head]
                speaks = np.zeros(len(ids), bool)
                speaks[head] = True
                # 48 bits of a signature and its bucket; what falls together by chance is compared for nothing
                owner, sig = known["rep"][rows[speaks[rows]]].astype(np.uint16), found[speaks[rows]]
                sig = (sig & ~np.uint64(0xFFFF)) | ((sig & np.uint64(0xFFFF)) % np.uint64(buckets))
                order = np.lexsort((owner, sig))
                owner, sig = owner[order], sig[order]
                new = _heads(sig)
                several = ~new
                several[:-1] |= ~new[1:]
                yield _blobs([(number % buckets, number, 1, known.tobytes(), rep.tobytes(), sig[several].tobytes(), owner[several].tobytes(), b"")])
                sig, owner = sig[new], owner[new]
                at = [sig & np.uint64(0xFFFF), (rep["one"] & np.uint64(0xFFFF)) % np.uint64(buckets)]
                order = [np.argsort(x, kind="stable") for x in at]
                cuts = [np.searchsorted(x[o], np.arange(buckets + 1, dtype=np.uint64)) for x, o in zip(at, order, strict=True)]
                sig, owner, sets = sig[order[0]], owner[order[0]], np.stack([rep["one"], rep["two"]], axis=1)[order[1]]
                high, low, places = (sig >> np.uint64(32)).astype(np.uint32), (sig >> np.uint64(16)).astype(np.uint16), order[1].astype(np.uint16)
                out = []
                for bucket in range(buckets):
                    (i, j), (m, n) = ((c[bucket], c[bucket + 1]) for c in cuts)
                    if i < j or m < n:
                        out.append((bucket, number, 0, high[i:j].tobytes(), low[i:j].tobytes(), owner[i:j].tobytes(), sets[m:n].tobytes(), places[m:n].tobytes()))
                yield _blobs(out)
                number += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, _SLICE)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Whether each place of sorted arrays differs from the one before it."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


_ANSWER = np.dtype([("key", "<u8"), ("owner", "<i8"), ("pivot", "<i8")])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices as they are (kind 1), and what the bucket knows for them (kind 0, a: the least node of each signature that several slices have; b: the first copy of a set that has an earlier one)."""
    got: list[list[np.ndarray]] = [[], [], [], []]
    for batch in batches:
        whole = []
        for bucket, number, kind, a, b, c, d, e in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if kind:
                whole.append((bucket, number, kind, a, b, c, d, e))
                continue
            key = (np.frombuffer(a, np.uint32).astype(np.uint64) << np.uint64(32)) | (np.frombuffer(b, np.uint16).astype(np.uint64) << np.uint64(16)) | np.uint64(bucket)
            base = number << 16
            for k, x in enumerate((key, base | np.frombuffer(c, np.uint16).astype(np.int64), np.frombuffer(d, np.uint64).reshape(-1, 2), base | np.frombuffer(e, np.uint16).astype(np.int64))):
                got[k].append(x)
        if whole:
            yield _blobs(whole)
    if not got[0]:
        return
    key, node, sets, rep = map(np.concatenate, got)
    del got
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = _heads(key)
    several = ~new
    several[:-1] |= ~new[1:]
    pivot = node[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))] if len(key) else node
    known = np.zeros(int(several.sum()), _ANSWER)
    known["key"], known["owner"], known["pivot"] = key[several], node[several], pivot[several]
    order = np.lexsort((rep, sets[:, 1], sets[:, 0]))
    sets, rep = sets[order], rep[order]
    new = _heads(sets[:, 0], sets[:, 1])
    least = rep[np.maximum.accumulate(np.where(new, np.arange(len(rep)), 0))] if len(rep) else rep
    pairs = np.stack([rep[~new], least[~new]], axis=1)
    known, pairs = known[np.argsort(known["owner"] >> 16, kind="stable")], pairs[np.argsort(pairs[:, 0] >> 16, kind="stable")]
    at = known["owner"] >> 16, pairs[:, 0] >> 16
    slices = np.unique(np.concatenate(at))
    for k in range(0, len(slices), 1024):
        some = slices[k : k + 1024]
        (a, b), (c, d) = ((np.searchsorted(x, some, "left"), np.searchsorted(x, some, "right")) for x in at)
        yield _blobs([(0, int(n), 0, known[a[i] : b[i]].tobytes(), pairs[c[i] : d[i]].tobytes(), b"", b"", b"") for i, n in enumerate(some)])


_MET = "kind int, a long, b long, n long"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices and their answers to (0, pivot, set, its size) for each region a set belongs to, and (1, first copy, later copy, 0)."""
    for batch in batches:
        for number, reps, sig, owner, answers, same in zip(*(batch.column(c).to_pylist() for c in ("slice", "b", "c", "d", "answers", "same")), strict=True):
            base, rep = number << 16, np.frombuffer(reps, _REP)
            sig, owner = np.frombuffer(sig, np.uint64), np.frombuffer(owner, np.uint16).astype(np.int64)
            known = np.concatenate([np.zeros(0, _ANSWER), *(np.frombuffer(x, _ANSWER) for x in answers or ())])
            same = np.concatenate([np.zeros((0, 2), np.int64), *(np.frombuffer(x, np.int64).reshape(-1, 2) for x in same or ())])
            known = known[np.argsort(known["key"])]
            # signatures of several sets of the slice: the pivot is the first of them, or what the bucket knows
            new = _heads(sig)
            pivot = base | owner[new]
            if len(known):
                at = np.minimum(np.searchsorted(known["key"], sig[new]), len(known) - 1)
                pivot = np.where(known["key"][at] == sig[new], known["pivot"][at], pivot)
            a = np.r_[pivot[np.cumsum(new) - 1], known["pivot"]] if len(sig) else known["pivot"]
            b = np.r_[base | owner, known["owner"]]
            copy = np.zeros(len(rep) + 1, bool)
            copy[same[:, 0] & (_SLICE_ROWS - 1)] = True
            apart = (a != b) & ~copy[b & (_SLICE_ROWS - 1)]
            a, b = np.unique(np.stack([a[apart], b[apart]]), axis=1) if apart.any() else (a[:0], b[:0])
            kind = np.r_[np.zeros(len(a)), np.ones(len(same))]
            n = np.r_[rep["n"][b & (_SLICE_ROWS - 1)], np.zeros(len(same), np.int64)]
            columns = (kind, pa.int32()), (np.r_[a, same[:, 1]], pa.int64()), (np.r_[b, same[:, 0]], pa.int64()), (n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t.to_pandas_dtype()), t) for x, t in columns], ["kind", "a", "b", "n"])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, doc_id, one, two) of every distinct set of every slice."""
    for batch in batches:
        for number, reps in zip(*(batch.column(c).to_pylist() for c in ("slice", "b")), strict=True):
            rep = np.frombuffer(reps, _REP)
            columns = (number << 16) | np.arange(len(rep)), rep["id"], rep["one"].view(np.int64), rep["two"].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "doc_id", "one", "two"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, node, alone) of every row; node is null where there is no set, alone the component if nothing is linked."""
    for batch in batches:
        for number, rows, reps in zip(*(batch.column(c).to_pylist() for c in ("slice", "a", "b")), strict=True):
            row, rep = np.frombuffer(rows, _ROW), np.frombuffer(reps, _REP)
            none = row["rep"] < 0
            alone = np.where(none, row["id"], rep["id"][row["rep"]] if len(rep) else 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["id"], pa.int64(), mask=~row["ok"]), pa.array(row["n"], pa.int64()), pa.array((number << 16) | row["rep"].astype(np.int64), pa.int64(), mask=none), pa.array(alone, pa.int64(), mask=~row["ok"])],
                ["doc_id", "n_shingles", "node", "alone"],
            )


def _texts_of(words: int):
    """Rows (node, one, two, text) to (node, text), of one row whose text has the node's set.

    Texts travel and not their sets: eight bytes a shingle don't compress, words do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for big in batches:
            for batch in sliced(iter([big]), "text"):
                node, one, two = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "one", "two"))
                nodes, rows = [], []
                for i, j, raw, at in pieces(*text_bytes(batch.column("text"))):
                    hashes, first = shingle_sets(raw, at, words)
                    a, b = set_keys(hashes, first)
                    right = (a.view(np.int64) == one[i:j]) & (b.view(np.int64) == two[i:j])
                    for k in np.flatnonzero(right).tolist():
                        if node[i + k] != last:  # rows of one id and text come together
                            last = node[i + k]
                            nodes.append(last)
                            rows.append(i + k)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column("text").take(pa.array(rows, pa.int64()))], ["node", "text"])

    return run


_REGION = "kind int, region long, part int, parts int, a long, b long, n long, d double, ball boolean, copied int"


def _joined(words: int, percent: int):
    """Rows of parts of regions, in order of (region, part, role), pivots first, to links (kind 0: a, b) and, of regions in parts, members of cells (kind 1).

    A cell is named by its pivot a; b is the member, d its distance, ball whether the two are linked, copied whether it is at home elsewhere.
    """

    def settle(key: tuple, pivots: list, members: list, links: list, cells: list) -> None:
        region, part, parts = key
        nodes = np.array([m[0] for m in members], np.int64)
        sets = [m[1] for m in members]
        if not len(nodes):
            return
        pivots = list(dict(pivots).items())
        far, ball = np.array([m[2] for m in members], np.float64), np.array([m[3] for m in members], bool)
        if pivots:
            measured = [_measured(s, sets, percent) for _, s in pivots]
            own, linked = np.array([m[0] for m in measured]), np.array([m[1] for m in measured])
            names = np.array([p for p, _ in pivots], np.int64)
            p, k = np.nonzero(linked)
            links.extend(x for x in zip(names[p].tolist(), nodes[k].tolist(), strict=True) if x[0] != x[1])
        if parts == 1:
            if pivots:
                far, ball = own[0], linked[0]
            side = np.array([m[4] for m in members], np.int64)
            links.extend((int(nodes[i]), int(nodes[j])) for i, j in links_within(sets, percent, far, ball, side))
            return
        if not pivots:  # none was drawn: one cell
            own, linked, names = far[None], ball[None], np.zeros(1, np.int64)
        home = own.argmin(axis=0)
        nearest = own[home, np.arange(len(nodes))]
        for c in range(len(names)):
            there = np.flatnonzero((home == c) | ((names[c] < names[home]) & (own[c] <= nearest + 2 * _reach(percent))))
            cells.extend((region, part, parts, int(names[c]), int(nodes[k]), len(sets[k]), float(own[c, k]), bool(linked[c, k]), int(home[k] != c)) for k in there.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivots, members, links, cells = None, [], [], [], []

        def flushed() -> pa.RecordBatch:
            rows = [(0, 0, 0, 0, a, b, 0, 0.0, True, 0) for a, b in links] + [(1, *c) for c in cells]
            kinds = pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int32()
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in _REGION.split(", ")])

        for batch in sliced(batches, "text"):
            names = ("region", "part", "parts", "role", "node", "d", "ball", "side")
            sets = []
            for _, _, raw, at in pieces(*text_bytes(batch.column("text"))):
                hashes, first = shingle_sets(raw, at, words)
                sets.extend(hashes[a:b].copy() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            for k, (region, part, parts, role, node, d, ball, side) in enumerate(zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
                if key != (region, part, parts):
                    if key:
                        settle(key, pivots, members, links, cells)
                    key, pivots, members = (region, part, parts), [], []
                if role:
                    members.append((node, sets[k], float("nan") if d is None else d, bool(ball), side))
                else:
                    pivots.append((node, sets[k]))
            if len(links) + len(cells) > 1 << 14:
                yield flushed()
                links, cells = [], []
        if key:
            settle(key, pivots, members, links, cells)
        yield flushed()

    return run


def _in_blocks(sized: DataFrame) -> DataFrame:
    """Members of regions that pivots can't cut: each block of a region with each other one, and with itself, is a region of one part."""
    blocks = (2 * F.col("parts")).cast("int")
    own = F.pmod(F.xxhash64("b", F.lit(5)), blocks).cast("int")
    with_ = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    rows = sized.withColumns({"_blocks": blocks, "_own": own}).select("*", with_)
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(low == high, 0).otherwise(F.when(F.col("_own") == low, 1).otherwise(2))
    return rows.select(
        F.xxhash64("region", low, high).alias("region"), "b", "n", F.lit(None).cast("double").alias("d"), F.lit(False).alias("ball"),
        side.alias("side"), F.lit(1).alias("parts"), F.lit(0).cast("long").alias("many"), F.lit(0).cast("long").alias("before"),
    )


def region_links(met: DataFrame, texts: DataFrame, words: int, percent: int, most_shingles: int = REGION_SHINGLES, most_sets: int = REGION_SETS) -> list[DataFrame]:
    """Tables of links (a, b) that join the members of the regions (a: pivot, b: set, n: its size) into components."""
    n, links, reach = partitions(met.sparkSession), [], _reach(percent)
    members = met.select(
        F.col("a").alias("region"), "b", "n", F.lit(None).cast("double").alias("d"), F.lit(False).alias("ball"), F.lit(0).alias("side"),
        F.lit(1 << 62).alias("before"),
    )
    depth = 0
    while True:
        sized = with_group(members, ["region"], "b", total=(F.sum, F.col("n")), many=(F.sum, F.lit(1)))
        parts = F.greatest(F.ceil(F.col("total") / most_shingles), F.ceil(F.col("many") / most_sets)).cast("int")
        sized = sized.select("region", "b", "n", "d", "ball", "side", parts.alias("parts"), "many", "before")
        if depth > 1:  # cells of drawn pivots: those that kept most of their region are not cut again
            sized = written(sized, "cells")
            stuck = (F.col("parts") > 1) & ((F.col("many") > 0.7 * F.col("before")) | F.lit(depth > 6))
            sized = sized.where(~stuck).unionByName(_in_blocks(sized.where(stuck)))
        part = F.pmod(F.xxhash64("b", F.lit(depth)), F.col("parts")).cast("int")
        asked = sized.select("region", part.alias("part"), "parts", F.lit(1).alias("role"), F.col("b").alias("id"), "d", "ball", "side")
        if depth:
            pivots = sized.where((F.col("parts") > 1) & (F.pmod(F.xxhash64("b", F.lit(depth + 100)), F.col("many")) < PIVOTS)).select("region", "parts", F.col("b").alias("id"))
        else:
            pivots = sized.groupBy("region").agg(F.max("parts").alias("parts")).select("region", "parts", F.col("region").alias("id"))
        everywhere = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        pivots = pivots.select("region", everywhere, "parts", F.lit(0).alias("role"), "id", F.lit(None).cast("double").alias("d"), F.lit(True).alias("ball"), F.lit(0).alias("side"))
        rows = asked.unionByName(pivots).join(texts.hint("merge"), F.col("id") == F.col("node"))
        rows = rows.select("region", "part", "parts", "role", "node", "d", "ball", "side", "text")
        rows = rows.repartition(n, "region", "part").sortWithinPartitions("region", "part", "parts", "role", "node")
        found = written(rows.mapInArrow(_joined(words, percent), _REGION), "joined")
        links.append(found.where("kind = 0").select("a", "b"))
        cells = found.where("kind = 1")
        if cells.isEmpty():
            return links
        sizes = with_group(cells, ["region"], "b", many=(F.sum, 1 - F.col("copied"))).select("region", "a", "b", "n", "d", "ball", "copied", F.col("many").alias("before"))
        sizes = sizes.withColumn("cell", F.xxhash64("region", "a", F.lit(depth)))
        sizes = with_group(
            written(sizes, "homes"), ["cell"], "b", radius=(F.max, F.when(F.col("copied") == 0, F.col("d"))), outside=(F.min, F.when(~F.col("ball"), F.col("d"))),
        )
        # nothing is outside of the ball: done; else of the ball stays what may be linked with what is outside
        near = ~F.col("ball") | (F.col("d") >= F.col("outside") - reach)
        kept = sizes.where((F.col("d") <= F.col("radius") + reach) & F.col("outside").isNotNull() & near)
        members = written(kept.select(F.col("cell").alias("region"), "b", "n", "d", "ball", F.col("copied").alias("side"), "before"), "members")
        depth += 1


def jaccard_join(
    docs: DataFrame, words: int = 5, percent: int = 80, most_shingles: int = REGION_SHINGLES, most_sets: int = REGION_SETS
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest id reachable over links of at least percent / 100.

    A region of more than most_shingles shingles or most_sets sets is cut by pivots of its own.
    """
    if not 0 < percent <= 100 or words < 1:
        raise ValueError("percent must be above 0 and at most 100, words at least 1")
    n = partitions(docs.sparkSession)
    with scratch(docs.sparkSession):
        found = written(_slices(docs, words, percent, min(n, 1 << 16)).repartition(n, "bucket").mapInArrow(_answered, _SLICE), "slices")
        slices = found.where("kind = 1")
        answers = found.where("kind = 0").groupBy(F.col("slice").alias("of")).agg(F.collect_list("a").alias("answers"), F.collect_list("b").alias("same"))
        asked = slices.select("slice", "b", "c", "d").join(answers.hint("merge"), F.col("slice") == F.col("of"), "left").drop("of")
        met = written(asked.mapInArrow(_met, _MET), "met")
        nodes = slices.select("slice", "b").mapInArrow(_nodes, "node long, doc_id long, one long, two long")
        pairs = met.where("kind = 0").select("a", "b", "n")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct().join(nodes.hint("merge"), F.col("w") == F.col("node")).select("node", F.col("doc_id").alias("asked"), "one", "two")
        with scratch(docs.sparkSession):  # texts and links go as soon as components are known
            texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            # merged at every size: ids asked for grow with the corpus
            held = texts.join(wanted.hint("merge"), F.col("doc_id") == F.col("asked")).select("node", "one", "two", "text")
            asked_for = written(held.mapInArrow(_texts_of(words), "node long, text string"), "texts")
            links = [*region_links(pairs, asked_for, words, percent, most_shingles, most_sets), met.where("kind = 1").select("a", "b")]
            roots = components(functools.reduce(DataFrame.unionByName, links))
            named = written(roots.join(nodes.select(F.col("node").alias("own"), "doc_id").hint("merge"), F.col("node") == F.col("own")).select("node", "root", "doc_id"), "named", keep=True)
        least = with_group(named, ["root"], "node", least=(F.min, F.col("doc_id"))).select(F.col("node").alias("of"), "least")
        rows = slices.select("slice", "a", "b").mapInArrow(_rows, "doc_id long, n_shingles long, node long, alone long")
        # rows without a node have keys of their own, which no node has, so that they are no hot key
        keyed = rows.withColumn("key", F.coalesce("node", -F.monotonically_increasing_id() - 1))
        linked = keyed.join(least.hint("merge"), F.col("key") == F.col("of"), "left")
        return written(linked.select("doc_id", "n_shingles", F.coalesce("least", "alone").alias("component_id")), "classes", keep=True)


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of rows, all columns: that of the smallest id, of equal ids the one whose columns hash least.

    Rows are joined by a key of their own, so copies with one id or none are one group, and an id
    that has several texts is judged text by text. A row without an id never takes the place of one
    that has an id, nor the other way round: of a component's rows without an id, one stays as well.
    """
    with scratch(docs.sparkSession):
        key = fresh(docs, "row")
        keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed", keep=True)
        of = F.col("doc_id").cast("long")
        content = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
        found = jaccard_join(keyed.select(F.col(key).alias("doc_id"), "text"), words, percent)
        found = found.select(F.col("doc_id").alias("_row"), "component_id")
        rows = keyed.select(F.col(key).alias("_own"), of.alias("_id"), content.alias("_content"))
        placed = rows.join(found.hint("merge"), F.col("_own") == F.col("_row"))
        first = F.min(F.struct("_id", "_content", "_own")).alias("first")
        stay = placed.groupBy("component_id", F.col("_id").isNull().alias("_none")).agg(first).select(F.col("first._own").alias("_stay"))
        stay = written(stay, "stay", keep=True)
        return keyed.join(stay.hint("merge"), F.col(key) == F.col("_stay"), "left_semi").drop(key)
