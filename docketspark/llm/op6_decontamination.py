"""Benchmark decontamination with suffix arrays over shards of the training texts.

A shard is an Arrow batch of documents. Its words become ranks in the benchmark's vocabulary, and
its suffix array sorts the suffixes that start like some benchmark window (no other suffix can hold
one). Every suffix of every test item, cut at `window` words, is binary-searched in the array; the
range it finds are its verbatim occurrences, which give hit words, items, and, joined along
diagonals, the longest matches with their places.

The benchmark is broadcast in blocks of `block_bytes` of text at most, one pass over the documents
for each block, and passes carry what earlier ones found; usually there is one.

Defined cases: null texts have no words; items without words have no window; an item of fewer than
`window` words is one window; an item with a null id marks words but is not counted or named;
repeated rows are judged alike; with an empty benchmark nothing is hit; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm import kernels
from docketspark.llm.common import fresh, pieces, text_bytes, written

#: Text of the benchmark that is broadcast at a time; as windows in arrays it takes about twenty times as much while it is built.
BLOCK_BYTES = 8 << 20
NO_ITEMS = hashlib.sha256(b"").hexdigest()


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets of each row's first word)."""
    hashes, firsts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, _, raw, at in pieces(*text_bytes(column)):
        low = kernels.LOWER[raw]
        start, end, first = kernels.words(low, at, kernels.ALNUM)
        hashes.append(kernels.range_hash(kernels.prefix_sums(low), start, end))
        firsts.append(first[1:] + firsts[-1][-1])
    return np.concatenate(hashes), np.concatenate(firsts)


@dataclass
class Queries:
    """The test suffixes of one block: distinct windows as rows of word ranks (1, 2, ...; 0 past the end), all in arrays."""

    vocabulary: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    leads: np.ndarray  # the first one or two words of each window, packed
    starts: np.ndarray  # the distinct ones of them, sorted
    names: list[str]  # the items that have an id
    window_of: np.ndarray  # (window, item, first word) of each place, by window; items without an id have none
    item_of: np.ndarray
    word_of: np.ndarray
    first_of: np.ndarray  # offsets of each window's places

    def places(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into `window`, place) of all places of these windows."""
        count = self.first_of[window + 1] - self.first_of[window]
        which = np.repeat(np.arange(len(window)), count)
        return which, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - self.first_of[window], count)


def queries_of(rows: list[tuple], window: int) -> Queries:
    """Test suffixes of (item_id, text) rows."""
    hashes, first = word_hashes(pa.array([r[1] for r in rows], pa.large_string()))
    vocabulary = np.unique(hashes)
    rank = np.concatenate([np.searchsorted(vocabulary, hashes).astype(np.uint32) + np.uint32(1), np.zeros(window, np.uint32)])
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(n - window + 1, 1), 0)
    item = np.repeat(np.arange(len(rows)), count)
    word = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = first[:-1][item] + word
    found = rank[start[:, None] + np.arange(window)]
    found[np.arange(window) >= (first[1:][item] - start)[:, None]] = 0
    windows, of = np.unique(found, axis=0, return_inverse=True)
    of = of.reshape(-1)
    lengths = (windows > 0).sum(axis=1)
    depth = 1 if len(lengths) and lengths.min() == 1 else 2
    leads = windows[:, 0].astype(np.int64) << 32 | (windows[:, 1] if depth == 2 and window > 1 else 0) if len(windows) else np.zeros(0, np.int64)
    named = np.array([r[0] is not None for r in rows], bool)
    names = [str(r[0]) for r in rows if r[0] is not None]
    own = named[item] if len(item) else np.zeros(0, bool)
    number = np.cumsum(named) - 1
    order = np.argsort(of[own], kind="stable")
    window_of = of[own][order]
    first_of = np.searchsorted(window_of, np.arange(len(windows) + 1))
    return Queries(vocabulary, windows, lengths, leads, np.unique(leads), names, window_of, number[item[own]][order].astype(np.int32), word[own][order].astype(np.int32), first_of)


def _keys(ranks: np.ndarray) -> np.ndarray:
    """Rows of ranks as byte strings that sort like the rows."""
    n, w = ranks.shape
    return np.ascontiguousarray(ranks.astype(">u4")).view(f"S{4 * w}").reshape(n)


def search(q: Queries, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, window) of all occurrences of the windows in a shard's words, none across rows."""
    none = np.zeros(0, np.int64)
    if not len(hashes) or not len(q.windows):
        return none, none
    w = q.windows.shape[1]
    at = np.minimum(np.searchsorted(q.vocabulary, hashes), len(q.vocabulary) - 1)
    rank = np.zeros(len(hashes) + w, np.uint32)
    rank[:-w] = np.where(q.vocabulary[at] == hashes, at + 1, 0)
    row_end = np.repeat(first[1:], np.diff(first))
    suffix = np.flatnonzero(rank[: len(hashes)])
    lead = rank[suffix].astype(np.int64) << 32
    if (q.starts & 0xFFFFFFFF).any():
        lead |= np.where(suffix + 1 < row_end[suffix], rank[suffix + 1], 0)
    near = np.minimum(np.searchsorted(q.starts, lead), len(q.starts) - 1)
    met = q.starts[near] == lead
    suffix = suffix[met]
    asked = np.flatnonzero(np.isin(q.leads, np.unique(lead[met])))  # no other window can be here
    ranks = rank[suffix[:, None] + np.arange(w)]
    ranks[suffix[:, None] + np.arange(w) >= row_end[suffix][:, None]] = 0
    keys = _keys(ranks)
    order = np.argsort(keys, kind="stable")  # the suffix array
    keys, suffix = keys[order], suffix[order]
    last = np.where(np.arange(w) < q.lengths[asked][:, None], q.windows[asked], np.uint32(0xFFFFFFFF))
    low, high = np.searchsorted(keys, _keys(q.windows[asked]), "left"), np.searchsorted(keys, _keys(last), "right")
    count = high - low
    which = np.repeat(asked, count)
    return suffix[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)], which


def _judged(q: Queries, column: pa.Array, earlier: tuple[pa.Array, pa.Array] | None):
    """(words of each row, whether each word is hit, offsets, ids of each row) with what earlier passes found."""
    hashes, first = word_hashes(column)
    place, which = search(q, hashes, first)
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + q.lengths[which], -1)
    hit = np.cumsum(change)[:-1] > 0
    row = np.searchsorted(first, place, "right") - 1
    items: list[set] = [set() for _ in range(len(first) - 1)]
    at, place_of = q.places(which)
    if len(at):
        for r, k in np.unique(np.stack([row[at], q.item_of[place_of]]), axis=1).T.tolist():
            items[r].add(q.names[k])
    if earlier is not None:
        old = earlier[0].to_pylist()
        hit |= np.concatenate([np.frombuffer(x, bool) for x in old]) if old else hit
        for mine, found in zip(items, earlier[1].to_pylist(), strict=True):
            mine.update(found)
    return hit, first, items


def _blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """The benchmark's queries, block by block; each is collected and broadcast alone."""
    rows = benchmark.select("item_id", "text").where(F.length("text") > 0)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        found = sorted(map(tuple, part.distinct().collect()), key=lambda r: (str(r[0]), r[1]))
        yield docs_broadcast(benchmark, queries_of(found, window)), k == n - 1


def docs_broadcast(df: DataFrame, value):
    return df.sparkSession.sparkContext.broadcast(value)


def _passes(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, final, schema) -> DataFrame:
    """Runs one pass for each block; the last one hands every batch and what was found to `final`."""
    rows, hits, ids = docs, fresh(docs, "hit"), fresh(docs, "items")

    def make(shared, last: bool, later: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _judged(shared.value, batch.column("text"), (batch.column(hits), batch.column(ids)) if later else None)
                if last:
                    yield final(batch, *found)
                    continue
                hit, first, items = found
                kept = [c for c in batch.schema.names if c not in (hits, ids)]
                own = [hit[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(own, pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    [*kept, hits, ids],
                )

        return run

    later = False
    for shared, last in _blocks(benchmark, window, block_bytes):
        if last:
            return rows.mapInArrow(make(shared, True, later), schema)
        carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {hits} binary, {ids} array<string>"
        rows, later = written(rows.mapInArrow(make(shared, False, later), carried), "pass"), True
    raise AssertionError("there is a last block")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs."""

    def final(batch, hit, first, items) -> pa.RecordBatch:
        n_hit = kernels.row_sums(hit.astype(np.int64), first).astype(np.int64)
        digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() if x else NO_ITEMS for x in items]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(first), pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array(digest, pa.string()),
                pa.array(n_hit > 0, pa.bool_()),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _passes(rows, benchmark, window, block_bytes, final, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, that hold no window of the benchmark."""
    names = docs.columns

    def final(batch, hit, first, items) -> pa.RecordBatch:
        clean = kernels.row_sums(hit.astype(np.int64), first) == 0
        return batch.select(names).filter(pa.array(clean))

    return _passes(docs, benchmark, window, block_bytes, final, docs.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, doc_word, item_word, n_words: maximal verbatim matches of at least `window` words (or whole short items).

    One pass over the documents for each block of the benchmark; an item is in one block as a whole,
    so a match is found in one pass.
    """

    def make(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for batch in batches:
                hashes, first = word_hashes(batch.column("text"))
                place, which = search(q, hashes, first)
                at, of = q.places(which)
                row = (np.searchsorted(first, place, "right") - 1)[at]
                start, item = (place[at] - first[row]), q.item_of[of].astype(np.int64)
                diagonal, length = start - q.word_of[of], q.lengths[which[at]]
                order = np.lexsort((start, diagonal, item, row))
                row, start, item, diagonal, length = (x[order] for x in (row, start, item, diagonal, length))
                # windows of one diagonal that touch are one match
                head = np.ones(len(row), bool)
                head[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (start[1:] > start[:-1] + length[:-1])
                cut = np.flatnonzero(head)
                end = np.maximum.reduceat(start + length, cut) if len(cut) else cut
                names = pa.array(q.names, pa.string()).take(pa.array(item[cut]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row[cut])), names, *(pa.array(x.astype(np.int64), pa.int64()) for x in (start[cut], start[cut] - diagonal[cut], end - start[cut]))],
                    ["doc_id", "item_id", "doc_word", "item_word", "n_words"],
                )

        return run

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "doc_id long, item_id string, doc_word long, item_word long, n_words long"
    passes = [ids.mapInArrow(make(shared), shape) for shared, _ in _blocks(benchmark, window, block_bytes)]
    return functools.reduce(DataFrame.unionByName, passes).distinct()
