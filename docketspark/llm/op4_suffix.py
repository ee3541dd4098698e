"""Suffix-array dedup over an index compressed by the runs of its Burrows-Wheeler transform, for the whole corpus.

A string of `length` bytes is removed where it also starts earlier. One index of the whole corpus
cannot be held, so the strings are dealt to shards by content: every string belongs to its
minimizer, the least hashed k-gram in it, so equal strings meet in one shard, whichever documents
hold them. The run of strings that one minimizer owns, with the bytes they cover, is a context.

1. Anchors: contexts are found in each batch; a context that repeats one of its batch is settled
   (all its strings start earlier too), the others travel as hashes.
2. Meetings: contexts of one minimizer meet. Equal ones are settled by the first; where different
   contexts share a minimizer, the first of each asks for its bytes.
3. Index: the bytes of those contexts are indexed shard by shard: suffix array, Burrows-Wheeler
   transform, its runs. Longest common prefixes are compared byte by byte at run heads only and
   streamed on through the text from there (inside a run, a step back in the text adds one). Where
   the matching length reaches `length`, neighbouring suffixes hold the same string; of each such
   interval all but the earliest start are removed.
4. The removed intervals go back to their documents.

So contexts that are equal as a whole are settled by 64-bit hashes (steps 1 and 2), and the index
decides where strings of different contexts are equal. It is compressed by runs as to what is
compared and sampled; suffix array and ranks of a shard, half a megabyte of text, are plain arrays.

A minimizer whose different contexts have more than `hot_bytes` together (a common line in many
surroundings) isn't one shard's: each of its strings meets its equals by a 128-bit hash, in an
aggregate that is built up before the shuffle and handed back in parts.

Matching statistics say how long a match is, not whether it begins earlier; the minimum of the
sampled starts over each interval decides that.

Defined cases: null text counts as empty; texts shorter than `length` lose nothing; null ids stand
before all others; rows with one id are one document as to order: equal starts in them are not
earlier than one another, and 128 bits of hash tell their texts apart; an empty table gives an empty result; other columns are ignored by the
report and kept by `deduplicated`.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm import kernels
from docketspark.llm.common import partitions, pieces, scratch, sliced, text_bytes, with_group, written

#: Bytes of a minimizer. Longer ones are shared by fewer strings that are not equal, shorter ones leave fewer contexts.
GRAM = 32
#: Bytes of text that a task indexes, or cuts into contexts, at a time; the arrays beside them take many times as much.
SHARD_BYTES = 1 << 19
PIECE_BYTES = 1 << 18
#: Bytes of a minimizer's different contexts up to which one shard indexes them.
HOT_BYTES = 8 << 20
_ORDER = -(1 << 63)


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive keys."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def contexts(raw: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first string's start in the row, number of strings, minimizer hash, context hash) of all contexts."""
    none, width = np.zeros(0, np.int64), min(GRAM, length)
    long = np.diff(at) >= length
    if not long.any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = kernels.prefix_sums(raw)
    place = np.arange(len(raw) - width + 1)
    gram = kernels.range_hash(sums, place, place + width)
    bits = np.uint64(max(24, int(len(raw)).bit_length()))
    keys = ((gram >> bits) << bits) | place.astype(np.uint64)
    least = _sliding_least(keys, length - width + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    size = np.diff(at)[long] - length + 1
    row = np.repeat(np.flatnonzero(long), size)
    start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - at[:-1][long], size)
    owner = least[start].astype(np.int64)
    head = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])])
    count = np.diff(np.append(head, len(owner)))
    first, owner = start[head], owner[head]
    whole = kernels.range_hash(sums, first, first + count + length - 1)
    return row[head], first - at[row[head]], count, gram[owner], kernels.mix(whole + (owner - first).astype(np.uint64))


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of intervals of each doc, in order."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    number = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    lift = number * (int(end.max()) + 2)  # running maxima must not pass from one doc to the next
    reach = np.maximum.accumulate(end + lift)
    head = np.flatnonzero(np.r_[True, start[1:] + lift[1:] > reach[:-1]])
    return doc[head], start[head], (reach - lift)[np.append(head[1:], len(doc)) - 1]


_ANCHOR = np.dtype([("gram", "<u4"), ("gram2", "<u2"), ("context", "<u8"), ("start", "<i4"), ("count", "<u2")])
#: Rows of one id are told apart by 128 bits of their text: tag and also.
_DOC = np.dtype([("key", "<i8"), ("tag", "<i8"), ("also", "<i8"), ("n", "<i4")])
_PART = np.dtype([("key", "<i8"), ("tag", "<i8"), ("also", "<i8"), ("start", "<i4"), ("end", "<i4")])
_ROW = ("key", "tag", "also")


def _blobs(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), 256):
        some = rows[k : k + 256]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in some], pa.int32()), pa.array([x[1] for x in some], pa.int32()), pa.array([x[2] for x in some], pa.binary())],
            ["bucket", "kind", "blob"],
        )


_BLOB = "bucket int, kind int, blob binary"


def _anchors(length: int, buckets: int):
    """Rows (key, tag, also, text) to blobs: anchors by minimizer (kind 0), intervals settled in the batch (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            key, tag, also = (batch.column(c).to_numpy(zero_copy_only=False) for c in _ROW)
            found = []
            for i, _, raw, at in pieces(*text_bytes(batch.column("text")), PIECE_BYTES):
                row, *rest = contexts(raw, at, length)
                found.append((row + i, *rest))
            if not found:
                continue
            row, start, count, gram, context = map(np.concatenate, zip(*found, strict=True))
            order = np.lexsort((start, key[row], context, gram))
            row, start, count, gram, context = (x[order] for x in (row, start, count, gram, context))
            new = np.r_[True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])][: len(row)]
            head = np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
            later = (key[row] != key[row[head]]) | (start != start[head])
            again = ~new & ~later  # the same start of the same id: a repeated row, which goes along with the first
            out = []
            d, s, e = merged(row[later], start[later], (start + count + length - 1)[later])
            if len(d):
                part = np.zeros(len(d), _PART)
                part["key"], part["tag"], part["also"], part["start"], part["end"] = key[d], tag[d], also[d], s, e
                out.append((int(key[0]) % buckets, 1, part.tobytes()))
            keep = new | again
            row, start, count, gram, context = (x[keep] for x in (row, start, count, gram, context))
            bucket = ((gram & np.uint64(0xFFFF)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((start, row, bucket))
            row, start, count, gram, context, bucket = (x[order] for x in (row, start, count, gram, context, bucket))
            anchor = np.zeros(len(row), _ANCHOR)
            anchor["gram"], anchor["gram2"] = gram >> np.uint64(32), (gram >> np.uint64(16)) & np.uint64(0xFFFF)
            anchor["context"], anchor["start"], anchor["count"] = context, start, count
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(row) else np.zeros(1, np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = row[a:b]
                heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                doc = np.zeros(len(heads), _DOC)
                doc["key"], doc["tag"], doc["also"], doc["n"] = key[own[heads]], tag[own[heads]], also[own[heads]], np.diff(np.append(heads, b - a))
                body = b"".join(np.ascontiguousarray(anchor[a:b][f]).tobytes() for f in _ANCHOR.names)
                out.append((int(bucket[a]), 0, len(doc).to_bytes(8, "little") + doc.tobytes() + body))
            yield from _blobs(out)

    return run


def _read_anchors(blob: bytes, bucket: int) -> tuple[np.ndarray, ...]:
    docs = int.from_bytes(blob[:8], "little")
    doc = np.frombuffer(blob, _DOC, docs, 8)
    at = 8 + docs * _DOC.itemsize
    n = (len(blob) - at) // _ANCHOR.itemsize
    columns = []
    for f in _ANCHOR.names:
        kind = _ANCHOR[f]
        columns.append(np.frombuffer(blob, kind, n, at))
        at += n * kind.itemsize
    gram = (columns[0].astype(np.uint64) << np.uint64(32)) | (columns[1].astype(np.uint64) << np.uint64(16)) | np.uint64(bucket & 0xFFFF)
    return (*(np.repeat(doc[c], doc["n"]) for c in _ROW), gram, columns[2], columns[3].astype(np.int64), columns[4].astype(np.int64))


_MET = "kind int, key long, tag long, also long, start int, size int, gram long"


def _meetings(length: int):
    """Blobs to rows: settled intervals (kind 1: start, size) and asked contexts (kind 0: start, number of strings, minimizer)."""

    def emit(kind, key, tag, also, start, size, gram) -> pa.RecordBatch:
        columns = [np.full(len(key), kind), key, tag, also, start, size, gram]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds, strict=True)], ["kind", *_ROW, "start", "size", "gram"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for bucket, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    found.append(_read_anchors(blob, bucket))
                    continue
                part = np.frombuffer(blob, _PART)
                yield emit(1, *(part[c] for c in _ROW), part["start"], part["end"] - part["start"], part["key"] * 0)
        if not found:
            return
        key, tag, also, gram, context, start, count = map(np.concatenate, zip(*found, strict=True))
        del found
        order = np.lexsort((context, gram))
        # most minimizers come once; only the others need the order of their documents
        g = gram[order]
        alone = np.r_[True, g[1:] != g[:-1]] & np.r_[g[1:] != g[:-1], True]
        order = order[~alone]
        order = order[np.lexsort((start[order], key[order], context[order], gram[order]))]
        key, tag, also, gram, context, start, count = (x[order] for x in (key, tag, also, gram, context, start, count))
        if not len(key):
            return
        new_gram = np.r_[True, gram[1:] != gram[:-1]]
        new = new_gram | np.r_[True, context[1:] != context[:-1]]
        head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        later = (key != key[head]) | (start != start[head])
        for a in range(0, int(later.sum()), 1 << 16):
            x = np.flatnonzero(later)[a : a + (1 << 16)]
            yield emit(1, key[x], tag[x], also[x], start[x], count[x] + length - 1, gram[x] * 0)
        group = np.cumsum(new_gram) - 1
        several = np.bincount(group, new) > 1
        asked = np.flatnonzero(new & several[group])
        for a in range(0, len(asked), 1 << 16):
            x = asked[a : a + (1 << 16)]
            yield emit(0, key[x], tag[x], also[x], start[x], count[x], gram[x].view(np.int64))

    return run


def _strings(length: int):
    """Rows (key, tag, also, text, asked) to (key, tag, also, start, one, two): every string of the asked contexts and two hashes of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in _ROW]
            raw, at = text_bytes(batch.column("text"))
            for i, asked in enumerate(batch.column("asked")):
                for want in asked.as_py():
                    start, n = want["start"], want["size"]
                    sums = kernels.prefix_sums(raw[at[i] + start : at[i] + start + n + length - 1])
                    place = np.arange(n)
                    # the second hash is one of the same bytes, mixed before they are summed
                    other = kernels.prefix_sums(_SECOND[raw[at[i] + start : at[i] + start + n + length - 1]])
                    one, two = (kernels.range_hash(x, place, place + length).view(np.int64) for x in (sums, other))
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.full(n, c[i]), pa.int64()) for c in own), pa.array(place + start, pa.int32()), pa.array(one), pa.array(two)],
                        [*_ROW, "start", "one", "two"],
                    )

    return run


#: A fixed permutation of the byte values.
_SECOND = np.random.default_rng(4).permutation(256).astype(np.uint8)


def _fetched(length: int, buckets: int):
    """Rows (key, tag, also, text, asked) to blobs of contexts by minimizer: what the index is built of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[int, list[bytes]] = {}
            own = [batch.column(c).to_pylist() for c in _ROW]
            raw, at = text_bytes(batch.column("text"))
            raw = raw.tobytes()
            for i, asked in enumerate(batch.column("asked")):
                for want in asked.as_py():
                    gram, start, n = want["gram"], want["start"], want["size"]
                    body = raw[at[i] + start : at[i] + start + n + length - 1]
                    head = np.array([gram, *(c[i] for c in own), start, n], np.int64).tobytes()
                    out.setdefault((gram & 0xFFFF) % buckets, []).append(head + body)
            yield from _blobs([(k, 0, b"".join(v)) for k, v in sorted(out.items())])

    return run


def _sorted_pairs(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in order of (high, low, place), whether each differs from the one before in high or low); low has `bits` bits.

    Where both and the place fit in 64 bits they are sorted as one number, several times faster than by argsort.
    """
    n = len(high)
    key = (high.astype(np.uint64) << np.uint64(bits)) | low.astype(np.uint64)
    wide = n.bit_length()
    if n and int(key.max()).bit_length() + wide <= 64:
        packed = np.sort((key << np.uint64(wide)) | np.arange(n, dtype=np.uint64))
        order, key = (packed & np.uint64((1 << wide) - 1)).astype(np.int64), packed >> np.uint64(wide)
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    return order, key[1:] != key[:-1]


def suffix_array(text: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of suffixes that end at `until`; equal ones in order of their place. By doubling."""
    n, depth = len(text), 4
    place = np.arange(n)
    left = until - place
    code = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    for k in range(depth):  # 9 bits for each byte, so that an end sorts before any byte
        code = (code << 9) | np.where(left > k, padded[k : k + n].astype(np.int64) + 1, 0)
    order, new = _sorted_pairs(code, np.zeros(n, np.int64), 0)
    rank, longest = np.empty(n, np.int64), int(left.max()) if n else 0
    rank[order] = np.r_[0, np.cumsum(new)][:n]
    while depth < longest and not new.all():
        following = np.where(left > depth, rank[np.minimum(place + depth, n - 1)] + 1, 0)
        order, new = _sorted_pairs(rank, following, n.bit_length())
        rank[order] = np.r_[0, np.cumsum(new)]
        depth *= 2
    rank[order] = place
    return order, rank


class RunIndex:
    """A run-compressed Burrows-Wheeler transform of several strings, with sampled run heads."""

    def __init__(self, text: np.ndarray, ends: np.ndarray):
        """ends: the end of each string in text, ascending."""
        self.text, n = text, len(text)
        starts = np.r_[0, ends[:-1]]
        self.until = np.repeat(ends, ends - starts)
        self.order, self.rank = suffix_array(text, self.until)
        first = np.zeros(n, bool)
        first[starts] = True
        # strings' starts have no byte before them: 256, and every such row is a run of its own
        before = np.where(first, 256, text[np.arange(n) - 1].astype(np.int64))[self.order]
        self.heads = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (before[1:] == 256)])

    def common_with_predecessor(self) -> np.ndarray:
        """For each place, the longest common prefix with the suffix one rank below; compared at run heads only.

        Inside a run the suffix and its predecessor follow the same byte, so one place earlier both
        ranks are neighbours again and the common prefix is one longer: values stream through the
        text from the sampled places.
        """
        n = len(self.text)
        inside = np.ones(n, bool)
        inside[self.heads] = False
        sampled = np.ones(n, bool)
        sampled[self.order[inside]] = False  # value(p) = value(p - 1) - 1
        value = np.zeros(n, np.int64)
        at = np.flatnonzero(sampled)
        at = at[self.rank[at] > 0]
        other = self.order[self.rank[at] - 1]
        todo, depth = np.arange(len(at)), 0
        most = np.minimum(self.until[at] - at, self.until[other] - other)
        while len(todo):
            going = depth < most[todo]
            todo = todo[going]
            same = self.text[at[todo] + depth] == self.text[other[todo] + depth]
            todo = todo[same]
            value[at[todo]] += 1
            depth += 1
        last = np.maximum.accumulate(np.where(sampled, np.arange(n), 0))
        return value[last] - (np.arange(n) - last)

    def classes(self, length: int) -> np.ndarray:
        """For each place, the earliest place with the same `length` bytes; -1 where fewer are left."""
        common = self.common_with_predecessor()[self.order]
        head = np.flatnonzero(common < length) if len(common) else np.zeros(0, np.int64)
        least = np.minimum.reduceat(self.order, head) if len(head) else head
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.repeat(least, np.diff(np.append(head, len(self.order))))
        out[self.until - np.arange(len(out)) < length] = -1
        return out


def _indexed(length: int):
    """Blobs of contexts to settled intervals (key, tag, also, start, size)."""

    def settle(group: list[tuple]) -> pa.RecordBatch | None:
        group.sort(key=lambda c: (c[1], c[4]))
        text = np.frombuffer(b"".join(c[6] for c in group), np.uint8)
        ends = np.cumsum([len(c[6]) for c in group])
        head = np.array([c[1:6] for c in group], np.int64)
        earliest = RunIndex(text, ends).classes(length)
        of = np.repeat(np.arange(len(group)), np.diff(np.r_[0, ends]))
        place = np.flatnonzero((earliest >= 0) & (earliest != np.arange(len(text))))
        first, where = earliest[place], lambda p: head[of[p], 3] + p - np.r_[0, ends][of[p]]
        place = place[(head[of[place], 0] != head[of[first], 0]) | (where(place) != where(first))]
        d, s, e = merged(of[place], where(place), where(place) + length)
        if not len(d):
            return None
        return pa.RecordBatch.from_arrays(
            [*(pa.array(head[d, k], pa.int64()) for k in range(3)), pa.array(s, pa.int32()), pa.array(e - s, pa.int32())],
            [*_ROW, "start", "size"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                at = 0
                while at < len(blob):
                    gram, key, tag, also, start, n = np.frombuffer(blob, np.int64, 6, at).tolist()
                    at += 48
                    found.append((gram, key, tag, also, start, n, blob[at : at + n + length - 1]))
                    at += n + length - 1
        found.sort(key=lambda c: c[0])
        group: list[tuple] = []
        size = 0
        for k, c in enumerate(found):
            group.append(c)
            size += len(c[6])
            if k + 1 == len(found) or size >= SHARD_BYTES and found[k + 1][0] != c[0]:
                if (settled := settle(group)) is not None:
                    yield settled
                group, size = [], 0

    return run


def _with_spans(docs: DataFrame, length: int, hot_bytes: int) -> DataFrame:
    """docs' columns and `_spans`: the removed intervals (start, size) of each row, unordered, null if none."""
    if not 1 <= length < 1 << 15:
        raise ValueError("length must be from 1 to 32767 bytes")
    n = partitions(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    tags = {"_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(_ORDER)), "_tag": F.xxhash64(text), "_also": F.xxhash64(F.lit(7), text)}
    keyed = docs.withColumns(tags)
    names = dict(zip(tags, _ROW, strict=True))
    texts = keyed.select(*tags, "text").withColumnsRenamed(names)
    same = lambda: functools.reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in names.items()])
    with scratch(docs.sparkSession):
        anchors = texts.mapInArrow(_anchors(length, n), _BLOB).repartition(n, "bucket")
        met = written(anchors.mapInArrow(_meetings(length), _MET), "meetings")
        wanted = met.where("kind = 0").select("gram", *_ROW, "start", "size")
        sized = written(with_group(wanted, ["gram"], "start", total=(F.sum, F.col("size") + length - 1)), "wanted")

        def with_texts(contexts_: DataFrame) -> DataFrame:
            asked = contexts_.groupBy(*_ROW).agg(F.collect_list(F.struct("gram", "start", "size")).alias("asked"))
            found = keyed.repartition(n, *tags).join(asked, same())
            return found.select(*_ROW, "text", "asked").dropDuplicates([*_ROW])

        shards = with_texts(sized.where(F.col("total") <= hot_bytes)).mapInArrow(_fetched(length, n), _BLOB).repartition(n, "bucket")
        spans = shards.mapInArrow(_indexed(length), "key long, tag long, also long, start int, size int").unionByName(met.where("kind = 1").select(*_ROW, "start", "size"))
        hot = sized.where(F.col("total") > hot_bytes)
        if not hot.isEmpty():
            strings = written(with_texts(hot).mapInArrow(_strings(length), "key long, tag long, also long, start int, one long, two long"), "strings")
            strings = with_group(strings, ["one", "two"], "key", first=(F.min, F.struct("key", "start")))
            spans = spans.unionByName(strings.where(F.struct("key", "start") > F.col("first")).select(*_ROW, "start", F.lit(length).alias("size")))
        spans = written(spans.groupBy(*_ROW).agg(F.collect_list(F.struct("start", "size")).alias("_spans")), "spans", keep=True)
    return keyed.join(spans, same(), "left").drop(*_ROW)


def _cut(spans: pa.Array, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """(starts, ends, remaining bytes) of each row."""
    for i, own in enumerate(spans):
        text = raw[at[i] : at[i + 1]]
        if not own.is_valid:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64), text.tobytes()
            continue
        values = own.values
        start = values.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
        size = values.field("size").to_numpy(zero_copy_only=False).astype(np.int64)
        _, s, e = merged(np.zeros(len(start), np.int64), start, start + size)
        change = np.zeros(len(text) + 1, np.int64)
        change[s] += 1
        change[e] -= 1
        yield s, e, text[np.cumsum(change[:-1]) == 0].tobytes()


def removals(docs: DataFrame, length: int = 100, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column("text"))
            rows = [(int((e - s).sum()), len(s), hashlib.sha256(kept).hexdigest()) for s, e, kept in _cut(batch.column("_spans"), raw, at)]
            removed, spans, digest = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = _with_spans(rows, length, hot_bytes).select("doc_id", "text", "_spans")
    return marked.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame, length: int = 100, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """The rows of docs, all columns, with the removed bytes cut out of `text`.

    Bytes of a character that a cut leaves incomplete go too; an `n_chars` column follows the new text;
    null texts stay null.
    """
    own = [c if c in ("doc_id", "text") else f"x{k}" for k, c in enumerate(docs.columns)]
    rows = docs.toDF(*own)  # no column of the caller's can clash with those of the plan

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            kept = [k.decode("utf-8", "ignore") for _, _, k in _cut(batch.column("_spans"), *text_bytes(column))]
            text = pa.array([k if v else None for k, v in zip(kept, column.is_valid().to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([text if c == "text" else batch.column(c) for c in own], own)

    out = _with_spans(rows, length, hot_bytes).select(*own, "_spans").mapInArrow(run, rows.schema).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
