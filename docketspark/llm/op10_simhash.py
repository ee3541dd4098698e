"""Document fingerprints: SimHash of 128 bits, and the search for fingerprints within a Hamming radius.

Terms are lower-cased words and pairs of neighbouring words, weighted by log(1 + occurrences) times
a length factor, so that neither a repeated word nor short function words decide the vote. The 128
hash bits of each term vote with its weight on the signed bits.

Defined cases: null text counts as empty, an empty text has fingerprint 0; null ids stand before
all others; rows with one id are documents of their own, in the order of their text; a table of one
row is followed by itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from docketspark.llm import kernels
from docketspark.llm.common import fresh, partitions, pieces, text_bytes, with_group, written

BITS = 128
#: The radius of the neighbour search and the blocks of its tables: four tables, each led by 32 bits.
RADIUS = 3
BLOCKS = 4
#: Fingerprints of one key that a task compares with others, on average at most, and the pairs it compares at a time.
TILE = 1 << 13
PAIRS = 1 << 20
#: Stands for the least id where all ids are null.
_NO_ID = (1 << 63) - 1
#: The signs with which each of the 256 values of a hash byte votes on its 8 bits.
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1


def _terms(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight) of the distinct terms of each row."""
    low = kernels.LOWER[raw]
    start, end, first = kernels.words(low, at, kernels.NOT_SPACE)
    row, word = kernels.rows_of(first), kernels.range_hash(kernels.prefix_sums(low), start, end)
    pair = kernels.shingles(word, 2)
    inside = row[1:] == row[:-1]
    length = np.minimum(end - start, 12)
    rows = np.concatenate([row, row[1:][inside]])
    hashes = np.concatenate([word, pair[inside]])
    factor = np.concatenate([length, np.minimum(length[1:] + length[:-1], 12)[inside]])
    order = np.lexsort((hashes, rows))
    rows, hashes, factor = rows[order], hashes[order], factor[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(rows)))
    return rows[heads], hashes[heads], np.log1p(count) * factor[heads]


def simhash(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(rows, 16) bytes: the fingerprint of each row's text."""
    n = len(at) - 1
    row, word, weight = _terms(raw, at)
    votes = np.zeros((n, BITS))
    for half in range(BITS // 64):
        value = kernels.mix(word + np.uint64(half)) if half else word
        for k in range(8):
            byte = ((value >> np.uint64(56 - 8 * k)) & np.uint64(255)).astype(np.int64)
            cells = np.bincount((row << 8) | byte, weight, minlength=n << 8).reshape(n, 256)
            votes[:, half * 64 + 8 * k : half * 64 + 8 * k + 8] = cells @ _SIGNS
    return np.packbits(votes > 1e-9, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS


def _hex(prints: np.ndarray) -> list[str]:
    text = prints.tobytes().hex()
    return [text[i : i + BITS // 4] for i in range(0, len(text), BITS // 4)]


def _encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pa.array(texts, pa.large_string()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row: a narrow projection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for _, _, raw, at in pieces(*text_bytes(batch.column("text"))) for x in _hex(simhash(raw, at))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def _followed(docs: DataFrame) -> DataFrame:
    """doc_id, text, piece, copy: rows in order of doc_id in range pieces, each piece ending with a copy of the next one's first row.

    The cuts are quantiles of doc_id, four a partition; cuts and first ids are all the driver sees.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    shares = [(i + 1) / (4 * n) for i in range(4 * n - 1)]
    cuts = np.unique(rows.agg(F.percentile_approx(key, shares, 100 * n)).first()[0] or []).astype(np.int64)

    @F.pandas_udf(IntegerType())
    def piece_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "right").astype(np.int32))

    heads = sorted(rows.select(key.alias("k")).groupBy(piece_of("k").alias("p")).agg(F.min("k").alias("k")).collect())
    before = {k: heads[i - 1][0] for i, (_, k) in enumerate(heads)}

    @F.pandas_udf(ArrayType(IntegerType()))
    def pieces_of(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, ids.to_numpy(), "right")
        return pd.Series([[p, before[k]] if k in before else [p] for p, k in zip(own.tolist(), ids.tolist(), strict=True)])

    return (
        rows.withColumn("_key", key)
        .select("doc_id", "text", "_key", F.posexplode(pieces_of("_key")).alias("copy", "piece"))
        .repartition(n, "piece")
        .sortWithinPartitions("piece", "copy", "_key", "text")
        .select("doc_id", "text", "copy")
    )


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and the likeness to that and to the next document.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many of the
    next document by ascending doc_id (after the last one: the first).
    """

    def results(ids: list, texts: list[str]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 4] + after[: len(t) // 4] for t, after in zip(texts, texts[1:], strict=False)]
        own, other = simhash(*_encoded(texts)), simhash(*_encoded(edited))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array(_hex(own[:-1]), pa.string()),
                pa.array(_hex(other), pa.string()),
                pa.array(likeness(own[:-1], other), pa.float64()),
                pa.array(likeness(own[:-1], own[1:]), pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size, closed = 0, False  # closed: the piece's copied row has come, further copies are the same row repeated
        for batch in batches:
            for doc_id, text, copy in zip(*(batch.column(i) for i in range(3)), strict=True):
                copy, text = copy.as_py(), text.as_py() or ""
                if copy and closed:
                    continue
                closed = bool(copy)
                texts.append(text)
                size += len(text)
                if not copy:
                    ids.append(doc_id.as_py())
                if ids and (copy or size > 1 << 20):
                    keep = len(texts) - 1
                    yield results(ids[:keep], texts)
                    ids, texts, size = ([], [], 0) if copy else (ids[keep:], texts[keep:], len(text))

    return _followed(docs).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _half(print_: Column, h: int) -> Column:
    """64 bits of a fingerprint as a signed number."""
    return F.conv(F.substring(print_, 1 + 16 * h, 16), 16, -10).cast("long")


def _distance(a: Column, b: Column) -> Column:
    halves = [_half(x, h) for h in range(2) for x in (a, b)]
    return F.bit_count(halves[0].bitwiseXOR(halves[1])) + F.bit_count(halves[2].bitwiseXOR(halves[3]))


def _fronts(radius: int, blocks: int) -> list[tuple[int, ...]]:
    """The blocks that lead each table."""
    if not 0 <= radius < blocks or (BITS // 4) % blocks:
        raise ValueError("blocks must divide 32 and exceed radius")
    return list(combinations(range(blocks), blocks - radius))


def within_radius(prints: DataFrame, radius: int = 3, blocks: int = 8) -> DataFrame:
    """(a, b, distance): all pairs of different fingerprints at most `radius` bits apart, a < b.

    Each fingerprint is cut into `blocks` hex blocks. Two that differ in at most `radius` bits agree
    on at least blocks - radius of them, so one of the tables, keyed by that many blocks brought to
    the front, has both under one key. Equal fingerprints are one entry however many documents have
    them; join back on fingerprint for the documents.
    """
    width = BITS // 4 // blocks
    tables = [
        F.struct(
            F.lit(t).alias("table"), F.concat(*[F.substring("fingerprint", 1 + width * k, width) for k in front]).alias("key")
        )
        for t, front in enumerate(_fronts(radius, blocks))
    ]
    entries = prints.select("fingerprint").dropna().distinct().select("fingerprint", F.explode(F.array(*tables)).alias("e"))
    left = entries.select(F.col("fingerprint").alias("a"), "e.table", "e.key")
    right = entries.select(F.col("fingerprint").alias("b"), "e.table", "e.key")
    near = left.join(right, ["table", "key"]).where(F.col("a") < F.col("b"))
    return near.select("a", "b", _distance(F.col("a"), F.col("b")).alias("distance")).where(F.col("distance") <= radius).distinct()


def _met(left: tuple, right: tuple, masks: list[tuple], table: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in left, in right) of different fingerprints within the radius that agree on the front of this table and of none before it."""
    step = max(1, PAIRS // max(1, len(right[0])))
    for i in range(0, len(left[0]), step):
        high, low = (left[h][i : i + step, None] ^ right[h][None, :] for h in range(2))
        a, b = np.nonzero(np.bitwise_count(high) + np.bitwise_count(low) <= radius)
        high, low = high[a, b], low[a, b]
        counted = (high | low) != 0
        for t, (first, second) in enumerate(masks[: table + 1]):
            counted &= (((high & first) | (low & second)) == 0) == (t == table)
        yield a[counted] + i, b[counted]


def _neighbours(masks: list[tuple], radius: int):
    """Entries of tables, sorted by table, key and pair of tiles, to (hi, lo, others, nearby): what each has within the radius there."""

    def totals(group: dict[str, np.ndarray]) -> Iterator[tuple]:
        own, same = group["left"], group["i"][0] == group["j"][0]
        sides = [tuple(group[c][side] for c in ("hi", "lo", "copies", "least")) for side in ((own,) if same else (own, ~own))]
        left, right = sides[0], sides[-1]
        sums = [(np.zeros(len(side[0]), np.int64), np.full(len(side[0]), _NO_ID)) for side in sides]
        for a, b in _met(left, right, masks, int(group["table"][0]), radius):
            # a tile against itself has every pair in both directions
            for (others, nearby), at, partner, of in ((sums[0], a, right, b),) if same else ((sums[0], a, right, b), (sums[1], b, left, a)):
                np.add.at(others, at, partner[2][of])
                np.minimum.at(nearby, at, partner[3][of])
        for side, (others, nearby) in zip(sides, sums, strict=True):
            some = others > 0
            yield side[0][some].view(np.int64), side[1][some].view(np.int64), others[some], nearby[some]

    names = ("table", "key", "i", "j", "left", "hi", "lo", "copies", "least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: dict[str, np.ndarray], ends: np.ndarray) -> pa.RecordBatch:
            parts = [x for s, e in zip(np.append(0, ends[:-1]), ends, strict=True) if e - s > 1 for x in totals({c: v[s:e] for c, v in rows.items()})]
            columns = [np.concatenate([np.zeros(0, np.int64), *[x[k] for x in parts]]) for k in range(4)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hi", "lo", "others", "nearby"])

        held: dict[str, np.ndarray] = {}
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            rows |= {c: rows[c].view(np.uint64) for c in ("hi", "lo")}
            if held:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
            new = np.any([rows[c][1:] != rows[c][:-1] for c in names[:4]], axis=0)
            ends = np.flatnonzero(new) + 1  # the last group may go on in the next batch
            if len(ends):
                yield found(rows, ends)
            held = {c: v[ends[-1] if len(ends) else 0 :] for c, v in rows.items()}
        if held:
            yield found(held, np.array([len(held["hi"])]))

    return run


def with_neighbours(rows: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """rows (doc_id, fingerprint, ...) with n_within: other rows whose fingerprint is at most `radius` bits away, and least_within: the smallest id among them and the row itself.

    Permuted block tables as in `within_radius`, but no pair is ever a row. Entries under one key are
    dealt to tiles; a pair of tiles is compared by one task, 64 bits at a time, which gives a sum for
    each fingerprint. A pair is counted in the first of the tables that have it under one key. Equal
    fingerprints are one entry with its number of rows, summed before they meet. Work under a key is
    the square of its different fingerprints, in tasks of bounded memory.

    Defined cases: empty texts have equal fingerprints and count as near each other; null ids count
    as rows but not as ids, so least_within is null where no id is known; rows without a fingerprint
    have no neighbours. The rows are read twice: give a stored table.
    """
    fronts = _fronts(radius, blocks)
    width = BITS // blocks
    whole = [sum(((1 << width) - 1) << (BITS - width * (k + 1)) for k in front) for front in fronts]
    masks = [(np.uint64(m >> 64), np.uint64(m & ((1 << 64) - 1))) for m in whole]
    part = fresh(rows, "part")
    split = rows.withColumn(part, F.pmod(F.xxhash64(*rows.columns), F.lit(64)).cast("int"))
    local = split.where("fingerprint is not null").groupBy("fingerprint", part).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"))
    known = local.groupBy("fingerprint").agg(F.sum("copies").alias("copies"), F.min("least").alias("least"))
    known = written(known.select("*", _half(F.col("fingerprint"), 0).alias("hi"), _half(F.col("fingerprint"), 1).alias("lo")), "prints")
    hexes = width // 4
    keys = [
        F.struct(F.lit(t).alias("table"), F.xxhash64(*[F.substring("fingerprint", 1 + hexes * k, hexes) for k in front]).alias("key"))
        for t, front in enumerate(fronts)
    ]
    entries = known.select("hi", "lo", "copies", F.coalesce("least", F.lit(_NO_ID)).alias("least"), F.xxhash64("fingerprint").alias("own"), F.explode(F.array(*keys)).alias("e"))
    entries = entries.select("e.table", "e.key", "hi", "lo", "copies", "least", "own")
    met = with_group(entries, ["table", "key"], "own", members=(F.sum, F.lit(1))).where("members > 1")
    tiles = F.ceil(F.col("members") / tile).cast("int")
    dealt = met.select("*", F.pmod("own", tiles).cast("int").alias("at"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    order = ("table", "key", "i", "j")
    dealt = dealt.select("table", "key", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), (F.col("at") <= F.col("other")).alias("left"), "hi", "lo", "copies", "least")
    dealt = dealt.repartition(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    near = dealt.mapInArrow(_neighbours(masks, radius), "hi long, lo long, others long, nearby long")
    near = near.groupBy("hi", "lo").agg(F.sum("others").alias("others"), F.min("nearby").alias("nearby"))
    summed = known.join(near, ["hi", "lo"], "left").select(
        "fingerprint", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_within"),
        F.nullif(F.least(F.coalesce("least", F.lit(_NO_ID)), F.coalesce("nearby", F.lit(_NO_ID))), F.lit(_NO_ID)).alias("least_within"),
    )
    # a fingerprint that many rows have is handed back by its parts
    handed = local.select("fingerprint", part).join(summed, "fingerprint")
    return split.join(handed, ["fingerprint", part], "left").select(*rows.columns, F.coalesce("n_within", F.lit(0)).cast("long").alias("n_within"), F.coalesce("least_within", "doc_id").alias("least_within"))
