"""Chat formatting: roles of a transcript recovered by a hidden Markov model, then canonical turns.

A transcript is cut into segments: a speaker marker ("User:", "Q:", ...) or a blank line begins one.
Hidden states are the roles; what is seen of a segment is its marker, its size, its number of lines,
how it ends and whether it opens the transcript. Start, transition and emission probabilities are
smoothed counts over all training conversations; Viterbi recovers the roles; neighbours of one role
are one canonical turn.

The segments are sorted by conversation, turn and place, and a conversation is worked on in blocks of
`block` neighbours in that order at most: a block's best scores from each role to each role (a
max-plus matrix) are enough to choose the roles at its ends, so a very long conversation, turn or
text is no single group; the matrices of a conversation's blocks stream through one task, which keeps
one role number for each role and block.

The canonical transcript opens each turn with a line `<|role|>` and closes each, the last one too,
with a line `<|end|>`. Blank lines between paragraphs of one turn are kept;
those before a marker are layout. A `<|` in a text gets a
backslash between its two characters (and one more where there are some already), so no text can
open or close a turn.

Defined cases: null text is one empty segment; null conversation ids are one conversation; null
turns come first; repeated rows are segments of their own; rows without a role are not trained on;
without any training row every role is `user`; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketspark.llm.common import partitions, written

#: Marker words of speakers (fixed values), by the class that the model sees.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "prompt", "me"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "response", "gpt"),
}
_CLASS = {word: k + 1 for k, words in enumerate(MARKERS.values()) for word in words}
_MARKER = re.compile(r"^[ \t]*[\[<*#]*\s*(" + "|".join(sorted(_CLASS, key=len, reverse=True)) + r")\s*[\]>*]*\s*(?::|>>|->|\])\s*", re.IGNORECASE)
#: What is seen of a segment, and the number of values of each.
SEEN = {"marker": 4, "size": 16, "lines": 6, "ending": 4, "opens": 2}


_OPENING = re.compile(r"<(\\*)\|")


def escaped(text: str) -> str:
    """The text without anything that reads as the canonical form's own marks; a backslash less gives it back."""
    return _OPENING.sub(r"<\\\1|", text)


def segments(text: str | None) -> list[tuple[int, str, int]]:
    """(marker class, text without the marker, blank lines before an unmarked one) of each segment; one at least."""
    found: list[list] = []
    blank = 0
    for line in (text or "").split("\n"):
        mark = _MARKER.match(line)
        if not line.strip():
            blank += 1
            continue
        if mark or blank or not found:
            found.append([_CLASS[mark[1].lower()] if mark else 0, [line[mark.end() :] if mark else line], blank if found and not mark else 0])
        else:
            found[-1][1].append(line)
        blank = 0
    return [(m, "\n".join(lines), n) for m, lines, n in found] or [(0, "", 0)]


def seen_of(marker: int, text: str, opens: bool) -> list[int]:
    last = text.rstrip()[-1:]
    ending = 1 if last == "?" else 2 if last in (".", "!") else 3 if last == ":" else 0
    size = min(15, int(2 * np.log2(1 + len(text) / 16)))
    return [marker, size, min(5, text.count("\n")), ending, int(opens)]


def cut(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, seg, gap, seen, text: the segments of every row; gap: blank lines before one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, seg, gap, seen, texts = [], [], [], [], []
            turn = batch.column("turn").to_pylist()
            for i, text in enumerate(batch.column("text").to_pylist()):
                for k, (marker, body, blank) in enumerate(segments(text)):
                    row.append(i)
                    seg.append(k)
                    gap.append(blank)
                    seen.append(seen_of(marker, body, k == 0 and turn[i] in (None, 0)))
                    texts.append(body)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in ("conv_id", "turn", "role")), pa.array(seg, pa.int32()), pa.array(gap, pa.int32()), pa.array(seen, pa.list_(pa.int32())), pa.array(texts, pa.string())],
                ["conv_id", "turn", "role", "seg", "gap", "seen", "text"],
            )

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.mapInArrow(run, "conv_id long, turn long, role string, seg int, gap int, seen array<int>, text string")


def in_blocks(cut_rows: DataFrame, block: int) -> DataFrame:
    """The segments with `block` and `at`: runs of at most `block` neighbours of one conversation, both ascending in the order of segments.

    Ranges are cut between any two segments: `_row` tells rows apart that are equal in all else.
    """
    rows = written(cut_rows.withColumn("_row", F.monotonically_increasing_id()), "segments")
    order = ["conv_id", "turn", "seg", "text", "role", "_row"]
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_part", F.spark_partition_id().cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, size, number, place = None, 0, -1, 0
        for batch in batches:
            blocks = []
            first = (batch.column("_part")[0].as_py() << 40) if batch.num_rows else 0
            for c in batch.column("conv_id").to_pylist():
                if number < 0 or c != conv or size == block:
                    conv, size, number = c, 0, number + 1
                size += 1
                blocks.append(first + number)
            at = pa.array(range(first + place, first + place + len(blocks)), pa.int64())
            place += len(blocks)
            columns = [batch.column(c) for c in ("conv_id", "turn", "role", "seg", "gap", "seen", "text")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(blocks, pa.int64()), at], ["conv_id", "turn", "role", "seg", "gap", "seen", "text", "block", "at"])

    return written(ranged.mapInArrow(run, "conv_id long, turn long, role string, seg int, gap int, seen array<int>, text string, block long, at long"), "placed")


def fit(placed_rows: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray, np.ndarray, list[np.ndarray]]:
    """(roles, log start, log transitions, log emissions) counted over all rows with a role; tables of counts reach the driver."""
    rows = placed_rows.where(F.col("role").isNotNull())
    inside = Window.partitionBy("conv_id", "block").orderBy("at")
    steps = rows.select("conv_id", "block", "role", F.lag("role").over(inside).alias("_before"), "at")
    ends = steps.groupBy("conv_id", "block").agg(F.min_by("role", "at").alias("role"), F.max_by("role", "at").alias("last"))
    joined = ends.select("role", F.lag("last").over(Window.partitionBy("conv_id").orderBy("block")).alias("before"))
    pairs = steps.where(F.col("_before").isNotNull()).select("role", F.col("_before").alias("before")).unionByName(joined)
    counts = pairs.groupBy("before", "role").count().collect()
    seen = rows.select("role", F.posexplode("seen").alias("k", "v")).groupBy("role", "k", "v").count().collect()
    roles = sorted({r["role"] for r in counts})
    if not roles:
        return ["user"], np.zeros(1), np.zeros((1, 1)), [np.zeros((n, 1)) for n in SEEN.values()]
    at = {r: i for i, r in enumerate(roles)}
    start, moves = np.full(len(roles), smoothing), np.full((len(roles), len(roles)), smoothing)
    for r in counts:
        if r["before"] is None:
            start[at[r["role"]]] += r["count"]
        else:
            moves[at[r["before"]], at[r["role"]]] += r["count"]
    shown = [np.full((n, len(roles)), smoothing) for n in SEEN.values()]
    for r in seen:
        shown[r["k"]][r["v"], at[r["role"]]] += r["count"]
    return roles, np.log(start / start.sum()), np.log(moves / moves.sum(axis=1, keepdims=True)), [np.log(x / x.sum(axis=0)) for x in shown]


def _scores(seen: list, model) -> np.ndarray:
    return sum(table[[s[k] for s in seen]] for k, table in enumerate(model[3]))


def _transfer(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """[i, j]: the best score of a block that is entered from role i (before it) and ends in role j."""
    best = moves + scores[0]
    for row in scores[1:]:
        best = (best[:, :, None] + moves[None]).max(axis=1) + row
    return best


def viterbi(scores: np.ndarray, enter: np.ndarray, moves: np.ndarray, last: int) -> list[int]:
    """The best roles of a block whose first segment has the scores `enter` so far added and whose last role is given."""
    best, back = enter + scores[0], []
    for row in scores[1:]:
        step = best[:, None] + moves
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + row
    path = [last]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return path[::-1]


def recover(turns: DataFrame, parts: int = 5, held_fold: int = 0, block: int = 256) -> DataFrame:
    """conv_id, turn, seg, held_out, recorded, role, rendered: every segment with its recovered role.

    Concatenating `rendered` in order of turn and seg gives the canonical transcript. Conversations
    whose crc32(conv_id as text) mod parts is held_fold are not trained on.
    """
    spark = turns.sparkSession
    n = partitions(spark)
    rows = in_blocks(cut(turns), block)
    held = F.coalesce(F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(parts)) == held_fold, F.lit(False))
    model = spark.sparkContext.broadcast(fit(rows.where(~held)))
    seen_rows = rows.select("conv_id", "block", "at", "seen").repartition(n, "conv_id", "block").sortWithinPartitions("conv_id", "block", "at")

    def by_block(batches: Iterator[pa.RecordBatch]):
        """The sorted rows block by block: (key, rows)."""
        key, kept = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if kept and (r["conv_id"], r["block"]) != key:
                    yield key, kept
                    kept = []
                key = (r["conv_id"], r["block"])
                kept.append(r)
        if kept:
            yield key, kept

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for (conv, number), kept in by_block(batches):
            table = _transfer(_scores([r["seen"] for r in kept], known), known[2])
            opening = known[1] + _scores([kept[0]["seen"]], known)[0]
            first = opening if len(kept) == 1 else (opening[:, None] + _transfer(_scores([r["seen"] for r in kept[1:]], known), known[2])).max(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([number], pa.int64()), pa.array([table.ravel().tolist()], pa.list_(pa.float64())), pa.array([first.tolist()], pa.list_(pa.float64()))],
                ["conv_id", "block", "moves", "first"],
            )

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks in order of conversation and place to the role before each (-1: none), its last role, and whether it is the conversation's last."""
        conv, best, back, numbers, out, begun = None, None, [], [], [], False

        def close() -> None:
            ends = [int(best.argmax())]
            for choice in reversed(back):
                ends.append(int(choice[ends[-1]]))
            ends = ends[::-1]
            out.extend((conv, k, a, b, k == numbers[-1]) for k, a, b in zip(numbers, [-1, *ends[:-1]], ends, strict=True))

        def flushed() -> pa.RecordBatch:
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()
            columns = zip(*out, strict=True) if out else [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["c", "b", "before", "last", "final"])

        for batch in batches:
            for c, number, moves, first in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "block", "moves", "first")), strict=True):
                if not begun or c != conv:
                    if begun:
                        close()
                    conv, best, back, numbers, begun = c, np.array(first), [], [number], True
                    continue
                step = best[:, None] + np.array(moves).reshape(len(first), -1)
                back.append(step.argmax(axis=0).astype(np.int8 if len(first) < 128 else np.int32))
                numbers.append(number)
                best = step.max(axis=0)
            yield flushed()
            out = []
        if begun:
            close()
        yield flushed()

    table = seen_rows.mapInArrow(transfers, "conv_id long, block long, moves array<double>, first array<double>")
    table = table.repartition(n, "conv_id").sortWithinPartitions("conv_id", "block")
    ends = table.mapInArrow(chosen, "c long, b long, before int, last int, final boolean")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for _, kept in by_block(batches):
            before, last = kept[0]["before"], kept[0]["last"]
            enter = known[1] if before < 0 else known[2][before]
            path = viterbi(_scores([r["seen"] for r in kept], known), enter, known[2], last)
            previous = [before, *path[:-1]]
            # a turn is closed where the next one opens, so that a block needs nothing of the one after it
            opening = ["\n" * r["gap"] if a == b else ("" if a < 0 else "<|end|>\n") + f"<|{known[0][b]}|>\n" for a, b, r in zip(previous, path, kept, strict=True)]
            closing = [""] * (len(kept) - 1) + ["<|end|>\n" if kept[0]["final"] else ""]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["conv_id"] for r in kept], pa.int64()),
                    pa.array([r["turn"] for r in kept], pa.int64()),
                    pa.array([r["seg"] for r in kept], pa.int32()),
                    pa.array([r["role"] for r in kept], pa.string()),
                    pa.array([known[0][k] for k in path], pa.string()),
                    pa.array([o + escaped(r["text"]) + "\n" + e for o, r, e in zip(opening, kept, closing, strict=True)], pa.string()),
                ],
                ["conv_id", "turn", "seg", "recorded", "role", "rendered"],
            )

    placed = rows.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    placed = placed.repartition(n, "conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    out = placed.mapInArrow(decoded, "conv_id long, turn long, seg int, recorded string, role string, rendered string")
    return out.select("conv_id", "turn", "seg", held.alias("held_out"), "recorded", "role", "rendered")
