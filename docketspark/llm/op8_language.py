"""Language identification: scripts narrow the candidates, Viterbi labels the words.

Each word gets a log-likelihood under every language from hashed character n-grams; the script that
most of its letters belong to leaves only the languages that use that script in training. Viterbi
over the words of a text, with a penalty for each switch of language, labels spans; the label of the
text is the language of most letters.

The counts come from training rows alone: all of them where a language has at most `per_language`
rows, else a share of its rows, drawn by a seeded hash, that is expected to have as many.

Defined cases: a null text, or one without a letter, is `und` with score 0; repeated rows are
labelled alike; without training rows all is `und`; a script no training text uses leaves all
languages as candidates; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm import kernels
from docketspark.llm.common import pieces, sliced, text_bytes
from docketspark.llm.labelled import held

GRAMS = (2, 3, 4)
#: First code points of script ranges, with the script that begins there (fixed values of Unicode's blocks).
SCRIPTS = (
    (0x0000, "none"), (0x0041, "latin"), (0x005B, "none"), (0x0061, "latin"), (0x007B, "none"), (0x00AA, "latin"),
    (0x00AB, "none"), (0x00B5, "latin"), (0x00B6, "none"), (0x00BA, "latin"), (0x00BB, "none"), (0x00C0, "latin"),
    (0x00D7, "none"), (0x00D8, "latin"), (0x00F7, "none"), (0x00F8, "latin"), (0x0250, "other"), (0x02B0, "none"),
    (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "none"), (0x2C00, "other"), (0x2E00, "none"), (0x3041, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0x4DC0, "none"), (0x4E00, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xE000, "none"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"), (0xFE00, "none"), (0xFF66, "kana"),
    (0xFFA0, "none"), (0x10000, "other"), (0x1F000, "none"), (0x20000, "han"), (0xE0000, "none"),
)
_FIRST = np.array([a for a, _ in SCRIPTS])
SCRIPT_NAMES = ("none", *sorted({s for _, s in SCRIPTS} - {"none"}))
_SCRIPT = np.array([SCRIPT_NAMES.index(s) for _, s in SCRIPTS])


@dataclass(frozen=True)
class Settings:
    """per_language bounds the training rows that are expected of a language; slice_bytes the text a task scores at a time, one row at least."""

    per_language: int = 3000
    bits: int = 16
    switch: float = 8.0
    smoothing: float = 0.5
    seed: int = 8
    slice_bytes: int = 8 << 20


def letters(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of each code point, its script) for valid UTF-8."""
    where = np.flatnonzero((raw & 0xC0) != 0x80)
    padded = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int64)
    b0, b1, b2, b3 = (padded[where + i] for i in range(4))
    point = np.select(
        [b0 < 0x80, b0 < 0xE0, b0 < 0xF0],
        [
            b0,
            ((b0 & 0x1F) << 6) | (b1 & 0x3F),
            ((b0 & 0x0F) << 12) | ((b1 & 0x3F) << 6) | (b2 & 0x3F),
        ],
        ((b0 & 0x07) << 18) | ((b1 & 0x3F) << 12) | ((b2 & 0x3F) << 6) | (b3 & 0x3F),
    )
    return where, _SCRIPT[np.searchsorted(_FIRST, point, "right") - 1]


def analysed(raw: np.ndarray, at: np.ndarray, bits: int):
    """Words with letters: (row offsets, letters of each word, its script, [(word of each gram, bucket)])."""
    low = kernels.LOWER[raw]
    where, script = letters(raw)
    is_letter = np.zeros(len(raw), bool)
    is_letter[where[script > 0]] = True
    byte_of_letter = np.zeros(len(raw), bool)  # all bytes of a letter
    byte_of_letter[where] = script > 0
    for _ in range(3):
        tail = np.flatnonzero((raw & 0xC0) == 0x80)
        tail = tail[tail > 0]
        byte_of_letter[tail] = byte_of_letter[tail - 1]
    text = np.where(byte_of_letter, low, np.uint8(32))
    start, end, first = kernels.words(text, at, kernels.NOT_SPACE)
    count = np.add.reduceat(is_letter.astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    if len(start):  # what stands between words has no letters
        kind = np.zeros(len(raw), np.int8)
        kind[where] = script
        per_script = np.stack([np.add.reduceat((kind == k).astype(np.int32), start) for k in np.unique(kind[kind > 0])], axis=1)
        of_word = np.unique(kind[kind > 0])[per_script.argmax(axis=1)]
    else:
        of_word = np.zeros(0, np.int8)
    grams = []
    edge = np.empty(len(text) + 2, np.uint8)  # a space at either end, so that edges of first and last words count
    edge[0] = edge[-1] = 32
    edge[1:-1] = text
    for n in GRAMS:
        bucket, g = kernels.letter_grams(edge, n, bits)
        g = g - 1
        # the gram belongs to the word that its inner bytes are in
        inner = g + 1
        word = np.searchsorted(start, inner, "right") - 1
        keep = (word >= 0) & (inner < end[np.maximum(word, 0)]) if len(start) else np.zeros(len(g), bool)
        grams.append((word[keep], bucket[keep]))
    return first, count, of_word, grams


def fit(docs: DataFrame, parts: int = 4, held_fold: int = 2, s: Settings = Settings()):  # noqa: B008
    """(languages, log-probabilities [buckets, languages], allowed [scripts, languages]) of the training rows.

    The driver sees the counts by bucket and language alone, whatever the corpus.
    """
    rows = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held(parts, held_fold)
    )
    known = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(known)
    if not languages:
        return [], np.zeros((1 << s.bits, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool)
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, s.per_language / known[k])))])
    draw = F.pmod(F.xxhash64(F.lit(s.seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    index = F.create_map(*[x for i, k in enumerate(languages) for x in (F.lit(k), F.lit(i))])
    sample = rows.where(draw < share[F.col("lang")]).select(index[F.col("lang")].alias("k"), "text")
    bits, n = s.bits, len(languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(n << bits, np.int64)
        scripts = np.zeros(n * len(SCRIPT_NAMES), np.int64)
        for batch in batches:
            k = batch.column("k").to_numpy(zero_copy_only=False)
            for i, j, raw, at in pieces(*text_bytes(batch.column("text"))):
                first, letters_of, script, grams = analysed(raw, at, bits)
                lang = k[i:j][kernels.rows_of(first)]
                scripts += np.bincount(lang * len(SCRIPT_NAMES) + script, letters_of, len(scripts)).astype(np.int64)
                for word, bucket in grams:
                    table += np.bincount((lang[word].astype(np.int64) << bits) | bucket, minlength=len(table))
        used = np.flatnonzero(table)
        cells = np.concatenate([used, -1 - np.flatnonzero(scripts)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(np.concatenate([table[used], scripts[scripts > 0]]), pa.int64())], ["cell", "n"]
        )

    cells = sample.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table, scripts = np.zeros(n << bits), np.zeros(n * len(SCRIPT_NAMES))
    cell, number = cells["cell"].to_numpy(), cells["n"].to_numpy()
    table[cell[cell >= 0]] = number[cell >= 0]
    scripts[-1 - cell[cell < 0]] = number[cell < 0]
    table = table.reshape(n, 1 << bits) + s.smoothing
    logs = np.log(table / table.sum(axis=1, keepdims=True)).T
    scripts = scripts.reshape(n, -1)
    allowed = (scripts > 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T
    allowed[~allowed.any(axis=1)] = True
    return languages, np.ascontiguousarray(logs - logs.mean(axis=1, keepdims=True)).astype(np.float32), allowed


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word: all rows step together, longest first; a row ends when its words do."""
    total, n = scores.shape
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    back, path = np.empty((total, n), np.int8 if n < 127 else np.int32), np.empty(total, np.int32)
    if not total:
        return path
    steps = int(length[0])
    active = np.searchsorted(-length, -np.arange(steps), "left")  # rows with more than t words
    stay = np.arange(n)
    best = scores[begin[: active[0]]].copy()
    for t in range(1, steps):
        best = best if len(best) == active[t] else best[: active[t]]
        top = best.argmax(axis=1)
        jump = best[np.arange(len(top)), top] - switch
        moved = jump[:, None] > best
        at = begin[: active[t]] + t
        back[at] = np.where(moved, top[:, None], stay)
        now = np.where(moved, jump[:, None], best) + scores[at]
        if t + 1 < steps and active[t + 1] < active[t]:
            done = slice(active[t + 1], active[t])
            path[at[done]] = now[done].argmax(axis=1)
        elif t + 1 == steps:
            path[at] = now.argmax(axis=1)
        best = now
    single = slice(active[1] if steps > 1 else 0, active[0])
    path[begin[single]] = scores[begin[single]].argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        at = begin[: active[t]] + t
        path[at - 1] = back[at, path[at]]
    return path


def word_labels(raw: np.ndarray, at: np.ndarray, model, s: Settings):
    """(row offsets, letters of each word, its scores under each language) for one piece."""
    _, logs, allowed = model
    first, count, script, grams = analysed(raw, at, s.bits)
    scores = np.zeros((len(count), logs.shape[1]), np.float32)
    for word, bucket in grams:
        if len(word):
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            scores[word[heads]] += np.add.reduceat(logs[bucket], heads, axis=0)
    scores[~allowed[script]] = -1e4
    return first, count, scores


def _spans(docs: DataFrame, model, s: Settings, emit, columns: list[str], schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_model = shared.value
        for batch in sliced(batches, "text", s.slice_bytes):
            firsts, counts, scores = [np.zeros(1, np.int64)], [], []
            for _, _, raw, at in pieces(*text_bytes(batch.column("text"))):
                first, count, score = word_labels(raw, at, held_model, s)
                firsts.append(first[1:] + firsts[-1][-1])
                counts.append(count)
                scores.append(score)
            if not scores:
                continue
            first, count, score = np.concatenate(firsts), np.concatenate(counts), np.concatenate(scores)
            path = viterbi(score, first, s.switch) if score.shape[1] else np.zeros(0, np.int32)
            yield emit(batch, first, count, path, held_model[0])

    return docs.select(*columns).mapInArrow(run, schema)


def identify(docs: DataFrame, parts: int = 4, held_fold: int = 2, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """doc_id, held_out, lang_pred, score: the language of most letters of each text and its share of them."""

    def emit(batch, first, count, path, languages) -> pa.RecordBatch:
        n, k = len(first) - 1, max(1, len(languages))
        share = np.zeros((n, k))
        if languages:
            row = kernels.rows_of(first)
            share = np.bincount(row * k + path, count, minlength=n * k).reshape(n, k)
        total = share.sum(axis=1)
        top = share.argmax(axis=1)
        label = [languages[i] if t else "und" for i, t in zip(top.tolist(), total.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(label, pa.string()),
                pa.array(share[np.arange(n), top] / np.maximum(total, 1), pa.float64()),
            ],
            ["doc_id", "held_out", "lang_pred", "score"],
        )

    model = fit(docs, parts, held_fold, s)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held(parts, held_fold).alias("held_out"), "text")
    return _spans(
        rows, model, s, emit, ["doc_id", "held_out", "text"], "doc_id long, held_out boolean, lang_pred string, score double"
    )


def language_spans(docs: DataFrame, parts: int = 4, held_fold: int = 2, s: Settings = Settings()) -> DataFrame:  # noqa: B008
    """doc_id, span, lang, first_word, n_words: the runs of words of one language in each text."""

    def emit(batch, first, count, path, languages) -> pa.RecordBatch:
        row = kernels.rows_of(first)[: len(path)]
        new = np.ones(len(path), bool)
        new[1:] = (path[1:] != path[:-1]) | (row[1:] != row[:-1])
        head = np.flatnonzero(new)
        rows = row[head]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(rows)),
                pa.array(np.arange(len(head)) - np.searchsorted(rows, rows), pa.int64()),
                pa.array([languages[i] for i in path[head].tolist()], pa.string()),
                pa.array(head - first[rows], pa.int64()),
                pa.array(np.diff(np.append(head, len(path))), pa.int64()),
            ],
            ["doc_id", "span", "lang", "first_word", "n_words"],
        )

    model = fit(docs, parts, held_fold, s)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _spans(rows, model, s, emit, ["doc_id", "text"], "doc_id long, span long, lang string, first_word long, n_words long")
