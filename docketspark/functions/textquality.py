"""Text-quality heuristics as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketspark.functions.regexes import unicode_pattern

#: Phrases that count as boilerplate, matched without regard to case.
BOILERPLATE = (
    r"all rights reserved",
    r"disclaimer",
    r"terms of use",
    r"copyright \d{4}",
    r"click here",
    r"page \d+ of \d+",
    r"login required",
)
#: Characters that wrongly decoded text is full of.
MISREAD = "[ï¿½â€™œ]"
ARTIFACTS = ("excessive_whitespace", "html_tags", "encoding_errors", "truncated", "boilerplate_heavy")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(unicode_pattern(r"\S+")))


def sentence_count(text: Column) -> Column:
    """Pieces between runs of end marks that are not blank."""
    return F.regexp_count(text, F.lit(unicode_pattern(r"[^.!?\s][^.!?]*")))


def boilerplate_ratio(text: Column) -> Column:
    """Characters in boilerplate phrases, each phrase counted by itself, over all characters; 0 for an empty text, null for null."""
    cut = [F.length(text) - F.length(F.regexp_replace(text, F.lit(unicode_pattern(p, True)), F.lit(""))) for p in BOILERPLATE]
    total = cut[0]
    for c in cut[1:]:
        total = total + c
    return F.when(F.length(text) > 0, total.cast("double") / F.length(text)).when(text.isNotNull(), F.lit(0.0))


def artifacts(text: Column, words: Column) -> dict[str, Column]:
    return {
        "excessive_whitespace": text.rlike(unicode_pattern(r"\s{10,}")),
        "html_tags": text.rlike(r"<[a-zA-Z][^>]*>"),
        "encoding_errors": text.rlike(MISREAD),
        "truncated": text.rlike(unicode_pattern(r"\.\.\.\s*\z")) | (words < 50),
        "boilerplate_heavy": boilerplate_ratio(text) > 0.3,
    }


def quality_score(words: Column, artifact_count: Column) -> Column:
    """1, less 0.4 below 50 words or 0.1 below 200, less 0.15 for each artifact, 0 at least; in decimals."""
    short = F.when(words < 50, F.lit("0.4").cast("decimal(3,2)")).when(words < 200, F.lit("0.1").cast("decimal(3,2)"))
    taken = F.coalesce(short, F.lit("0").cast("decimal(3,2)")) + artifact_count.cast("decimal(2,0)") * F.lit("0.15").cast("decimal(3,2)")
    return F.greatest(F.lit("1").cast("decimal(3,2)") - taken, F.lit("0").cast("decimal(3,2)")).cast("double")
