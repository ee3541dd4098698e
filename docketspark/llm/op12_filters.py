"""Audit of how filters interact: what each removes alone, after others, and on average over all orders.

Native expressions give each document a mask of the filters that it fails. A copy is a text that a
smaller id has too: a grouping by text, handed back in parts so that no text's copies meet in one
task, supplies the smallest id. Masks are counted by part, 2**n cells each, and every order of the
filters is read off the cells: a document with mask m is removed at the first filter of the order
that is in m. So the documents are read once, whatever the number of orders.

Defined cases: a null text is empty, and fails what an empty text fails; a null part is the part
''; a row without an id has no smaller id and is nobody's, so it fails no copy filter by itself
and marks no other row; rows of one id and text are no copies of each other; labels count where any
row of the label table has 1 for the id; an empty table has no parts and so no rows; other columns
are ignored. Texts are told apart by length and SHA-256.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketspark.llm.common import scratch, with_group, written

WORD = r"[^\x20\x09-\x0D]+"
#: The filter that looks at all documents; the others are conditions on one text.
COPIES = "E"


def failures(text: Column, words: Column, distinct: Column) -> dict[str, Column]:
    """The filters on one text: few words, repeated words, capitals, symbols."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, F.lit("[A-Z]"), F.lit("")))
    return {
        "A": words < 200,
        "B": distinct * 100 < words * 50,
        "C": capitals * 100 > F.length(text) * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def masked(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, mask of every row: bit k is set where the k-th filter of ABCDE fails."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    words = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    counted = words.withColumns({"n": F.size("words"), "different": F.size(F.array_distinct("words"))})
    alone = failures(F.col("text"), F.col("n"), F.col("different"))
    bits = sum((F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(alone.values())), F.lit(0))
    # texts go no further than this: a digest stands for each
    digest = [F.length("text").alias("size"), F.unhex(F.sha2("text", 256)).alias("digest"), F.monotonically_increasing_id().alias("place")]
    seen = written(counted.select("doc_id", "part", bits.alias("mask"), *digest), "masks")
    whole = with_group(seen, ["size", "digest"], "place", first=(F.min, "doc_id"))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return whole.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << len(alone)).otherwise(0)).alias("mask"))


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each mask, and those labelled good or toxic."""
    some = [F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(*some)
    with_id, without = masks.where("doc_id is not null"), masks.where("doc_id is null")
    marked = with_id.join(marks.where("good + toxic > 0"), "doc_id", "left").unionByName(without.withColumns({"good": F.lit(0), "toxic": F.lit(0)}))
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")]
    return marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)


def orders(found: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """part, filter_order, step, filter and the counts of every order and step, from the cells of each part."""
    steps = []
    for order in itertools.permutations(range(len(filters))):
        name = "".join(filters[k] for k in order)
        for step, k in enumerate(order, 1):
            steps.append((name, step, filters[k], 1 << k, sum(1 << x for x in order[: step - 1])))
    # every cell meets every step: a fixed number of rows for each cell
    table = "array(" + ",".join(f"struct('{n}' as filter_order, {s} as step, '{f}' as filter, {b} as own, {e} as earlier)" for n, s, f, b, e in steps) + ")"
    met = found.select("*", F.inline(F.expr(table)))
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) > 0, F.col("mask").bitwiseAND(F.col("earlier")) > 0
    total = lambda where, of="n": F.sum(F.when(where, F.col(of)).otherwise(0)).cast("long")
    counted = met.groupBy("part", "filter_order", "step", "filter").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row for each part, order of the five filters and step. The cells are stored, 32 a part at most; the masks go."""
    with scratch(docs.sparkSession):
        counted = written(cells(masked(docs, part), labels), "cells", keep=True)
    return orders(counted)
