"""Connected components as DataFrame rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.plans.stored import with_group, written


def _pairs(*pairs: tuple[str, str]) -> Column:
    return F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs])).alias("e")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node it
    sees; rounds grow with the logarithm of the longest path. A round's edges are a written table. A
    node's neighbours are dealt to 64 tasks, so that the root of a large component is no hot key.
    """
    now = written(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = mark
        both = now.select(_pairs(("a", "b"), ("b", "a"))).select("e.*")
        large = with_group(both, ["a"], "b", m=(F.min, F.col("b"))).where(F.col("b") > F.col("a"))
        hung = large.select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        # all of hung's edges point from a larger to a smaller node, so a's neighbours here are its smaller ones
        small = with_group(hung, ["a"], "b", m=(F.min, F.col("b")))
        now = written(small.select(_pairs(("b", "m"), ("a", "m"))).select("e.*").where(F.col("a") != F.col("b")).distinct(), "edges")
