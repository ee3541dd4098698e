"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources get token targets by weight, made whole words by highest quotients (votes / 1, 3, 5, ...).
A source's words are cut into equal blocks, and the blocks are apportioned over its shards by highest
quotients again; a shard that can hold no more leaves the ranking, and the words that fill no block,
or that no shard had room for as a block, are apportioned one by one. A shard lays its documents end
to end in a seeded order and takes its words from that stream, passing over it again where they are
more, `max_repeats` times at most. A source so takes its target to the word, however small it is.

Everything is DataFrame operations. One row per source and one per shard are ordered; a source of
n rows has about sqrt(n) shards of sqrt(n) rows, so no group follows the corpus in proportion. A
source of few blocks and rows has fewer shards, so that each holds many blocks.

Defined cases: null or empty text has size 0 and takes 0; a null source is a source of its own and
ranks last; repeated rows are documents of their own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketspark.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """(source, source_size) -> with target: shares of all sizes by weight, none above max_repeats times its size.

    Resharing the excess until none is above ends at one level t with target = min(cap, t * weight);
    with sources ordered by cap / weight the level follows from running sums.
    """
    pick = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = totals.select(
        "source",
        "source_size",
        F.element_at(pick, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(max_repeats)).alias("cap"),
    )
    everything = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    upto = everything.rowsBetween(Window.unboundedPreceding, -1)
    onward = everything.rowsBetween(0, Window.unboundedFollowing)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(onward),
    ).withColumn("above", F.col("level") * F.col("weight") > F.col("cap"))
    # the first source that its level leaves below its cap fixes the level of all that follow
    final = F.first(F.when(~F.col("above"), F.col("level")), ignorenulls=True).over(whole)
    return levels.select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(final, F.lit(0.0)) * F.col("weight")).alias("target")
    )


def apportioned(parties: DataFrame, within: list[str], seats: Column, votes: Column, most: Column, order: list) -> DataFrame:
    """Adds `quota`: the seats of each party by highest quotients votes / (2k - 1); a party with `most` seats leaves the ranking.

    With n parties, a divisor of V / (N - n/2) gives no seat too many and one of V / (N + n/2) none
    too few. Where `most` is a common multiple of the votes, rounded down, parties at it lack one
    seat each at most, so that V / (N + 3n/2) gives enough: only the seats between, 3n at most, are ranked.
    """
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    base = (
        parties.withColumn("_v", votes.cast("double"))
        .withColumn("_n", F.count(F.lit(1)).over(w))
        .withColumn("_all", F.sum("_v").over(w))
        .withColumn("_seats", seats)
    )
    share = lambda seats_: F.when(F.col("_all") > 0, F.floor(F.col("_v") * F.greatest(seats_, F.lit(0.0)) / F.col("_all") + 0.5)).otherwise(0)
    base = base.withColumn("_sure", F.least(share(F.col("_seats") - F.col("_n") / 2), most)).withColumn(
        "_top", F.least(share(F.col("_seats") + 1.5 * F.col("_n")), most)
    )
    left = F.col("_seats") - F.sum("_sure").over(w)
    keep = [c for c in base.columns if c not in ("_n", "_all", "_seats", "_top")]
    asked = base.withColumn("_left", left).withColumn(
        "_seat", F.explode_outer(F.when(F.col("_top") > F.col("_sure"), F.sequence(F.col("_sure") + 1, F.col("_top"))))
    )
    quotient = F.coalesce(F.col("_v") / (2 * F.col("_seat") - 1), F.lit(-1.0))
    rank = F.row_number().over(w.orderBy(quotient.desc(), *order))
    won = asked.withColumn("_won", (F.col("_seat").isNotNull() & (rank <= F.col("_left"))).cast("long"))
    names = [c for c in keep if c not in ("_v", "_sure")]
    return (
        won.groupBy(*names)
        .agg((F.first("_sure") + F.sum("_won")).alias("quota"))
    )


def dealt(parties: DataFrame, within: list[str], words: Column, votes: Column, cap: Column, block: int, order: list) -> DataFrame:
    """Adds `due`: the words of each party, in blocks as far as they go and then one by one over the room that is left.

    All words are dealt where the caps (whole numbers) hold them. A room of r words as votes never
    gets more than r of them: its quotients up to r are above 1/2, all others below.
    """
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    given = parties.withColumn("_words", words).withColumn("_cap", cap)
    given = apportioned(given, within, F.floor(F.col("_words") / block), votes, F.floor(F.col("_cap") / block), order)
    given = given.withColumn("_given", F.col("quota") * block).drop("quota")
    given = given.withColumn("_left", F.col("_words") - F.sum("_given").over(w)).withColumn("_room", F.col("_cap") - F.col("_given"))
    rest = apportioned(given.withColumnRenamed("_left", "_rest"), within, F.col("_rest"), F.col("_room"), F.col("_room"), order)
    return rest.select(*parties.columns, (F.col("_given") + F.col("quota")).alias("due"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    max_repeats: int = 3,
    block_tokens: int = 32,
    seed: int = 7,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source: what the mix takes of every document."""
    rows = docs.select("doc_id", "source", words_of(F.col("text")).alias("size"))
    sized = written(rows, "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = source_targets(totals.select("source", "source_size"), weights, max_repeats)
    all_words = F.floor(F.sum("target").over(Window.partitionBy()) + 0.5)
    whole = F.floor(F.col("source_size") * max_repeats)
    named = [F.col("source").isNull(), F.col("source")]
    quotas = dealt(targets, [], all_words, F.col("target"), whole, 1, named)
    # about 64 blocks or 4,096 rows a shard at least, where that leaves a source no more than the root of its rows
    many = F.greatest(F.ceil(F.col("t.source_size") / (64 * block_tokens)), F.ceil(F.col("rows") / 4096))
    shards = F.greatest(F.least(F.ceil(F.sqrt("rows")), many), F.lit(1)).cast("long")
    # one row per source from here on: small beside the documents, but only AQE may decide to broadcast it
    plan = written(
        quotas.alias("q")
        .join(totals.alias("t"), F.col("q.source").eqNullSafe(F.col("t.source")))
        .select("q.source", "q.source_size", "target", F.col("due").alias("quota"), shards.alias("shards")),
        "sources",
    )
    placed = (
        sized.alias("d")
        .join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select(
            "doc_id", "p.source", "size", "source_size", "target", "quota",
            F.xxhash64("doc_id", F.lit(seed)).alias("draw"),
            F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("shards")).alias("shard"),
        )
    )
    totals_by_shard = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("quota").alias("source_quota")
    )
    shard_quotas = dealt(
        totals_by_shard, ["source"], F.col("source_quota"), F.col("shard_size"),
        F.floor(F.col("shard_size") * max_repeats), block_tokens, [F.col("shard")],
    ).select(F.col("source").alias("s"), F.col("shard").alias("k"), "shard_size", "due")
    stream = placed.join(shard_quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("k")))
    before = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size")
    start = F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("due") / F.col("shard_size"))).otherwise(0)
    rest = F.col("due") - passes * F.col("shard_size")
    taken = passes * F.col("size") + F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))
    return stream.select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), taken.cast("long").alias("taken"), "source"
    )
