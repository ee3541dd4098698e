"""Fetching many cases: a limit of successes and one budget of requests for all tasks.

Ids are ordered and numbered once, without a task that sees them all. Then they are fetched in
waves. A wave asks for as many ids as successes are still wanted, no more than the budget has left, so
the limit is never passed, and the requests are those of asking one by one: a wave that fulfils
the limit has no failure in it. Slots are dealt before a wave starts; no task counts or can exceed anything.
A wave's cases are a batch of the store, its requests part of the commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.plans.stored import partitions, scratch, written
from docketspark.sources.store import CaseStore, unfetched

DAILY = 500


def _place(counts: list[tuple[int, int]], rank: int) -> int:
    """The number of the rank-th id; numbers of a partition start at its own times 2**33. Past the last: after all."""
    for part, n in counts:
        if rank < n:
            return (part << 33) + rank
        rank -= n
    return 1 << 62


def fetch_batch(
    store: CaseStore, ids: DataFrame, fetch: Callable[[DataFrame], DataFrame], limit: int | None = None, budget: int = DAILY,
    skip_existing: bool = True, batch: str | None = None,
) -> dict:
    """Fetches and saves cases by ascending id until `limit` are saved (none or 0: all), ids or the budget end.

    fetch turns rows of ids into the cases there are. Returns fetched, requests, remaining and whether
    ids were left when the budget ended. Ids that the store has are left out unless skip_existing is false.
    A task that Spark runs again asks its source again; the commit counts slots, not such repeats.
    """
    name, got, used = batch or uuid.uuid4().hex, 0, 0
    with scratch(store.spark):
        asked = ids.select(F.col("id").cast("string").alias("id")).where("id <> ''").distinct()
        asked = unfetched(asked, store.ledger()) if skip_existing else asked
        n = partitions(store.spark)
        numbered = written(asked.repartitionByRange(n, "id").sortWithinPartitions("id").withColumn("place", F.monotonically_increasing_id()), "asked")
        counted = numbered.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
        counts = [(r.part, r.n) for r in counted]
        total, wave = sum(n for _, n in counts), 0
        while used < total and used < budget and (not limit or got < limit):
            size = min(total - used, budget - used, limit - got if limit else total)
            slots = numbered.where((F.col("place") >= _place(counts, used)) & (F.col("place") < _place(counts, used + size)))
            number = store.save(fetch(slots.select("id")), f"{name}-{wave}", requests=size)
            got, used, wave = got + store.saved(number), used + size, wave + 1
    return {"fetched": got, "requests": used, "remaining": budget - used, "exhausted": used == budget and used < total and (not limit or got < limit)}
