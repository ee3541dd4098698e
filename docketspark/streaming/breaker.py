"""The circuit breaker as a stateful stream: the same steps as the batch replay, over events as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.resilience import CLOSED
from docketspark.operators.breaker import step


def replay_stream(events: DataFrame, key: str, at: str, failed, order: str, threshold: int = 5, recovery: float = 60.0) -> DataFrame:
    """key, event, met, state, failures for each event of a micro-batch, in order of time within it; state is kept between batches."""
    rows = events.select(
        F.col(key).cast("long").alias("key"), F.col(order).cast("long").alias("event"),
        (F.unix_micros(F.col(at).cast("timestamp")) / 1e6).alias("at"), F.coalesce(failed, F.lit(False)).alias("failed"),
    )

    def run(group: tuple, frames: Iterator[pd.DataFrame], kept) -> Iterator[pd.DataFrame]:
        state, failures, opened = kept.get if kept.exists else (CLOSED, 0, 0.0)
        found = pd.concat(list(frames)).sort_values(["at", "event"])
        out = []
        for event, t, bad in zip(found["event"], found["at"], found["failed"], strict=True):
            met, state, failures, opened = step(state, failures, opened, t, bad, threshold, recovery)
            out.append((group[0], event, met, state, failures))
        kept.update((state, failures, opened))
        yield pd.DataFrame(out, columns=["key", "event", "met", "state", "failures"])

    return rows.groupBy("key").applyInPandasWithState(
        run, "key long, event long, met string, state string, failures int", "state string, failures int, opened double", "append", "NoTimeout"
    )
