"""Circuit-breaker replay over an event log: the state before and after every event of a key.

Rows of a key stream through one task in order of time with a state of three values, so memory does
not grow with a key's events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.resilience import CLOSED, HALF_OPEN, OPEN


def step(state: str, failures: int, opened: float, at: float, failed: bool, threshold: int, recovery: float) -> tuple[str, str, int, float]:
    """(state that the call meets, state after it, failures in a row, when it opened); a call that meets an open circuit changes nothing."""
    if state == OPEN and at - opened >= recovery:
        state = HALF_OPEN
    if state == OPEN:
        return OPEN, OPEN, failures, opened
    if not failed:
        return state, CLOSED, 0, opened
    failures += 1
    if state == HALF_OPEN or failures >= threshold:
        return state, OPEN, failures, at
    return state, CLOSED, failures, opened


def replay(events: DataFrame, key: str, at: str, failed, order: str, threshold: int = 5, recovery: float = 60.0) -> DataFrame:
    """key, order, at (seconds), failed, met, state, failures for every event; ties in time by `order`. A null outcome is a success."""
    rows = events.select(
        F.col(key).cast("long").alias("key"), F.col(order).cast("long").alias("event"),
        F.coalesce(F.unix_micros(F.col(at).cast("timestamp")) / 1e6, F.lit(0.0)).alias("at"), F.coalesce(failed, F.lit(False)).alias("failed"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begun = None, False
        state, failures, opened = CLOSED, 0, 0.0
        for batch in batches:
            met, after, count = [], [], []
            for k, t, bad in zip(*(batch.column(c).to_pylist() for c in ("key", "at", "failed")), strict=True):
                if not begun or k != current:
                    current, begun, state, failures, opened = k, True, CLOSED, 0, 0.0
                seen, state, failures, opened = step(state, failures, opened, t, bad, threshold, recovery)
                met.append(seen)
                after.append(state)
                count.append(failures)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(met, pa.string()), pa.array(after, pa.string()), pa.array(count, pa.int32())],
                [*batch.schema.names, "met", "state", "failures"],
            )

    ordered = rows.repartition("key").sortWithinPartitions("key", "at", "event")
    return ordered.mapInArrow(run, "key long, event long, at double, failed boolean, met string, state string, failures int")
