"""Resumable ingest: new JSON Lines files flow into a CaseStore, the checkpoint is where it resumes."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketspark.sources.files import CASE_TYPE
from docketspark.sources.store import CaseStore


def ingest(spark: SparkSession, source: str, store: CaseStore, checkpoint: str, late: str | None = None) -> StreamingQuery:
    """Reads every file that came since the last run and saves its cases, each micro-batch under its number, so that a retry replaces it.

    With `late` (as "30 minutes"), `_scraped_at` of the lines is their time: the first line of an id
    counts and later ones within that span don't, across runs as well, and lines older than
    the newest by more than that are left out. State is kept for that span only.
    """
    arriving = spark.readStream.schema(CASE_TYPE).json(source)
    if late:
        timed = arriving.withColumn("_at", F.to_timestamp("_scraped_at")).withWatermark("_at", late)
        arriving = timed.dropDuplicatesWithinWatermark(["id"]).drop("_at")
    writer = arriving.writeStream.foreachBatch(lambda batch, number: store.save(batch, f"stream-{number}") and None)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
