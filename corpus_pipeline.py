"""A corpus pipeline of five stages, each an operator over all that its predecessor kept.

Toxic documents go, one document of each near-duplicate group stays, repeated passages are cut out,
documents that hold benchmark passages go, and the rest is mixed to target weights. A stage's result
is written as Parquet and read back as the next stage's input. Stages share nothing: each returns a
lazy result that stays good whatever runs after it, built on its input and on tables of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketspark.llm import op2_jaccard, op4_suffix, op6_decontamination, op7_mixing, op9_toxicity
from docketspark.llm.common import removed, scratch, written

#: A passage is cut where a string of so many bytes also starts earlier.
PASSAGE_BYTES = 100


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; labels come from the table of that name."""
    return op9_toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group linked by a Jaccard similarity of 0.8 over five-word shingles."""
    return op2_jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start earlier in the corpus."""
    return op4_suffix.deduplicated(docs, PASSAGE_BYTES)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return op6_decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words that the mix takes of each document."""
    return op7_mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the table of documents. Each result is stored; what it was made of goes then, the result before it too."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES:
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), "stage", keep=True)
        removed(spark, before)
        before = [docs.inputFiles()[0].rsplit("/", 1)[0]] if docs.inputFiles() else []
    return docs


#: The stages hold trained weights, components and byte-level indexes, which SQL doesn't express.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
