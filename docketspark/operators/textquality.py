"""Text-quality report of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions import textquality as tq


def text_quality(cases: DataFrame, id_: str = "id", text: str = "text") -> DataFrame:
    """id, is_empty, word and sentence counts, one flag for each artifact, artifact_count, quality_score.

    Null and empty texts are empty: their counts and flags are null and their score is 0.
    """
    some = F.when(F.length(F.col(text)) > 0, F.col(text))
    counted = cases.select(F.col(id_).alias("id"), some.alias("t")).withColumns(
        {"word_count": tq.word_count(F.col("t")), "sentence_count": tq.sentence_count(F.col("t"))}
    )
    flagged = counted.withColumns(tq.artifacts(F.col("t"), F.col("word_count")))
    n = sum((F.col(a).cast("int") for a in tq.ARTIFACTS[1:]), F.col(tq.ARTIFACTS[0]).cast("int"))
    whole = flagged.withColumn("artifact_count", n)
    average = F.when(F.col("sentence_count") > 0, F.col("word_count") / F.col("sentence_count")).when(F.col("t").isNotNull(), 0.0)
    return whole.select(
        "id", F.col("t").isNull().alias("is_empty"), "word_count", "sentence_count", average.alias("avg_sentence_length"),
        *tq.ARTIFACTS, "artifact_count",
        F.coalesce(tq.quality_score(F.col("word_count"), F.col("artifact_count")), F.lit(0.0)).alias("quality_score"),
    )
