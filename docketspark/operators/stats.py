"""Corpus statistics and their comparison between periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def _top(values: DataFrame, name: str, k: int | None) -> DataFrame:
    counted = values.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(F.desc("n"), name)
    return ordered.limit(k) if k else ordered


def court_distribution(cases: DataFrame, k: int = 10) -> DataFrame:
    """court, n: the k most frequent courts; a missing court is `Unknown`."""
    return _top(cases.select(F.coalesce("court", F.lit(UNKNOWN)).alias("court")), "court", k)


def year_distribution(cases: DataFrame) -> DataFrame:
    """year, n for every year in order, `Unknown` last."""
    years = cases.select(F.coalesce(F.col("year").cast("string"), F.lit(UNKNOWN)).alias("year"))
    return years.groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def judge_frequency(cases: DataFrame, k: int = 10) -> DataFrame:
    """judge, n: the k judges named most often."""
    return _top(cases.select(F.explode("judges").alias("judge")), "judge", k)


def _text_stats(chars: Column, where: Column) -> list[Column]:
    some = F.when(where & (chars > 0), chars)
    return [
        F.coalesce(F.bround(F.avg(some)), F.lit(0)).cast("long").alias("avg_length"),
        F.coalesce(F.max(some), F.lit(0)).cast("long").alias("max_length"),
        F.coalesce(F.min(some), F.lit(0)).cast("long").alias("min_length"),
        F.count(some).alias("cases_with_text"),
    ]


def text_stats(cases: DataFrame) -> DataFrame:
    """One row: total_cases and average, maximum, minimum and count of the lengths of non-empty texts."""
    return cases.agg(F.count(F.lit(1)).alias("total_cases"), *_text_stats(F.length("text"), F.lit(True)))


def compare_periods(cases: DataFrame, first: tuple[int, int], second: tuple[int, int], year: str = "year") -> DataFrame:
    """One row of both periods' text statistics and their changes, in one pass; bounds are inclusive, no year is in neither."""
    within = [F.coalesce(F.col(year).between(*p), F.lit(False)) for p in (first, second)]
    columns = []
    for k, where in enumerate(within, 1):
        columns.append(F.count_if(where).alias(f"total_cases_{k}"))
        columns += [c.alias(f"{n}_{k}") for c, n in zip(_text_stats(F.length("text"), where), ("avg_length", "max_length", "min_length", "cases_with_text"), strict=True)]
    pruned = cases.where(within[0] | within[1]).agg(*columns)
    return pruned.withColumns(
        {
            "case_count_change": F.col("total_cases_2") - F.col("total_cases_1"),
            "avg_length_change": F.col("avg_length_2") - F.col("avg_length_1"),
        }
    )


def corpus_stats(cases: DataFrame) -> dict:
    """All statistics as a dictionary; only small aggregates reach the driver."""
    texts = cases.transform(text_stats).first().asDict()
    total = texts.pop("total_cases")
    if not total:
        return {"error": "No cases found"}
    pairs = lambda df: {r[0]: r[1] for r in df.collect()}
    return {
        "total_cases": total,
        "courts": pairs(court_distribution(cases)),
        "years": pairs(year_distribution(cases)),
        "text_stats": texts,
        "top_judges": pairs(judge_frequency(cases)),
    }
