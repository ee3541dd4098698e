"""Citations over a corpus: which are cited, and in how many documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.functions.citations import extract, extract_all, merged_patterns, matches


def citations_by_type(cases: DataFrame, custom: Mapping[str, str] | None = None, id_: str = "id", text: str = "text") -> DataFrame:
    """id, type, citation: one row for each distinct citation of a type in a document."""
    typed = F.array(
        *[
            F.struct(F.lit(name).alias("type"), matches(F.col(text), pattern).alias("found"))
            for name, pattern in merged_patterns(custom).items()
        ]
    )
    each = cases.select(F.col(id_).alias("id"), F.explode(typed).alias("t"))
    return each.select("id", "t.type", F.explode("t.found").alias("citation"))


def citation_counts(cases: DataFrame, custom: Mapping[str, str] | None = None, id_: str = "id", text: str = "text") -> DataFrame:
    """id, citation, n: by how many types a document's citation is matched."""
    return citations_by_type(cases, custom, id_, text).groupBy("id", "citation").agg(F.count(F.lit(1)).alias("n"))


def most_cited(cases: DataFrame, k: int = 20, custom: Mapping[str, str] | None = None, text: str = "text") -> DataFrame:
    """citation, n: the k most cited ones over all documents, ties by citation."""
    cited = cases.select(F.explode(extract_all(F.col(text), custom)).alias("citation"))
    return cited.groupBy("citation").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "citation").limit(k)


def citation_summary(cases: DataFrame, custom: Mapping[str, str] | None = None, text: str = "text") -> DataFrame:
    """One row: cases_analyzed, cases_with_citations, total_citations, unique_citations, avg_per_case."""
    each = cases.select(F.posexplode_outer(extract_all(F.col(text), custom)).alias("k", "citation"))
    # one pass: a document counts at its first citation, or at the row that stands for none
    cited = each.groupBy("citation").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("k", F.lit(0)) == 0).alias("documents"))
    some = F.col("citation").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    totals = cited.agg(
        total("documents").alias("cases_analyzed"), total(F.when(some, F.col("documents"))).alias("cases_with_citations"),
        total(F.when(some, F.col("n"))).alias("total_citations"), F.count("citation").alias("unique_citations"),
    )
    return totals.withColumn("avg_per_case", (F.col("total_citations") / F.greatest("cases_analyzed", F.lit(1))).cast("double"))


__all__ = ["citation_counts", "citation_summary", "citations_by_type", "extract", "most_cited"]
