"""Corpus statistics over documents as they are: each field of the kind that its file gave it.

The typed statistics read columns of one type each. Here a field is a variant: a court may be a
name, a number or null, a year 2024 or "2023", judges a list, a name or nothing. Kinds are
told apart row by row and counted as keys of their own, so nothing is coerced and nothing raises.

An absent field is `Unknown`, a null one the null key of kind `null`. Numbers that are equal are one
key (2024 and 2024.0). Judges count where the field is a list, each element as a key of its kind; a
single name is no list. A text's length is its characters, or its elements if it is a list. A year
is in a period if it is a number between the bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketspark.operators.stats import UNKNOWN, _text_stats

NUMBERS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT")


def kind(value: Column) -> Column:
    """absent, null, text, number, truth, list or object."""
    name = F.schema_of_variant(value)
    of = F.when(value.isNull(), "absent").when(name == "VOID", "null").when(name == "STRING", "text").when(name == "BOOLEAN", "truth")
    return of.when(name.startswith("ARRAY"), "list").when(name.startswith("OBJECT"), "object").when(F.regexp_extract(name, "^[A-Z]+", 0).isin(*NUMBERS), "number").otherwise("text")


def _key(value: Column) -> tuple[Column, Column]:
    """A value as text, and its kind: what counts as the same key."""
    of = kind(value)
    plain = F.when(of.isin("list", "object"), F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))
    # 2024.0 is 2024
    number = F.regexp_replace(plain, F.lit(r"\.0+$"), F.lit(""))
    return F.when(of == "absent", UNKNOWN).when(of == "number", number).otherwise(plain), F.when(of == "absent", "text").otherwise(of)


def _counted(values: DataFrame, name: str, k: int | None) -> DataFrame:
    text, of = _key(F.col("value"))
    counted = values.select(text.alias(name), of.alias("kind")).groupBy(name, "kind").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "kind", name).limit(k) if k else counted


def court_distribution(cases: DataFrame, k: int = 10, court: str = "court") -> DataFrame:
    """court, kind, n: the k most frequent courts."""
    return _counted(cases.select(F.col(court).alias("value")), "court", k)


def year_distribution(cases: DataFrame, year: str = "year") -> DataFrame:
    """year, kind, n of every year."""
    return _counted(cases.select(F.col(year).alias("value")), "year", None)


def judge_frequency(cases: DataFrame, k: int = 10, judges: str = "judges") -> DataFrame:
    """judge, kind, n: the k elements that lists of judges hold most often."""
    listed = cases.where(kind(F.col(judges)) == "list")
    return _counted(listed.select(F.explode(F.try_variant_get(F.col(judges), "$", "array<variant>")).alias("value")), "judge", k)


def text_length(text: Column) -> Column:
    """Characters of a text, elements of a list, null for other kinds."""
    of = kind(text)
    return F.when(of == "text", F.length(F.try_variant_get(text, "$", "string"))).when(of == "list", F.size(F.try_variant_get(text, "$", "array<variant>")))


def text_stats(cases: DataFrame, text: str = "text") -> DataFrame:
    """One row: total_cases and average, maximum, minimum and count of the lengths of non-empty texts."""
    return cases.agg(F.count(F.lit(1)).alias("total_cases"), *_text_stats(text_length(F.col(text)), F.lit(True)))


def compare_periods(cases: DataFrame, first: tuple[int, int], second: tuple[int, int], year: str = "year", text: str = "text") -> DataFrame:
    """One row of both periods' text statistics and their changes, in one pass over the documents."""
    number = F.when(kind(F.col(year)) == "number", F.try_variant_get(F.col(year), "$", "double"))
    held = cases.select(number.alias("year"), text_length(F.col(text)).alias("length"))
    columns = []
    for k, bounds in enumerate((first, second), 1):
        where = F.coalesce(F.col("year").between(*bounds), F.lit(False))
        columns.append(F.count_if(where).alias(f"total_cases_{k}"))
        columns += [c.alias(f"{n}_{k}") for c, n in zip(_text_stats(F.col("length"), where), ("avg_length", "max_length", "min_length", "cases_with_text"), strict=True)]
    changes = {f"{name}_change": F.col(f"{of}_2") - F.col(f"{of}_1") for name, of in (("case_count", "total_cases"), ("avg_length", "avg_length"))}
    return held.agg(*columns).withColumns(changes)


def corpus_stats(cases: DataFrame, k: int = 10) -> dict:
    """All statistics as a dictionary; keys that are no text carry their kind. Only small aggregates reach the driver."""
    texts = text_stats(cases).first().asDict()
    total = texts.pop("total_cases")
    if not total:
        return {"error": "No cases found"}
    shown = lambda r: r[0] if r.kind in ("text", "number") else f"{r[0]} ({r.kind})" if r[0] is not None else None
    pairs = lambda df: {shown(r): r.n for r in df.collect()}
    return {
        "total_cases": total,
        "courts": pairs(court_distribution(cases, k)),
        "years": pairs(year_distribution(cases).orderBy("kind", "year")),
        "text_stats": texts,
        "top_judges": pairs(judge_frequency(cases, k)),
    }
