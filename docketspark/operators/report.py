"""Dataset-level quality reports over validated documents."""

from __future__ import annotations

import datetime
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.operators.validate import issue_rows, validate
from docketspark.plans.schema import CASE_SCHEMA, INFO, Schema
from docketspark.sources.files import read_json

#: Completeness buckets: [low, high) of the score, the last one closed.
BUCKETS = ("0-20%", "20-40%", "40-60%", "60-80%", "80-100%")


def summary(validated: DataFrame) -> DataFrame:
    """One row: total_cases, valid_cases, invalid_cases, pass_rate, avg_completeness."""
    counted = validated.agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if("valid").alias("valid_cases"),
        F.coalesce(F.avg("completeness_score"), F.lit(0.0)).alias("avg_completeness"),
    )
    rate = F.col("valid_cases") / F.greatest("total_cases", F.lit(1))
    return counted.select(
        "total_cases", "valid_cases", (F.col("total_cases") - F.col("valid_cases")).alias("invalid_cases"),
        rate.alias("pass_rate"), "avg_completeness",
    )


def field_completeness(validated: DataFrame, schema: Schema = CASE_SCHEMA) -> DataFrame:
    """field, completeness: the mean score of each field, from one wide aggregate."""
    means = validated.agg(*[F.avg(F.col("field_scores")[s.name]).alias(s.name) for s in schema])
    return means.select(F.explode(F.create_map(*[x for s in schema for x in (F.lit(s.name), F.col(f"`{s.name}`"))])).alias("field", "completeness"))


def severity_counts(validated: DataFrame) -> DataFrame:
    """severity, n of the severities that occur."""
    return issue_rows(validated).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def top_issues(validated: DataFrame, k: int = 20) -> DataFrame:
    """field, message, severity, n: the k most frequent issues, notes left out, ties in order of their text."""
    counted = issue_rows(validated).where(F.col("severity") != INFO).groupBy("field", "message", "severity").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "field", "message", "severity").limit(k)


def completeness_distribution(validated: DataFrame) -> DataFrame:
    """bucket, n for all five buckets."""
    percent = F.col("completeness_score") * 100
    inside = [(percent >= 20 * k) & (percent < 20 * (k + 1) if k < 4 else F.lit(True)) for k in range(5)]
    counted = validated.agg(*[F.count_if(x).alias(b) for x, b in zip(inside, BUCKETS, strict=True)])
    return counted.select(F.explode(F.create_map(*[x for b in BUCKETS for x in (F.lit(b), F.col(f"`{b}`"))])).alias("bucket", "n"))


def totals(validated: DataFrame, schema: Schema = CASE_SCHEMA) -> DataFrame:
    """One row of everything that is a total: those of `summary`, `fields` (array of means in schema order), `buckets` (array of counts)."""
    percent = F.col("completeness_score") * 100
    inside = [(percent >= 20 * k) & (percent < 20 * (k + 1) if k < 4 else F.lit(True)) for k in range(5)]
    one = validated.agg(
        F.count(F.lit(1)).alias("total_cases"), F.count_if("valid").alias("valid_cases"),
        F.coalesce(F.avg("completeness_score"), F.lit(0.0)).alias("avg_completeness"),
        *[F.avg(F.col("field_scores")[s.name]).alias(f"_f{k}") for k, s in enumerate(schema)],
        *[F.count_if(x).alias(f"_b{k}") for k, x in enumerate(inside)],
    )
    return one.select(
        "total_cases", "valid_cases", (F.col("total_cases") - F.col("valid_cases")).alias("invalid_cases"),
        (F.col("valid_cases") / F.greatest("total_cases", F.lit(1))).alias("pass_rate"), "avg_completeness",
        F.array(*[F.col(f"_f{k}") for k in range(len(schema))]).cast("array<double>").alias("fields"),
        F.array(*[F.col(f"_b{k}") for k in range(5)]).alias("buckets"),
    )


def compare(before: DataFrame, after: DataFrame, schema: Schema = CASE_SCHEMA) -> DataFrame:
    """metric, before, after, delta for the totals and each of after's fields; one pass over each side."""

    def long(validated: DataFrame, name: str) -> DataFrame:
        one = totals(validated, schema)
        rows = [("cases", F.col("total_cases").cast("double")), ("pass_rate", F.col("pass_rate")), ("completeness", F.col("avg_completeness"))]
        rows += [(f"field:{s.name}", F.coalesce(F.col("fields")[k], F.lit(0.0))) for k, s in enumerate(schema)]
        return one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias(name)) for m, v in rows]))).dropDuplicates(["metric"])

    both = long(after, "after").join(long(before, "before"), "metric", "left")
    earlier = F.coalesce("before", F.lit(0.0))
    return both.select("metric", earlier.alias("before"), "after", (F.col("after") - earlier).alias("delta"))


#: A partial report: how often each entry was counted, and the sum of its values.
PARTIAL = "kind string, field string, message string, severity string, n long, total decimal(38,12)"


def partial(validated: DataFrame, schema: Schema = CASE_SCHEMA, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows of PARTIAL for a batch of documents, read once: sums and counts that add up with those of any other batch.

    With `by`, columns of validated, there are rows for each of their values, so many batches take one pass. Sums are decimals, so that merging in any order gives the same digits.
    """
    number = lambda x: x.cast("decimal(18,12)")
    none = F.lit(None).cast("string")

    def entry(kind: str, value: Column, field: Column = none, message: Column = none, severity: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), field.alias("field"), message.alias("message"), severity.alias("severity"), value.alias("value"))

    percent = F.col("completeness_score") * 100
    bucket = F.element_at(F.array(*map(F.lit, BUCKETS)), F.greatest(F.least(F.floor(percent / 20), F.lit(4)), F.lit(0)).cast("int") + 1)
    one = [entry("valid", number(F.col("valid").cast("int"))), entry("completeness", number(F.col("completeness_score"))), entry("bucket", number(F.lit(1)), bucket)]
    one += [entry("field", number(F.col("field_scores")[s.name]), F.lit(s.name)) for s in schema]
    issues = F.transform("issues", lambda i: entry("issue", number(F.lit(1)), i["field"], i["message"], i["severity"]))
    rows = validated.select(*by, F.inline(F.concat(F.array(*one), issues)))
    return merged(rows.where("value is not null").select(*by, "kind", "field", "message", "severity", F.lit(1).cast("long").alias("n"), F.col("value").alias("total")), by)


def merged(partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One partial report of any number of them, or one for each value of `by`, as rows of one table."""
    keys = (*by, "kind", "field", "message", "severity")
    return partials.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,12)").alias("total")).select(*keys, "n", "total")


def summary_of(partials: DataFrame) -> DataFrame:
    """What `summary` says of the documents of these partial reports."""
    of = lambda kind, c: F.sum(F.when(F.col("kind") == kind, F.col(c)))
    one = partials.agg(
        F.coalesce(of("valid", "n"), F.lit(0)).alias("total_cases"), F.coalesce(of("valid", "total"), F.lit(0)).cast("long").alias("valid_cases"),
        (of("completeness", "total").cast("double") / of("completeness", "n")).alias("_mean"),
    )
    return one.select(
        "total_cases", "valid_cases", (F.col("total_cases") - F.col("valid_cases")).alias("invalid_cases"),
        (F.col("valid_cases") / F.greatest("total_cases", F.lit(1))).alias("pass_rate"), F.coalesce("_mean", F.lit(0.0)).alias("avg_completeness"),
    )


def top_issues_of(partials: DataFrame, k: int = 20) -> DataFrame:
    """What `top_issues` says of the documents of these partial reports."""
    issues = merged(partials.where((F.col("kind") == "issue") & (F.col("severity") != INFO)))
    return issues.select("field", "message", "severity", "n").orderBy(F.desc("n"), "field", "message", "severity").limit(k)


def compare_of(before: DataFrame, after: DataFrame) -> DataFrame:
    """What `compare` says of the documents of two sets of partial reports."""

    def long(partials: DataFrame, name: str) -> DataFrame:
        one = merged(partials.where(F.col("kind").isin("valid", "completeness", "field")))
        mean = F.col("total").cast("double") / F.col("n")
        metric = F.when(F.col("kind") == "valid", "pass_rate").when(F.col("kind") == "field", F.concat(F.lit("field:"), "field")).otherwise("completeness")
        counts = one.where("kind = 'valid'").select(F.lit("cases").alias("metric"), F.col("n").cast("double").alias(name))
        return one.select(metric.alias("metric"), mean.alias(name)).unionByName(counts)

    both = long(after, "after").join(long(before, "before"), "metric", "left")
    earlier = F.coalesce("before", F.lit(0.0))
    return both.select("metric", earlier.alias("before"), "after", (F.col("after") - earlier).alias("delta"))


def report(cases: DataFrame, schema: Schema = CASE_SCHEMA, strict: bool = False, k: int = 20) -> dict:
    """The whole report as a dictionary.

    Two aggregates pass over the documents, one for the totals and one that counts issues by field,
    message and severity; only totals, counts by severity and the k most frequent issues are collected.
    """
    validated = validate(cases, schema, strict)
    one = totals(validated, schema).first()
    plain = {n: round(v, 4) if isinstance(v, float) else v for n, v in one.asDict().items() if n not in ("fields", "buckets")}
    if not one.total_cases:
        return {"generated_at": datetime.datetime.now().isoformat(), **plain, "field_completeness": {}, "severity_counts": {}, "top_issues": [], "completeness_distribution": {}}
    counted = issue_rows(validated).groupBy("field", "message", "severity").agg(F.count(F.lit(1)).alias("n"))
    # the small side of one plan: all severities' sums, and the first k issues
    top = counted.where(F.col("severity") != INFO).orderBy(F.desc("n"), "field", "message", "severity").limit(k)
    sums = counted.groupBy("severity").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("message"), "severity", "n")
    rows = top.unionByName(sums).collect()
    return {
        "generated_at": datetime.datetime.now().isoformat(),
        **plain,
        "field_completeness": {s.name: round(v, 4) for s, v in zip(schema, one.fields, strict=True) if v is not None},
        "severity_counts": {r.severity: r.n for r in rows if r.field is None},
        "top_issues": [{"field": r.field, "message": r.message, "severity": r.severity, "count": r.n} for r in rows if r.field is not None],
        "completeness_distribution": dict(zip(BUCKETS, one.buckets, strict=True)),
    }


def report_folder(spark: SparkSession, folder: str, output: str | None = None, schema: Schema = CASE_SCHEMA) -> dict:
    """The report of a folder of JSON documents, malformed ones left out; also written to `output` if given."""
    found = report(read_json(spark, folder, tolerant=True), schema)
    if output:
        save(found, output)
    return found


def save(found: dict, path: str) -> None:
    """Writes a report, which is a few kilobytes of the driver's, as JSON."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(found, indent=2, ensure_ascii=False), encoding="utf-8")


def as_text(found: dict) -> str:
    """The report for a terminal."""
    out = [f"Report of {found['generated_at']}", f"cases {found['total_cases']:,}, valid {found['valid_cases']:,} ({found['pass_rate']:.1%}), completeness {found['avg_completeness']:.1%}"]
    for name, score in sorted(found["field_completeness"].items(), key=lambda x: -x[1]):
        out.append(f"{name:>16} {score:6.1%} " + "#" * round(score * 20))
    out += [f"{i['severity']:>8} {i['field']}: {i['message']} ({i['count']})" for i in found["top_issues"][:10]]
    return "\n".join(out)
