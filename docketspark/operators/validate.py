"""Validation: a score and at most one issue for each field, and the weighted completeness of a document.

Everything is one narrow projection. Typed columns have their kind checked when the plan is built;
variant columns are checked row by row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketspark.functions.regexes import unicode_pattern
from docketspark.plans.schema import CASE_SCHEMA, ERROR, INFO, KNOWN_EXTRA, WARNING, FieldSpec, Schema
from docketspark.sources.files import as_variants

_ISSUE = "struct<field:string,severity:string,message:string,value:string>"


def kind_of(kind: T.DataType) -> str:
    """The kind of value that a column's type holds."""
    if isinstance(kind, T.StringType):
        return "str"
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(kind, T.ArrayType):
        return "list"
    if isinstance(kind, (T.StructType, T.MapType)):
        return "dict"
    return "variant" if isinstance(kind, T.VariantType) else "other"


def _variant_kind(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    return (
        F.when(shape.startswith("STRING"), "str")
        .when(shape == "BOOLEAN", "bool")
        .when((shape == "BIGINT") | shape.rlike(r"^DECIMAL\(\d+,0\)$"), "int")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "float")
        .when(shape.startswith("ARRAY"), "list")
        .otherwise("dict")
    )


def _accepted(kinds: tuple[str, ...]) -> tuple[str, ...]:
    return (*kinds, "bool") if "int" in kinds else kinds  # a truth value passes for a whole number


def _issue(spec: FieldSpec, severity: str, message: Column, value: Column | None = None) -> Column:
    shown = F.lit(None).cast("string") if value is None else value
    return F.struct(F.lit(spec.name).alias("field"), F.lit(severity).alias("severity"), message.alias("message"), shown.alias("value"))


def field_checks(df: DataFrame, spec: FieldSpec, strict: bool) -> tuple[Column, Column]:
    """(score, issue) of one field; the first check that fails decides both."""
    must = ERROR if spec.required else WARNING
    kind_severity = ERROR if spec.required or strict else WARNING
    missing_issue = _issue(spec, ERROR, F.lit("Required field is missing")) if spec.required else F.lit(None).cast(_ISSUE)
    if spec.name not in df.columns:
        return F.lit(0.0), missing_issue
    value, kind = F.col(f"`{spec.name}`"), kind_of(df.schema[spec.name].dataType)
    steps: list[tuple[Column, Column, Column]] = []
    text = value
    if kind == "variant":
        missing = value.isNull() | F.is_variant_null(value)
        found = _variant_kind(value)
        steps.append((missing, F.lit(0.0), missing_issue))
        if spec.kinds:
            wrong = ~found.isin(*_accepted(spec.kinds))
            message = F.concat(F.lit(f"Expected type {' or '.join(spec.kinds)}, got "), found)
            steps.append((wrong, F.lit(0.2), _issue(spec, kind_severity, message)))
        text = F.when(found == "str", F.try_variant_get(value, "$", "string"))
        measured = True
    else:
        steps.append((value.isNull(), F.lit(0.0), missing_issue))
        if spec.kinds and kind not in _accepted(spec.kinds):
            message = F.lit(f"Expected type {' or '.join(spec.kinds)}, got {kind}")
            steps.append((F.lit(True), F.lit(0.2), _issue(spec, kind_severity, message)))
        measured = kind == "str"
    full: Column = F.lit(1.0)
    if measured:
        length = F.length(text)
        if spec.min_length:
            low = length.cast("double") / spec.min_length
            message = F.format_string(f"Too short: %d chars (min: {spec.min_length})", length)
            steps.append((length < spec.min_length, F.least(low, F.lit(0.8)), _issue(spec, must, message)))
            ample = F.greatest(F.least(length.cast("double") / (10 * spec.min_length), F.lit(1.0)), F.lit(0.9))
            full = F.coalesce(ample, F.lit(1.0))
        if spec.max_length:
            message = F.format_string(f"Too long: %d chars (max: {spec.max_length})", length)
            steps.append((length > spec.max_length, F.lit(0.9), _issue(spec, WARNING, message)))
        if spec.pattern:
            bad = ~text.rlike(unicode_pattern(spec.pattern))
            message = F.lit("Does not match expected pattern")
            steps.append((bad, F.lit(0.7), _issue(spec, WARNING, message, F.substring(text, 1, 100))))
    if spec.check:
        said = spec.check(value)
        steps.append((said.isNotNull(), F.lit(0.8), _issue(spec, WARNING, said)))
    score, issue = F.lit(None), F.lit(None)
    for k, (bad, value_, message_) in enumerate(steps):
        score = F.when(bad, value_) if not k else score.when(bad, value_)
        issue = F.when(bad, message_) if not k else issue.when(bad, message_)
    return score.otherwise(full), issue.otherwise(F.lit(None).cast(_ISSUE))


def _unknown_issues(df: DataFrame, schema: Schema, raw: str | None) -> Column:
    """Notes on fields that the schema doesn't have: keys of the raw JSON where it is kept, else columns that are not null."""
    named = {s.name for s in schema} | set(KNOWN_EXTRA)
    note = lambda name: F.struct(name.alias("field"), F.lit(INFO).alias("severity"), F.lit("Unknown field not in schema").alias("message"), F.lit(None).cast("string").alias("value"))
    if raw:
        keys = F.coalesce(F.json_object_keys(F.col(raw)), F.array().cast("array<string>"))
        odd = F.filter(F.array_except(keys, F.array(*map(F.lit, sorted(named)))), lambda k: ~k.startswith("_"))
        return F.transform(odd, note)
    odd = [c for c in df.columns if c not in named and not c.startswith("_")]
    notes = [F.when(F.col(f"`{c}`").isNotNull(), note(F.lit(c))) for c in odd]
    return F.filter(F.array(*notes), lambda x: x.isNotNull()) if notes else F.array().cast(f"array<{_ISSUE}>")


def validate(cases: DataFrame, schema: Schema = CASE_SCHEMA, strict: bool = False, raw: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """case_id, valid, completeness_score, field_scores (map), issues (array), and the columns to keep, one row a document.

    strict makes a wrong kind of value an error in fields that are not required too, and nothing else.
    raw names a column with the document's JSON text, from which unknown fields are then read.
    """
    checks = [(s, *field_checks(cases, s, strict)) for s in schema]
    total = sum(s.weight for s in schema)
    own_id = F.coalesce(F.col("id").cast("string"), F.lit("<unknown>")) if "id" in cases.columns else F.lit("<unknown>")
    extra = _unknown_issues(cases, schema, raw)
    scored = cases.select(
        own_id.alias("case_id"),
        *[c.alias(f"_s{k}") for k, (_, c, _) in enumerate(checks)],
        F.concat(F.filter(F.array(*[i for _, _, i in checks]), lambda x: x.isNotNull()), extra).alias("issues"),
        *keep,
    )
    weighted = [F.col(f"_s{k}") * F.lit(float(s.weight)) for k, s in enumerate(schema)]
    score = reduce(lambda a, b: a + b, weighted) / F.lit(float(total)) if total else F.lit(0.0)
    last = {s.name: k for k, s in enumerate(schema)}  # a field named twice counts twice in the score; the map has its last one
    by_field = F.create_map(*[x for name, k in last.items() for x in (F.lit(name), F.col(f"_s{k}"))])
    return scored.select(
        "case_id",
        (~F.exists("issues", lambda i: i["severity"] == ERROR)).alias("valid"),
        score.alias("completeness_score"),
        by_field.alias("field_scores"),
        "issues",
        *keep,
    )


def errors(issues: Column) -> Column:
    return F.filter(issues, lambda i: i["severity"] == ERROR)


def warnings(issues: Column) -> Column:
    return F.filter(issues, lambda i: i["severity"] == WARNING)


def issue_rows(validated: DataFrame) -> DataFrame:
    """case_id, field, severity, message, value: one row an issue."""
    return validated.select("case_id", F.inline("issues"))


def validate_case(spark: SparkSession, case: Mapping, schema: Schema = CASE_SCHEMA, strict: bool = False) -> dict:
    """The dictionary of one case's validation; its values keep the kinds they have."""
    text = json.dumps(dict(case), ensure_ascii=False, default=str)
    return as_dict(validate(as_variants(spark.createDataFrame([(text,)], "value string"), schema), schema, strict, raw="_raw").first())


def as_dict(row: Row) -> dict:
    """A validated row as a dictionary: counts of issues by severity, scores to three places."""
    found = [i.asDict() for i in row.issues]
    return {
        "case_id": row.case_id, "valid": row.valid, "completeness_score": round(row.completeness_score, 3),
        "error_count": sum(i["severity"] == ERROR for i in found), "warning_count": sum(i["severity"] == WARNING for i in found),
        "field_scores": {k: round(v, 3) for k, v in row.field_scores.items()}, "issues": found,
    }


def as_dicts(validated: DataFrame) -> DataFrame:
    """case_id, valid, completeness_score, error_count, warning_count, field_scores, issues: the same for all rows, with scores rounded."""
    return validated.select(
        "case_id", "valid", F.round("completeness_score", 3).alias("completeness_score"), F.size(errors(F.col("issues"))).alias("error_count"),
        F.size(warnings(F.col("issues"))).alias("warning_count"), F.transform_values("field_scores", lambda _, v: F.round(v, 3)).alias("field_scores"), "issues",
    )
