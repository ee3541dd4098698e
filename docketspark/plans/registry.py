"""Registered queries over the generated tables, and their DuckDB oracles."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.functions import fingerprint as fp
from docketspark.functions import textquality as tq
from docketspark.functions.citations import extract
from docketspark.functions.resilience import RetryPolicy, schedule
from docketspark.operators import breaker, citations, dedup, dynamic, links, report, stats, textquality
from docketspark.operators.validate import as_dicts, errors, issue_rows, validate, warnings
from docketspark.plans.cases_view import CASES_SQL, cases, tables
from docketspark.plans.schema import CASE_SCHEMA, FieldSpec, with_field, without_field
from docketspark.plans.stored import shared_folder
from docketspark.sources import batches, connectors, files, store
from docketspark.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, query: Query, sql: str | None = None, view: bool = True) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = f"with {CASES_SQL}\n{sql.strip()}" if view and not sql.strip().startswith("with") else sql.replace("{cases}", CASES_SQL)


# --- citations -------------------------------------------------------------------------------------------------

_TYPES_SQL = """
found as (
  select id, 'case_citation' as type, unnest(list_distinct(regexp_extract_all(text, '\\d{4}\\s+[A-Z]{2,6}\\s+\\d+'))) as citation from cases
  union all select id, 'statute_section', unnest(list_distinct(regexp_extract_all(text, '[Ss]ection\\s+\\d+[A-Za-z]?(?:\\s*\\([a-z0-9]+\\))?'))) from cases
  union all select id, 'article', unnest(list_distinct(regexp_extract_all(text, '[Aa]rticle\\s+\\d+[A-Za-z]?(?:\\s*\\([a-z0-9]+\\))?'))) from cases
  union all select id, 'order_rule', unnest(list_distinct(regexp_extract_all(text, '[Oo]rder\\s+[IVXLCDM]+\\s+[Rr]ule\\s+\\d+'))) from cases)
"""
_FOUND = "with {cases}, " + _TYPES_SQL.strip() + "\n"

_register("citation_extract", lambda s, d: citations.citations_by_type(cases(s, d)), _FOUND + "select id, type, citation from found")
_register(
    "citation_type_counts",
    lambda s, d: citations.citations_by_type(cases(s, d)).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("citation").alias("n_unique")),
    _FOUND + "select type, count(*) as n, count(distinct citation) as n_unique from found group by type",
)
_register("citation_counts", lambda s, d: citations.citation_counts(cases(s, d)), _FOUND + "select id, citation, count(*) as n from found group by id, citation")
_register(
    "citation_top20", lambda s, d: citations.most_cited(cases(s, d)),
    _FOUND + "select citation, count(*) as n from found group by citation order by n desc, citation limit 20",
)
_register(
    "citation_summary", lambda s, d: citations.citation_summary(cases(s, d)),
    _FOUND + """select (select count(*) from cases) as cases_analyzed, count(distinct id) as cases_with_citations,
      count(*) as total_citations, count(distinct citation) as unique_citations,
      count(*)::double / greatest((select count(*) from cases), 1) as avg_per_case from found""",
)
CUSTOM_PATTERNS = {"reporter_year": r"(\d{4})\s+SC\s+\d+", "article": r"Article\s+\d+"}
_register(
    "citation_custom_pattern", lambda s, d: citations.citations_by_type(cases(s, d), CUSTOM_PATTERNS),
    "with {cases}, " + _TYPES_SQL.strip() + """
    select * from found where type <> 'article'
    union all select id, 'article', unnest(list_distinct(regexp_extract_all(text, 'Article\\s+\\d+'))) from cases
    union all select id, 'reporter_year', unnest(list_distinct(regexp_extract_all(text, '(\\d{4})\\s+SC\\s+\\d+', 1))) from cases""",
)

# --- corpus statistics -----------------------------------------------------------------------------------------

_register(
    "stats_courts_top10", lambda s, d: stats.court_distribution(cases(s, d)),
    "select coalesce(court, 'Unknown') as court, count(*) as n from cases group by 1 order by n desc, court limit 10",
)
_register("stats_years", lambda s, d: stats.year_distribution(cases(s, d)), "select coalesce(cast(year as varchar), 'Unknown') as year, count(*) as n from cases group by 1")
_register(
    "stats_judges_top10", lambda s, d: stats.judge_frequency(cases(s, d)),
    "select judge, count(*) as n from (select unnest(judges) as judge from cases) group by judge order by n desc, judge limit 10",
)
_TEXT = "cast(coalesce(round_even(avg({x}), 0), 0) as bigint) as avg_length{k}, cast(coalesce(max({x}), 0) as bigint) as max_length{k}, cast(coalesce(min({x}), 0) as bigint) as min_length{k}, count({x}) as cases_with_text{k}"
_register("stats_text_length", lambda s, d: stats.text_stats(cases(s, d)), "select count(*) as total_cases, " + _TEXT.format(x="nullif(length(text), 0)", k="") + " from cases")
_P1, _P2 = (1992, 1994), (1995, 1998)
_register(
    "stats_compare_periods", lambda s, d: stats.compare_periods(cases(s, d), _P1, _P2),
    "select *, total_cases_2 - total_cases_1 as case_count_change, avg_length_2 - avg_length_1 as avg_length_change from (select "
    + ", ".join(
        f"count_if(year between {a} and {b}) as total_cases_{k}, " + _TEXT.format(x=f"case when year between {a} and {b} then nullif(length(text), 0) end", k=f"_{k}")
        for k, (a, b) in enumerate((_P1, _P2), 1)
    ) + " from cases)",
)
_register(
    "store_year_counts", lambda s, d: store.year_counts(cases(s, d)),
    "select coalesce(cast(year as varchar), 'unknown') as year_key, count(*) as n from cases where id <> '' group by 1",
)

# --- text quality ----------------------------------------------------------------------------------------------

_PHRASES = ("all rights reserved", "disclaimer", "terms of use", r"copyright \d{4}", "click here", r"page \d+ of \d+", "login required")
_BOILER = " + ".join(f"(length(t) - length(regexp_replace(t, '{p}', '', 'gi')))" for p in _PHRASES)


def _quality_sql(source: str) -> str:
    return f"""
counted as (
  select id, case when t <> '' then t end as t from {source}),
flagged as (
  select id, t, length(t) as chars,
    len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) as word_count,
    len(list_filter(regexp_split_to_array(t, '[.!?]+'), lambda x: regexp_matches(x, '\\S'))) as sentence_count
  from counted),
marked as (
  select *, regexp_matches(t, '\\s{{10,}}') as excessive_whitespace, regexp_matches(t, '<[a-zA-Z][^>]*>') as html_tags,
    regexp_matches(t, '[ï¿½â€™œ]') as encoding_errors, regexp_matches(t, '\\.\\.\\.\\s*$') or word_count < 50 as truncated,
    ({_BOILER})::double / chars > 0.3 as boilerplate_heavy from flagged),
summed as (
  select *, excessive_whitespace::int + html_tags::int + encoding_errors::int + truncated::int + boilerplate_heavy::int as artifact_count from marked)
select id, t is null as is_empty, cast(word_count as int) as word_count, cast(sentence_count as int) as sentence_count,
  case when sentence_count > 0 then word_count::double / sentence_count when t is not null then 0.0::double end as avg_sentence_length,
  excessive_whitespace, html_tags, encoding_errors, truncated, boilerplate_heavy, artifact_count,
  coalesce(cast(greatest(1.00 - case when word_count < 50 then 0.40 when word_count < 200 then 0.10 else 0.00 end - artifact_count * 0.15, 0.00) as double), 0.0::double) as quality_score
from summed"""


_register(
    "text_quality", lambda s, d: textquality.text_quality(cases(s, d)),
    "with {cases}, texts as (select id, text as t from cases), " + _quality_sql("texts").strip(),
)
_register(
    "text_quality_pages", lambda s, d: textquality.text_quality(tables(s, d, "pages")[0], "page_id", "html"),
    "with texts as (select page_id as id, html as t from pages), " + _quality_sql("texts").strip(), view=False,
)
_register(
    "text_quality_artifacts",
    lambda s, d: textquality.text_quality(cases(s, d)).agg(*[F.count_if(a).alias(a) for a in tq.ARTIFACTS], F.count_if("is_empty").alias("empty")),
    "with {cases}, texts as (select id, text as t from cases), quality as (with " + _quality_sql("texts").strip() + ")\nselect "
    + ", ".join(f"count_if({a}) as {a}" for a in tq.ARTIFACTS) + ", count_if(is_empty) as empty from quality",
)
_register(
    "boilerplate_ratio", lambda s, d: tables(s, d, "documents")[0].select("doc_id", tq.boilerplate_ratio(F.col("text")).alias("ratio")),
    f"select doc_id, case when length(t) > 0 then ({_BOILER})::double / length(t) else 0.0::double end as ratio from (select doc_id, text as t from documents)",
    view=False,
)

# --- validation ------------------------------------------------------------------------------------------------

_SPECS = {s.name: s for s in CASE_SCHEMA}
#: A schema with a longest length, a check and another weight, and without the fields the view lacks.
CUSTOM_SCHEMA = with_field(
    with_field(
        without_field(without_field(without_field(without_field(CASE_SCHEMA, "headnotes"), "statutes_cited"), "text"), "court"),
        FieldSpec("text", True, ("str",), 100, 3000, weight=2.0),
    ),
    FieldSpec("court", True, ("str",), 2, check=lambda c: F.when(c.startswith("I"), F.concat(F.lit("Unlikely court "), c)), weight=0.5),
)


def _field_sql(spec: FieldSpec, kind: str, extra: str = "") -> tuple[str, str]:
    """(score, issue) of one string field; doubles throughout."""
    c, low = spec.name, spec.min_length
    must = "error" if spec.required else "warning"
    issue = lambda sev, msg, val="null": f"{{'field': '{c}', 'severity': '{sev}', 'message': {msg}, 'value': {val}}}"
    score, said = [f"when {c} is null then 0e0"], [f"when {c} is null then " + (issue("error", "'Required field is missing'") if spec.required else "null")]
    full = "1e0"
    if kind == "str":
        if low:
            score.append(f"when length({c}) < {low} then least(length({c})::double / {low}, 8e-1)")
            said.append(f"when length({c}) < {low} then " + issue(must, f"'Too short: ' || length({c}) || ' chars (min: {low})'"))
            full = f"greatest(least(length({c})::double / {10 * low}, 1e0), 9e-1)"
        if spec.max_length:
            score.append(f"when length({c}) > {spec.max_length} then 9e-1")
            said.append(f"when length({c}) > {spec.max_length} then " + issue("warning", f"'Too long: ' || length({c}) || ' chars (max: {spec.max_length})'"))
        if spec.pattern:
            score.append(f"when not regexp_matches({c}, '{spec.pattern}') then 7e-1")
            said.append(f"when not regexp_matches({c}, '{spec.pattern}') then " + issue("warning", "'Does not match expected pattern'", f"substr({c}, 1, 100)"))
    if extra:
        score.append(f"when {extra} then 8e-1")
        said.append(f"when {extra} then " + issue("warning", f"'Unlikely court ' || {c}"))
    return f"case {' '.join(score)} else {full} end", f"case {' '.join(said)} end"


def _validated_sql(schema: tuple[FieldSpec, ...], where: str = "true") -> str:
    kinds = {"year": "int", "judges": "list"}
    parts = []
    for s in schema:
        if s.name in ("headnotes", "statutes_cited"):
            parts.append((s, "0e0", "null"))
        else:
            parts.append((s, *_field_sql(s, kinds.get(s.name, "str"), "court like 'I%'" if s.check else "")))
    total = sum(s.weight for s in schema)
    weighted = " + ".join(f"s{k} * {s.weight:e}" for k, (s, _, _) in enumerate(parts))
    scores = ", ".join(f"{sc} as s{k}" for k, (_, sc, _) in enumerate(parts))
    issues = ", ".join(x for _, _, x in parts if x != "null")
    return f"""checked as (select coalesce(id, '<unknown>') as case_id, {scores}, list_filter([{issues}], lambda x: x is not null) as issues from cases where {where}),
validated as (select *, ({weighted}) / {total:.17e} as completeness_score, len(list_filter(issues, lambda x: x.severity = 'error')) = 0 as valid from checked)"""


_BASE = "with {cases}, " + _validated_sql(CASE_SCHEMA) + "\n"
_issue_sql = "select case_id, i.field as field, i.severity as severity, i.message as message, i.value as value from (select case_id, unnest(issues) as i from validated)"


def _flat(validated: DataFrame) -> DataFrame:
    return validated.select(
        "case_id", "valid", F.round("completeness_score", 9).alias("completeness_score"),
        F.size(errors(F.col("issues"))).cast("long").alias("n_errors"), F.size(warnings(F.col("issues"))).cast("long").alias("n_warnings"),
    )


_flat_sql = """select case_id, valid, round(completeness_score, 9) as completeness_score,
  len(list_filter(issues, lambda x: x.severity = 'error')) as n_errors, len(list_filter(issues, lambda x: x.severity = 'warning')) as n_warnings from validated"""
_register("validate_cases", lambda s, d: _flat(validate(cases(s, d))), _BASE + _flat_sql)
_register("validate_issues", lambda s, d: issue_rows(validate(cases(s, d))), _BASE + _issue_sql)
_register(
    "validate_field_scores",
    lambda s, d: validate(cases(s, d)).select("case_id", *[F.round(F.col("field_scores")[n], 9).alias(f"score_{n}") for n in _SPECS]),
    _BASE + "select case_id, " + ", ".join(f"round(s{k}, 9) as score_{n}" for k, n in enumerate(_SPECS)) + " from validated",
)
_register("validate_custom_schema", lambda s, d: _flat(validate(cases(s, d), CUSTOM_SCHEMA)), "with {cases}, " + _validated_sql(CUSTOM_SCHEMA) + "\n" + _flat_sql)
_register(
    "validate_strict",
    # a year kept as an array is of the wrong kind: a warning, or an error if strict
    lambda s, d: issue_rows(validate(cases(s, d).withColumn("year", F.array("year")), strict=True)).groupBy("field", "severity", "message").agg(F.count(F.lit(1)).alias("n")),
    "with {cases}, " + _validated_sql(CASE_SCHEMA) + ", issue as (" + _issue_sql + """)
select field, severity, message, count(*) as n from issue group by all
union all select 'year', 'error', 'Expected type int or str, got list', count(*) from cases""",
)
_register(
    "validate_unknown_fields",
    lambda s, d: issue_rows(validate(cases(s, d).withColumn("docket", F.col("court")).withColumn("_note", F.lit("x")))).where("severity = 'info'").select("case_id", "field", "message"),
    "select id as case_id, 'docket' as field, 'Unknown field not in schema' as message from cases where court is not null",
)

# --- reports ---------------------------------------------------------------------------------------------------

_round6 = lambda df, *names: df.withColumns({n: F.round(n, 6) for n in names})
_summary = """select count(*) as total_cases, count_if(valid) as valid_cases, count_if(not valid) as invalid_cases,
  round(count_if(valid)::double / greatest(count(*), 1), 6) as pass_rate, round(coalesce(avg(completeness_score), 0), 6) as avg_completeness from validated"""
_register("report_summary", lambda s, d: _round6(report.summary(validate(cases(s, d))), "pass_rate", "avg_completeness"), _BASE + _summary)
_register(
    "report_field_completeness", lambda s, d: _round6(report.field_completeness(validate(cases(s, d))), "completeness"),
    _BASE + " union all ".join(f"select '{n}' as field, round(avg(s{k}), 6) as completeness from validated" for k, n in enumerate(_SPECS)),
)
_register("report_severity", lambda s, d: report.severity_counts(validate(cases(s, d))), _BASE + f"select severity, count(*) as n from ({_issue_sql}) group by severity")
_register(
    "report_top_issues", lambda s, d: report.top_issues(validate(cases(s, d))),
    _BASE + f"select field, message, severity, count(*) as n from ({_issue_sql}) group by all order by n desc, field, message, severity limit 20",
)
_register(
    "report_distribution", lambda s, d: report.completeness_distribution(validate(cases(s, d))),
    _BASE + """select bucket, count(v.k) as n from (values ('0-20%', 0), ('20-40%', 1), ('40-60%', 2), ('60-80%', 3), ('80-100%', 4)) b(bucket, k)
    left join (select least(floor(completeness_score * 100 / 20), 4) as k from validated) v on v.k = b.k group by bucket""",
)


def _compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus before and after documents without text were dropped."""
    all_cases = cases(spark, sf_dir)
    return _round6(report.compare(validate(all_cases), validate(all_cases.where("text is not null"))), "before", "after", "delta")


def _long_sql(source: str) -> str:
    fields = " ".join(f"union all select 'field:{n}', avg(s{k}) from {source}" for k, n in enumerate(_SPECS))
    return f"""select 'cases' as metric, count(*)::double as v from {source} union all select 'pass_rate', count_if(valid)::double / count(*) from {source}
      union all select 'completeness', avg(completeness_score) from {source} {fields}"""


_register(
    "report_compare", _compare,
    _BASE.rstrip() + ", later as (select * from validated where case_id in (select id from cases where text is not null))\n"
    + f"select a.metric, round(b.v, 6) as before, round(a.v, 6) as after, round(a.v - b.v, 6) as delta from ({_long_sql('later')}) a join ({_long_sql('validated')}) b using (metric)",
)

# --- fingerprints and duplicates -------------------------------------------------------------------------------

_NORMAL = r"trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g'), '[^\p{L}\p{N}\p{M}_\s]', '', 'g'))"


def _prints_sql(bits: int) -> str:
    """Fingerprints of documents: sums of signs over MD5 bits, packed as two signed halves."""
    words = {"hi": range(64), "lo": range(64, 128)} if bits == 128 else {"lo": range(64, 128)}
    sums = ", ".join(f"sum(case when (h.{w} >> {63 - i % 64}) & 1 = 1 then n else -n end) as b{i}" for w, r in words.items() for i in r)
    pack = lambda r: " + ".join(f"(case when b{i} > 0 then {1 << (63 - i % 64)}::ubigint else 0::ubigint end)" for i in r)
    hi = pack(range(64)) if bits == 128 else "0::ubigint"
    signed = lambda x: f"cast(case when {x} >= 9223372036854775808 then {x}::hugeint - 18446744073709551616 else {x}::hugeint end as bigint)"
    return f"""normal as (select doc_id, text, {_NORMAL} as t from documents),
grams as (select doc_id, unnest(case when length(t) = 0 then [] when length(t) < 3 then [t] else list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3)) end) as g from normal),
counted as (select doc_id, g, count(*) as n from grams group by all),
hashed as (select g, ('0x' || substr(md5(g), 1, 16))::ubigint as hi, ('0x' || substr(md5(g), 17, 16))::ubigint as lo from (select distinct g from counted)),
votes as (select doc_id, {sums} from counted join hashed h using (g) group by doc_id),
packed as (select doc_id, {hi} as uhi, {pack(range(64, 128))} as ulo from votes),
prints as (select n.doc_id, n.text, case when text <> '' then sha256(text) end as sha, coalesce({signed('uhi')}, 0) as hi, coalesce({signed('ulo')}, 0) as lo
  from normal n left join packed using (doc_id))"""


def _prints(spark: SparkSession, sf_dir: str, bits: int = 128) -> DataFrame:
    return dedup.fingerprints(tables(spark, sf_dir, "documents")[0], bits, id_="doc_id")


_register(
    "fingerprint_normalize", lambda s, d: tables(s, d, "documents")[0].select("doc_id", F.sha2(fp.normalised(F.col("text")), 256).alias("normal_sha")),
    f"select doc_id, sha256({_NORMAL}) as normal_sha from documents", view=False,
)
for _bits in (128, 64):
    _register(
        f"simhash{_bits}", lambda s, d, b=_bits: _prints(s, d, b).select("id", "hi", "lo"),
        f"with {_prints_sql(_bits)} select cast(doc_id as varchar) as id, hi, lo from prints", view=False,
    )
_register(
    "exact_hash_groups", lambda s, d: dedup.classes(_prints(s, d)).where("members > 1").select("sha", "representative", "members"),
    "select sha256(text) as sha, min(cast(doc_id as varchar)) as representative, count(*) as members from documents group by 1 having count(*) > 1", view=False,
)
_register(
    "exact_duplicate_members", lambda s, d: dedup.members(_prints(s, d)),
    """with g as (select cast(doc_id as varchar) as id, sha256(text) as sha from documents),
    c as (select sha, min(id) as representative, count(*) as n from g group by sha)
    select id, representative, 'exact_hash' as method from g join c using (sha) where n > 1""", view=False,
)
_PAIRS = """, reps as (select sha, min(cast(doc_id as varchar)) as id, any_value(hi) as hi, any_value(lo) as lo from prints group by sha),
pairs as (select a.id as id_a, b.id as id_b, 1 - (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::double / 128 as similarity
  from reps a join reps b on a.id < b.id)
"""
_register(
    "near_duplicate_pairs_95", lambda s, d: dedup.near_pairs(_prints(s, d), 0.95),
    f"with {_prints_sql(128)}{_PAIRS}select id_a, id_b, similarity, 'simhash' as method from pairs where similarity >= 0.95", view=False,
)
_register(
    "find_similar_top10", lambda s, d: dedup.find_similar(_prints(s, d), "7"),
    f"""with {_prints_sql(128)} select cast(b.doc_id as varchar) as id, 1 - (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::double / 128 as similarity, 'simhash' as method
    from prints a join prints b on a.doc_id = 7 and b.doc_id <> 7 order by similarity desc, id limit 10""", view=False,
)
_register(
    "dedup_stats", lambda s, d: dedup.dedup_stats(_prints(s, d)),
    """select (select count(*) from documents) as total_indexed, count(*) as exact_duplicate_groups, 0.85::double as threshold, 128::bigint as hash_bits
    from (select text from documents where text <> '' group by text having count(*) > 1)""", view=False,
)

# --- store, connectors, control plane --------------------------------------------------------------------------


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with a recorded year before 1996 count as fetched."""
    return cases(spark, sf_dir).where("year < 1996").select("id")


_register("skip_existing_anti", lambda s, d: store.unfetched(cases(s, d).select("id", "year"), _ledger(s, d)), "select id, year from cases where year is null or year >= 1996")
_register("is_fetched_semi", lambda s, d: cases(s, d).select("id", "court").join(_ledger(s, d), "id", "left_semi"), "select id, court from cases where year < 1996")
_register("batch_limit", lambda s, d: store.next_batch(cases(s, d).select("id", "year"), _ledger(s, d), 25), "select id, year from cases where year is null or year >= 1996 order by id limit 25")


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of their customer's record; the last by date, then key, wins."""
    orders = tables(spark, sf_dir, "orders")[0]
    stamp = F.struct("o_orderdate", "o_orderkey")
    return store.latest(orders.select(F.col("o_custkey").alias("id"), "o_orderkey", "o_totalprice", stamp.alias("_scraped_at"))).drop("_scraped_at")


_register(
    "upsert_latest", _upsert,
    "select o_custkey as id, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1", view=False,
)
_register(
    "connector_enumerate", lambda s, d: connectors.listed_years(s, 2020, 2024),
    "select 'case_' || y || '_' || lpad(k::varchar, 3, '0') as id, 'Case ' || k || ' of ' || y as title, y::int as year from range(2020, 2025) a(y), range(1, 11) b(k)", view=False,
)
_register(
    "retry_schedule", lambda s, d: schedule(s, 10, RetryPolicy(11, 2.0, 2.0, 60.0)),
    "select k as attempt, case when k = 0 then 0e0 else least(2e0 * pow(2, k - 1), 60e0) end as delay from range(0, 11) t(k)", view=False,
)
_register(
    "circuit_replay",
    lambda s, d: breaker.replay(tables(s, d, "events")[0], "user_id", "ts", F.col("event_type") == "error", "event_id", threshold=2, recovery=3600.0),
)
ORACLES["circuit_replay"] = """
with recursive e as (
  select user_id as key, event_id as event, epoch_us(ts) / 1e6 as "at", coalesce(event_type = 'error', false) as failed,
    row_number() over (partition by user_id order by ts, event_id) as k from events),
r as (
  select key, event, "at", failed, k, 'closed' as met, 'closed' as state, failed::int as failures, 0e0 as opened from e where k = 1
  union all
  select key, event, "at", failed, k, m, case when m = 'open' then 'open' when not failed then 'closed' when m = 'half_open' or f + 1 >= 2 then 'open' else 'closed' end,
    case when m = 'open' then f when not failed then 0 else f + 1 end, case when m <> 'open' and failed and (m = 'half_open' or f + 1 >= 2) then "at" else opened end
  from (select e.*, r.failures as f, r.opened, case when r.state = 'open' and e."at" - r.opened >= 3600 then 'half_open' else r.state end as m
        from r join e on e.key = r.key and e.k = r.k + 1))
select key, event, "at", failed, met, state, failures from r"""

# --- what is written and read back -----------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _documents_of_nations(spark: SparkSession, sf_dir: str, bad: bool = False) -> str:
    """A folder with one JSON document a nation, and a malformed one if bad."""
    path = _folder(spark, "json")
    nation = tables(spark, sf_dir, "nation")[0]
    rows = nation.select(F.concat(F.lit("N"), "n_nationkey").alias("id"), F.col("n_name").alias("title"), (F.col("n_nationkey") + 1990).alias("year"), F.col("n_nationkey").alias("k"))
    rows.write.partitionBy("k").json(path)
    if bad:
        file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/k=0/bad.json")
        out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file)
        out.writeBytes("{invalid json content")
        out.close()
    return path


_NATIONS_SQL = "select 'N' || n_nationkey as id, n_name as title, (1990 + n_nationkey)::int as year from nation"
_register("read_json_strict", lambda s, d: files.read_json(s, _documents_of_nations(s, d)).select("id", "title", "year"), _NATIONS_SQL, view=False)
_register("read_json_tolerant", lambda s, d: files.read_json(s, _documents_of_nations(s, d, bad=True), tolerant=True).select("id", "title", "year"), _NATIONS_SQL, view=False)
_register(
    "read_json_dynamic",
    lambda s, d: validate(files.read_dynamic(s, _documents_of_nations(s, d, bad=True)), raw="_raw").select("case_id", "valid", F.size("issues").cast("long").alias("n_issues")),
    "select 'N' || n_nationkey as case_id, false as valid, (1 + (length(n_name) < 5)::int)::bigint as n_issues from nation", view=False,
)


def _stored(spark: SparkSession, sf_dir: str) -> store.CaseStore:
    """A store of all cases, those before 1996 saved again with another title."""
    kept = store.CaseStore(spark, _folder(spark, "store"))
    all_cases = cases(spark, sf_dir)
    kept.save(all_cases, "first")
    kept.save(all_cases.where("year < 1996").withColumn("title", F.concat("title", F.lit("!"))), "second")
    return kept


_register("store_latest", lambda s, d: _stored(s, d).cases().select("id", "title", "year"), "select id, case when year < 1996 then title || '!' else title end as title, year from cases")
_register("store_ledger", lambda s, d: _stored(s, d).ledger().select("id", "batch"), "select id, 'first' as batch from cases")
_register(
    "store_jsonl", lambda s, d: files.read_jsonl(s, f"{_stored(s, d).path}/jsonl").select("id", "title", "year_key"),
    """select id, title, coalesce(cast(year as varchar), 'unknown') as year_key from cases
    union all select id, title || '!', cast(year as varchar) from cases where year < 1996""",
)
_register("store_lookup", lambda s, d: _stored(s, d).load("D0000007").select("id", "court", "year"), "select id, court, year from cases where id = 'D0000007'")


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of a store, filled once, as a row."""
    found = _stored(spark, sf_dir).stats()
    return spark.createDataFrame([tuple(found[k] for k in ("total_cases", "years", "tracked"))], "total_cases long, years long, tracked long")


_register(
    "store_stats", _stats,
    "select count(*) as total_cases, count(distinct coalesce(cast(year as varchar), 'unknown')) as years, count(*) as tracked from cases",
)
_register(
    "cases_source", lambda s, d: connectors.enumerate_years(s, "sample", 2020, 2024), ORACLES["connector_enumerate"], view=False,
)
_register(
    "fetch_in_parallel", lambda s, d: connectors.fetched(connectors.listed_years(s, 2020, 2024).select("id").repartition(5), "sample").select("id", "citation", "year"),
    "select 'case_' || y || '_' || lpad(k::varchar, 3, '0') as id, y || ' SC ' || k as citation, y::int as year from range(2020, 2025) a(y), range(1, 11) b(k)", view=False,
)

# --- maps, dictionaries, rendered rows -------------------------------------------------------------------------

_register(
    "citation_map", lambda s, d: cases(s, d).select("id", F.explode(extract(F.col("text"))).alias("type", "found")).select("id", "type", F.array_join(F.array_sort("found"), "|").alias("found")),
    _FOUND + "select id, type, string_agg(citation, '|' order by citation) as found from found group by id, type",
)
_register(
    "validate_dictionaries", lambda s, d: as_dicts(validate(cases(s, d))).select("case_id", "valid", F.col("error_count").cast("long"), F.col("warning_count").cast("long"), F.size("field_scores").cast("long").alias("n_fields")),
    _BASE + """select case_id, valid, len(list_filter(issues, lambda x: x.severity = 'error')) as error_count,
  len(list_filter(issues, lambda x: x.severity = 'warning')) as warning_count, """ + str(len(_SPECS)) + "::bigint as n_fields from validated",
)
REPEATED_SCHEMA = with_field(CASE_SCHEMA, FieldSpec("court", True, ("str",), 4, weight=2.0))
_register("validate_repeated_field", lambda s, d: _flat(validate(cases(s, d), REPEATED_SCHEMA)), "with {cases}, " + _validated_sql(REPEATED_SCHEMA) + "\n" + _flat_sql)


def _report_rows(found: dict) -> list[tuple[str, float]]:
    """The numbers of a report's dictionary as rows."""
    rows = [(k, float(v)) for k, v in found.items() if isinstance(v, (int, float))]
    return rows + [(f"{part}:{k}", float(v)) for part in ("field_completeness", "severity_counts", "completeness_distribution") for k, v in found[part].items()]


_report_sql = """select 'total_cases' as metric, count(*)::double as value from validated union all select 'valid_cases', count_if(valid)::double from validated
  union all select 'invalid_cases', count_if(not valid)::double from validated union all select 'pass_rate', round(count_if(valid)::double / count(*), 4) from validated
  union all select 'avg_completeness', round(avg(completeness_score), 4) from validated
  union all select 'severity_counts:' || severity, count(*)::double from (""" + _issue_sql + """) group by severity
  union all select 'completeness_distribution:' || bucket, count(v.k)::double from (values ('0-20%', 0), ('20-40%', 1), ('40-60%', 2), ('60-80%', 3), ('80-100%', 4)) b(bucket, k)
    left join (select least(floor(completeness_score * 100 / 20), 4) as k from validated) v on v.k = b.k group by bucket
""" + " ".join(f"union all select 'field_completeness:{n}', round(avg(s{k}), 4) from validated" for k, n in enumerate(_SPECS))
_register("report_dictionary", lambda s, d: s.createDataFrame(_report_rows(report.report(cases(s, d))), "metric string, value double"), _BASE + _report_sql)

_FOUND_PAIRS = """copies as (select min(cast(doc_id as varchar)) over (partition by sha) as id_a, cast(doc_id as varchar) as id_b from prints),
duplicates as (select id_a, id_b, 1e0 as similarity, 'exact_hash' as method from copies where id_a <> id_b
  union all select id_a, id_b, similarity, 'simhash' from pairs where similarity >= {threshold})
"""
_found_sql = lambda threshold: f"with {_prints_sql(128)}{_PAIRS.rstrip()}, " + _FOUND_PAIRS.format(threshold=threshold)
_register(
    "find_duplicates_85", lambda s, d: dedup.find_duplicates(tables(s, d, "documents")[0], id_="doc_id"), _found_sql(0.85) + "select * from duplicates", view=False,
)
_register(
    "duplicates_rendered_95", lambda s, d: dedup.rendered(dedup.find_duplicates(tables(s, d, "documents")[0], 0.95, id_="doc_id")).select("line"),
    _found_sql(0.95) + "select printf('%s <-> %s (%.1f%% similar, %s)', id_a, id_b, similarity * 100, method) as line from duplicates", view=False,
)
_register(
    "fingerprints_upserted",
    lambda s, d: dedup.fingerprints(tables(s, d, "documents")[0].withColumn("own", F.pmod("doc_id", F.lit(150))), id_="own", order="doc_id").select("id", "sha"),
    "select cast(doc_id % 150 as varchar) as id, sha256(text) as sha from documents qualify row_number() over (partition by doc_id % 150 order by doc_id desc) = 1", view=False,
)

# --- links without pairs ---------------------------------------------------------------------------------------

_register(
    "duplicate_links_85", lambda s, d: links.link_summary(_prints(s, d), 0.85),
    f"""with recursive {_prints_sql(128)},
texts as (select sha, min(cast(doc_id as varchar)) as representative, count(*) - 1 as copies, any_value(hi) as hi, any_value(lo) as lo from prints group by sha),
linked as (
  select a.representative as a, b.representative as b, 1 - (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::double / 128 as similarity
  from texts a join texts b on a.representative <> b.representative and (a.hi <> 0 or a.lo <> 0) and (b.hi <> 0 or b.lo <> 0)
  where 1 - (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::double / 128 >= 0.85),
reached(id, root) using key (id) as (
  select representative, representative from texts
  union
  select l.b, min(r.root) from reached r join linked l on l.a = r.id join recurring.reached as own on own.id = l.b where r.root < own.root group by l.b),
best as (select a, count(*) as n_links, max(similarity) as similarity from linked group by a),
nearest as (select l.a, min(l.b) as nearest from linked l join best on best.a = l.a and best.similarity = l.similarity group by l.a)
select cast(p.doc_id as varchar) as id, t.representative, t.copies, coalesce(best.n_links, 0) as n_links, nearest.nearest, best.similarity, reached.root as group_id
from prints p join texts t on t.sha is not distinct from p.sha join reached on reached.id = t.representative
left join best on best.a = t.representative left join nearest on nearest.a = t.representative""", view=False,
)

# --- the store's commits ---------------------------------------------------------------------------------------


def _committed(spark: SparkSession, sf_dir: str) -> store.CaseStore:
    """All cases as `first`, those before 1996 with another title as `second`, then `first` again with fewer rows."""
    kept = store.CaseStore(spark, _folder(spark, "store"), "table")
    all_cases = cases(spark, sf_dir).select("id", "title", "court", "year")
    kept.save(all_cases, "first")
    kept.save(all_cases.where("year < 1996").withColumn("title", F.concat("title", F.lit("!"))), "second")
    kept.save(all_cases.where("court is not null and coalesce(year, 0) <> 1995").withColumn("title", F.concat("title", F.lit("?"))), "first")
    return kept


_retried = "(court is not null and coalesce(year, 0) <> 1995)"
_register(
    "store_retried_batch", lambda s, d: _committed(s, d).cases().select("id", "title", "year"),
    f"select id, title || case when {_retried} then '?' else '!' end as title, year from cases where {_retried} or year < 1996",
)
_register(
    "store_overlapping_ledger", lambda s, d: _committed(s, d).ledger().select("id", "batch"),
    f"select id, case when year < 1996 then 'second' else 'first' end as batch from cases where {_retried} or year < 1996",
)
_register(
    "store_as_of", lambda s, d: _committed(s, d).cases(as_of=2).select("id", "title", "year"),
    "select id, case when year < 1996 then title || '!' else title end as title, year from cases",
)


def _compacted(spark: SparkSession, sf_dir: str) -> store.CaseStore:
    """The retried store folded into sorted files, then a batch more."""
    kept = _committed(spark, sf_dir)
    kept.compact()
    later = cases(spark, sf_dir).where("year = 1998").select("id", "title", "court", "year")
    kept.save(later.withColumn("title", F.concat("title", F.lit("."))), "third")
    return kept


_folded = f"""select id, title || case when year = 1998 then '.' when {_retried} then '?' else '!' end as title, year
from cases where {_retried} or year < 1996 or year = 1998"""
_register("store_compacted", lambda s, d: _compacted(s, d).cases().select("id", "title", "year"), _folded)
_register(
    "store_lookup_100", lambda s, d: _compacted(s, d).load_all([f"D{k:07d}" for k in range(0, 700, 7)]).select("id", "title", "year"),
    f"select * from ({_folded}) where id in (select 'D' || lpad(cast(k as varchar), 7, '0') from range(0, 700, 7) t(k))",
)

# --- statistics of documents as they are -----------------------------------------------------------------------


def _mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of documents whose fields differ in kind from line to line, written and read back as variants."""
    d, c, s = tables(spark, sf_dir, "documents", "customer", "supplier")
    k = F.col("doc_id")
    rows = d.join(c, F.col("c_custkey") == k, "left").join(s, F.col("s_suppkey") == k % 10 + 1, "left")
    year, own, names = (1990 + k % 9).cast("int"), F.col("s_name"), ("id", "court", "year", "judges", "text")
    kinds = (
        (k, F.col("c_mktsegment"), year, F.array(own, F.lit("Justice A")), F.col("text")),
        (k, F.col("c_mktsegment"), year.cast("string"), own, F.col("text")),
        (k, F.lit(None).cast("string"), year + 0.5, F.lit(7), F.lit(None).cast("string")),
        (k, k % 3, year.cast("decimal(6,1)"), F.lit(None).cast("string"), F.lit("")),
        (k, F.array(own), F.lit(True), F.array(k % 4, k % 2), F.array(F.lit("one"), F.lit("two"))),
        (k, None, None, F.array(own, F.lit(None).cast("string")), F.col("text")),
    )
    line = F.when(F.lit(False), "")
    for number, values in enumerate(kinds):
        fields = F.struct(*[v.alias(n) for n, v in zip(names, values, strict=True) if v is not None])
        line = line.when(k % len(kinds) == number, F.to_json(fields, {"ignoreNullFields": "false"}))
    path = _folder(spark, "lines")
    rows.select(line.alias("value")).write.text(path)
    return files.read_dynamic_lines(spark, path)


_MIXED_SQL = """with m as (
  select d.doc_id as k, d.doc_id % 6 as j, d.text, c.c_mktsegment as segment, s.s_name as own, 1990 + d.doc_id % 9 as y
  from documents d left join customer c on c.c_custkey = d.doc_id left join supplier s on s.s_suppkey = d.doc_id % 10 + 1),
courts as (
  select case when j = 5 then 'Unknown' when j < 2 then segment when j = 3 then cast(k % 3 as varchar) when j = 4 then '[' || coalesce('"' || own || '"', 'null') || ']' end as court,
    case when j = 5 then 'text' when j = 2 or (j < 2 and segment is null) then 'null' when j < 2 then 'text' when j = 3 then 'number' else 'list' end as kind from m),
years as (
  select case when j = 5 then 'Unknown' when j in (0, 1, 3) then cast(y as varchar) when j = 2 then y || '.5' else 'true' end as year,
    case when j in (1, 5) then 'text' when j = 4 then 'truth' else 'number' end as kind, case when j in (0, 3) then y when j = 2 then y + 0.5 end as moment, j, text from m),
judges as (
  select judge, case when judge is null then 'null' else 'text' end as kind
  from (select unnest([own, 'Justice A']) as judge from m where j = 0 union all select own from m where j = 5)
  union all select unnest([cast(k % 4 as varchar), cast(k % 2 as varchar)]), 'number' from m where j = 4
  union all select null, 'null' from m where j = 5),
sized as (select moment, case when j in (0, 1, 5) then length(text) when j = 4 then 2 end as n from years)
"""
_register("dynamic_courts", lambda s, d: dynamic.court_distribution(_mixed_documents(s, d)), _MIXED_SQL + "select court, kind, count(*) as n from courts group by all order by n desc, kind, court nulls first limit 10", view=False)
_register("dynamic_years", lambda s, d: dynamic.year_distribution(_mixed_documents(s, d)), _MIXED_SQL + "select year, kind, count(*) as n from years group by all", view=False)
_register("dynamic_judges", lambda s, d: dynamic.judge_frequency(_mixed_documents(s, d)), _MIXED_SQL + "select judge, kind, count(*) as n from judges group by all order by n desc, kind, judge nulls first limit 10", view=False)
_lengths = """cast(coalesce(round_even(avg(n) filter (n > 0{w}), 0), 0) as bigint) as avg_length{s}, coalesce(max(n) filter (n > 0{w}), 0) as max_length{s},
  coalesce(min(n) filter (n > 0{w}), 0) as min_length{s}, count(n) filter (n > 0{w}) as cases_with_text{s}"""
_register("dynamic_text_stats", lambda s, d: dynamic.text_stats(_mixed_documents(s, d)), _MIXED_SQL + f"select count(*) as total_cases, {_lengths.format(w='', s='')} from sized", view=False)
_periods = [f"count_if(moment between {a} and {b}) as total_cases_{k}, " + _lengths.format(w=f" and moment between {a} and {b}", s=f"_{k}") for k, a, b in ((1, 1990, 1993), (2, 1994, 1998))]
_register(
    "dynamic_compare_periods", lambda s, d: dynamic.compare_periods(_mixed_documents(s, d), (1990, 1993), (1994, 1998)),
    _MIXED_SQL + f"select *, total_cases_2 - total_cases_1 as case_count_change, avg_length_2 - avg_length_1 as avg_length_change from (select {', '.join(_periods)} from sized)", view=False,
)

# --- many similar documents, batches, resumed ingest, merged reports -------------------------------------------


def _many_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints saved once in a store; the ten nearest of all ids divisible by 20 against all stored rows."""
    index = store.CaseStore(spark, _folder(spark, "index"), "table")
    index.save(_prints(spark, sf_dir), "prints")
    return links.most_similar(index.cases(), "cast(id as long) % 20 = 0", 10).select("query", "id", "rank", "similarity")


_register(
    "find_similar_many_top10", _many_similar,
    f"""with {_prints_sql(128)} select cast(a.doc_id as varchar) as query, cast(b.doc_id as varchar) as id,
      1 - (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::double / 128 as similarity,
      cast(row_number() over (partition by a.doc_id order by similarity desc, cast(b.doc_id as varchar)) as integer) as rank
    from prints a join prints b on a.doc_id % 20 = 0 and b.doc_id <> a.doc_id qualify rank <= 10""", view=False,
)


def _order_ids(orders: DataFrame) -> DataFrame:
    return orders.withColumn("id", F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")))


def _fetched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a collection that lacks every fifth, fetched in two runs: 100 successes of those asked for, then 50 more."""
    orders = _order_ids(tables(spark, sf_dir, "orders")[0])
    there = orders.where("o_orderkey % 5 <> 0").select("id", "o_custkey", "o_totalprice")
    kept = store.CaseStore(spark, _folder(spark, "store"), "table")
    for limit in (100, 50):
        batches.fetch_batch(kept, orders.select("id"), lambda ids: there.join(ids, "id"), limit, budget=1000)
    return kept.cases().select("id", "o_custkey", "o_totalprice")


_register(
    "fetch_limit_of_successes", _fetched_orders,
    "select 'O' || lpad(cast(o_orderkey as varchar), 9, '0') as id, o_custkey, o_totalprice from orders where o_orderkey % 5 <> 0 order by id limit 150", view=False,
)


def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines that arrive in two runs; the second has repeated lines under another title and late ones besides."""
    docs = tables(spark, sf_dir, "documents")[0].select("doc_id", F.substring("text", 1, 40).alias("title"))
    middle = docs.agg(F.floor(F.max("doc_id") / 2)).first()[0]
    path, kept = _folder(spark, "lines"), store.CaseStore(spark, _folder(spark, "store"), "table")

    def lines(rows: DataFrame, id_: str = "D", title=F.col("title"), minute=F.col("doc_id")) -> DataFrame:  # noqa: B008
        at = F.date_format(F.timestamp_seconds(F.lit(1704067200) + minute * 60), "yyyy-MM-dd HH:mm:ss")
        return rows.select(F.concat(F.lit(id_), F.col("doc_id")).alias("id"), title.alias("title"), at.alias("_scraped_at"))

    again = docs.where(F.col("doc_id").between(middle - 20, middle))
    for rows in (
        lines(docs.where(F.col("doc_id") <= middle)),
        lines(docs.where(F.col("doc_id") > middle))
        .unionByName(lines(again, title=F.lit("again")))
        .unionByName(lines(docs.where("doc_id % 7 = 0"), "late", minute=F.lit(0))),
    ):
        rows.write.mode("append").json(path)
        ingest(spark, path, kept, f"{path}-progress", late="30 minutes").awaitTermination()
    return kept.cases().select("id", "title")


_register("ingest_resumed", _resumed, "select 'D' || doc_id as id, substr(text, 1, 40) as title from documents", view=False)


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial reports of three batches, stored; `batch` says which. All batches are of one pass over the documents."""
    path = _folder(spark, "partial")
    batch = F.when(F.col("text").isNull(), 0).when(F.coalesce("year", F.lit(0)) < 1995, 1).otherwise(2)
    validated = validate(cases(spark, sf_dir).withColumn("_batch", batch), keep=("_batch",))
    report.partial(validated, by=("_batch",)).withColumnRenamed("_batch", "batch").write.partitionBy("batch").parquet(path)
    return spark.read.parquet(path)


_register("report_merged_summary", lambda s, d: _round6(report.summary_of(_partials(s, d)), "pass_rate", "avg_completeness"), ORACLES["report_summary"], view=False)
_register("report_merged_issues", lambda s, d: report.top_issues_of(_partials(s, d)), ORACLES["report_top_issues"], view=False)
_register(
    "report_merged_compare", lambda s, d: (lambda p: _round6(report.compare_of(p, p.where("batch > 0")), "before", "after", "delta"))(_partials(s, d)),
    ORACLES["report_compare"], view=False,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as one JSON document each, every third written again with a longer title; ids with characters that paths can't hold."""
    path = _folder(spark, "documents")
    rows = tables(spark, sf_dir, "supplier")[0].select(F.concat_ws("/", F.lit("S"), "s_suppkey").alias("id"), F.col("s_name").alias("title"), F.col("s_suppkey").cast("int").alias("year"))
    files.write_documents(rows, path)
    files.write_documents(rows.where("year % 3 = 0").withColumn("title", F.concat("title", F.lit(" again"))), path)
    return files.read_documents(spark, path).select("id", "title", "year")


_register(
    "documents_by_id", _documents,
    "select 'S/' || s_suppkey as id, s_name || case when s_suppkey % 3 = 0 then ' again' else '' end as title, cast(s_suppkey as int) as year from supplier", view=False,
)


def _lines_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of lines alone: two batches, the second saved again with fewer rows; its ledger beside its lines."""
    kept = store.CaseStore(spark, _folder(spark, "store"), "jsonl")
    all_cases = cases(spark, sf_dir).select("id", "title", "year")
    kept.save(all_cases.where("year >= 1996"), "late")
    kept.save(all_cases.where("year < 1996 or year is null"), "early")
    kept.save(all_cases.where("year < 1994 or year is null"), "early")
    lines = files.read_jsonl(spark, f"{kept.path}/jsonl").select("id", "title", "year_key")
    return lines.join(kept.ledger().select("id", "batch"), "id")


_register(
    "store_lines_only", _lines_only,
    """select id, title, coalesce(cast(year as varchar), 'unknown') as year_key, case when year >= 1996 then 'late' else 'early' end as batch
    from cases where year is null or year >= 1996 or year < 1994""",
)


def _fetched_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders fetched by skipping what is there, then some of them again, after the collection has changed."""
    orders = _order_ids(tables(spark, sf_dir, "orders")[0]).where("o_orderkey <= 200").select("id", "o_orderkey", "o_totalprice")
    kept = store.CaseStore(spark, _folder(spark, "store"), "table")
    raised = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    batches.fetch_batch(kept, orders.where("o_orderkey <= 150").select("id"), lambda ids: orders.join(ids, "id"))
    batches.fetch_batch(kept, orders.select("id"), lambda ids: raised.join(ids, "id"))  # only what is missing
    batches.fetch_batch(kept, orders.where("o_orderkey % 3 = 0").select("id"), lambda ids: raised.join(ids, "id"), skip_existing=False)
    return kept.cases().select("id", "o_totalprice")


_register(
    "fetch_again", _fetched_again,
    """select 'O' || lpad(cast(o_orderkey as varchar), 9, '0') as id, o_totalprice + case when o_orderkey > 150 or o_orderkey % 3 = 0 then 1 else 0 end as o_totalprice
    from orders where o_orderkey <= 200""", view=False,
)


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store's status after two fetching runs, as a row."""
    orders = _order_ids(tables(spark, sf_dir, "orders")[0]).select("id", F.year("o_orderdate").alias("year"))
    kept = store.CaseStore(spark, _folder(spark, "store"), "table")
    there = orders.where("substr(id, -1) <> '4'")
    for limit, budget in ((30, 500), (0, 40)):
        batches.fetch_batch(kept, orders.select("id"), lambda ids: there.join(ids, "id"), limit, budget)
    found = {**kept.stats(), "requests": kept.requests()}
    return spark.createDataFrame([tuple(found[k] for k in ("total_cases", "years", "tracked", "requests"))], "total_cases long, years long, tracked long, requests long")


_register(
    "store_status", _status,
    """with asked as (select o_orderkey, o_orderdate, o_orderkey % 10 <> 4 as there, row_number() over (order by o_orderkey) as k from orders),
    first as (select *, sum(there::int) over (order by k) as got from asked),
    one as (select * from first where got < 30 or (got = 30 and there)),
    rest as (select *, row_number() over (order by k) as n from asked where o_orderkey not in (select o_orderkey from one where there)),
    held as (select o_orderdate from one where there union all select o_orderdate from rest where n <= 40 and there)
    select count(*) as total_cases, count(distinct year(o_orderdate)) as years, count(*) as tracked, (select count(*) from one) + 40 as requests from held""", view=False,
)
_register(
    "report_of_folder",
    lambda s, d: s.createDataFrame([r for r in _report_rows(report.report_folder(s, _documents_of_nations(s, d, bad=True))) if ":" not in r[0]], "metric string, value double"),
    """with n as (select length(n_name) as l from nation), t as (select count(*) as c,
      avg((0.9e0 + 0.7e0 + case when l >= 5 then 0.9e0 else least(l / 5e0, 0.8e0) end) / 7.3e0) as s from n)
    select 'total_cases' as metric, c::double as value from t union all select 'valid_cases', 0e0 union all select 'invalid_cases', c::double from t
    union all select 'pass_rate', 0e0 union all select 'avg_completeness', round(s, 4) from t""", view=False,
)


def _pushed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders served by a connector, two years of them by a condition that the source takes over."""
    listed = connectors.enumerate_years(spark, "orders", 1990, 2004, path=f"{sf_dir}/orders.parquet")
    return listed.where("year between 1996 and 1997 and id not like '%7'").select("id", "title", "year")


_register(
    "source_pushed_years", _pushed_years,
    """select cast(o_orderkey as varchar) as id, o_orderpriority as title, cast(year(o_orderdate) as integer) as year from orders
    where year(o_orderdate) between 1996 and 1997 and cast(o_orderkey as varchar) not like '%7'""", view=False,
)
