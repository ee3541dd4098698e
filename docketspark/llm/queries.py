"""The registered queries of this subpackage: thin calls of the operators on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.llm import op1_chat, op2_jaccard, op3_quality, op4_suffix, op5_warc, op6_decontamination, op7_mixing, op8_language, op9_toxicity, op10_simhash
from docketspark.llm import op11_negatives, op12_filters, op13_pii
from docketspark.llm.common import scratch, written
from docketspark.sources.files import dealt_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; the rows of small files, which are one row group, are dealt to all cores."""
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return read if name in ("labels", "benchmark") else dealt_out(read)


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_toxicity_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses, and from the block tables each document's neighbours within three bits: how many, and the least id."""
    with scratch(spark):
        rows = written(op10_simhash.with_edits(_table(spark, sf_dir, "documents")), "edited")
        return written(op10_simhash.with_neighbours(rows), "neighbours", keep=True)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_language.identify(_table(spark, sf_dir, "documents"))


def op6_decontamination_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def benchmark_longest_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest verbatim matches of at least ten words between documents and items, with their places in both."""
    return op6_decontamination.longest_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_jaccard.jaccard_join(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_suffix.removals(_table(spark, sf_dir, "documents"))


def op1_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_chat.recover(_table(spark, sf_dir, "conversations"))


#: In the audited replica the body's first byte is overwritten where this holds of the id.
DAMAGED = "pmod(page_id, 50) = 7"


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    damaged = pages.withColumn("html", F.when(F.expr(DAMAGED), F.expr("concat('#', substring(html, 2))")).otherwise(F.col("html")))
    return op5_warc.audited(op5_warc.archived(pages), op5_warc.archived(damaged))


OP5_SQL = """
with framed as (
  select page_id, page_id // 1000 as file,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
         || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: '
         || cast(strlen(html) as varchar) || chr(13) || chr(10) || chr(13) || chr(10) || html
         || chr(13) || chr(10) || chr(13) || chr(10) as bytes,
         page_id % 50 = 7 as damaged
  from pages),
laid as (
  select page_id, file, cast(strlen(bytes) as bigint) as length, damaged, sha256(bytes) as own from framed),
placed as (
  select page_id, file, row_number() over (partition by file order by page_id, own) - 1 as record,
         cast(coalesce(sum(length) over (partition by file order by page_id, own rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset",
         length, own, damaged
  from laid)
select page_id, file, record, "offset", length,
       sha256(cast("offset" as varchar) || ':' || cast(length as varchar) || ':' || own) as digest,
       case when damaged then 'corrupt' else 'intact' end as status
from placed
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.expr("vec_id % 7 = 0"), (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return op11_negatives.mine(rows.withColumn("label", moved))


OP11_SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
         [floor(256 * cast(x as double)) for x in embedding] as vector, row_number() over () as own
  from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select a.own as anchor, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
         cast(list_inner_product(a.vector, b.vector) as bigint) as score
  from rows a join rows b on a.own <> b.own
  where a.vec_id % 100 = 0),
positive as (
  select anchor, anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor order by score desc, vec_id) as k
  from scored where same qualify k <= 5),
negative as (
  select p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by p.anchor, p.k order by s.score desc, s.vec_id) as rank
  from positive p join scored s on s.anchor = p.anchor and not s.same
   and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from negative where rank <= 5
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return op12_filters.audit(docs, labels).drop("filter")


OP12_SQL = r"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
counted as (
  select doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as capitals
  from texts),
failed as (
  select doc_id, part, len(words) < 200 as a, 100 * len(list_distinct(words)) < 50 * len(words) as b,
         100 * capitals > 3 * length(text) as c, regexp_matches(text, '[#$%&*|]') as d,
         coalesce(doc_id > min(doc_id) over (partition by text), false) as e
  from counted),
marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
masks as (
  select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask,
         coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from failed left join marks using (doc_id)),
cells as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit),
permutations as (
  select [a.f, b.f, c.f, d.f, e.f] as fs, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (
  select array_to_string(fs, '') as filter_order, cast(step as integer) as step, fs[step] as f, bits[step] as own,
         cast(coalesce(list_sum(bits[1:step - 1]), 0) as integer) as earlier
  from permutations, (select unnest([1, 2, 3, 4, 5]) as step)),
counts as (
  select part, filter_order, step, f,
         sum(case when mask & (own | earlier) = 0 then n else 0 end) as kept,
         sum(case when mask & own > 0 and mask & earlier = 0 then n else 0 end) as removed,
         sum(case when mask & own > 0 and mask & earlier > 0 then n else 0 end) as redundant,
         sum(case when mask = own then n else 0 end) as unique_fails,
         sum(case when mask & own > 0 and mask & earlier = 0 then good else 0 end) as good_lost,
         sum(case when mask & own > 0 and mask & earlier = 0 then toxic else 0 end) as toxic_lost
  from cells, steps group by all)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, f) as bigint) as shapley
from counts
"""


def op13_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_pii.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def warc_replica_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that has lost some pages, holds others twice under new ids, and has damaged bodies of another length."""
    pages = _table(spark, sf_dir, "pages")
    damaged = F.when(F.expr("pmod(page_id, 50) = 7"), F.expr("concat('#', html)")).otherwise(F.col("html"))
    added = pages.where("pmod(page_id, 89) = 3").withColumn("page_id", F.expr("page_id - pmod(page_id, 1000) + pmod(page_id * 7 + 1, 1000) + 1000000000"))
    replica = pages.where("pmod(page_id, 97) <> 5").withColumn("html", damaged).unionByName(added)
    return op5_warc.reconciled(op5_warc.archived(pages, own=True), op5_warc.archived(replica, own=True))


RECONCILED_SQL = """
with pages2 as (
  select page_id, url, case when page_id % 50 = 7 then '#' || html else html end as html from pages where page_id % 97 <> 5
  union all select page_id - page_id % 1000 + (page_id * 7 + 1) % 1000 + 1000000000, url, html from pages where page_id % 89 = 3),
rows as (select 1 as side, * from (select page_id, url, html from pages) union all select 2, * from pages2),
framed as (
  select side, page_id, page_id // 1000 as file,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
         || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: '
         || cast(strlen(html) as varchar) || chr(13) || chr(10) || chr(13) || chr(10) || html
         || chr(13) || chr(10) || chr(13) || chr(10) as bytes
  from rows),
laid as (select side, page_id, file, cast(strlen(bytes) as bigint) as length, sha256(bytes) as own from framed),
placed as (
  select side, page_id, file, own, row_number() over (partition by side, file order by page_id, own) - 1 as record,
         cast(coalesce(sum(length) over (partition by side, file order by page_id, own rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset"
  from laid),
a as (select * from placed where side = 1), b as (select * from placed where side = 2)
select coalesce(a.page_id, b.page_id) as page_id, coalesce(a.file, b.file) as file, a.record, a."offset", a.own, b.own as replica_own, b."offset" as replica_offset,
       case when a.own is null then 'extra' when b.own is null then 'missing' when a.own <> b.own then 'corrupt'
            when a."offset" = b."offset" then 'intact' else 'moved' end as status
from a full join b on a.page_id = b.page_id
"""


QUERIES = {
    "op1_chat_roles": op1_chat_roles,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_warc_fixity": op5_warc_fixity,
    "op6_decontamination_hits": op6_decontamination_hits,
    "op7_mixing_sources": op7_mixing_sources,
    "op8_language_id": op8_language_id,
    "op9_toxicity_classifier": op9_toxicity_classifier,
    "op10_fingerprints": op10_fingerprints,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_pii_spans": op13_pii_spans,
    "warc_replica_reconciled": warc_replica_reconciled,
    "benchmark_longest_matches": benchmark_longest_matches,
}
ORACLES: dict[str, str] = {"op5_warc_fixity": OP5_SQL, "op11_hard_negatives": OP11_SQL, "op12_filter_audit": OP12_SQL, "warc_replica_reconciled": RECONCILED_SQL}
