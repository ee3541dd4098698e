"""A deterministic view of cases over the generated tables, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.sources.files import dealt_out


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Tables of the test data; texts, which are worked on row by row, are dealt to all cores."""
    read = [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]
    return [dealt_out(df) if name in ("documents", "pages") else df for name, df in zip(names, read, strict=True)]


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title, citation, court, date, year, judges, text; with missing and malformed values of every kind.

    What is joined to documents is reduced to their ids and joined among itself first, so that texts
    are shuffled once; the opening of a text is cut off before, so that without `text` none is shuffled.
    """
    d, o, c, n, li, s = tables(spark, sf_dir, "documents", "orders", "customer", "nation", "lineitem", "supplier")
    ids = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("asked"))
    judges = (
        li.join(ids, F.col("l_orderkey") == F.col("asked"), "left_semi")
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_set("s_name")).alias("judges"))
    )
    orders = (
        o.join(ids, F.col("o_orderkey") == F.col("asked"), "left_semi")
        .join(c, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select("o_orderkey", "o_orderdate", "n_name")
    )
    k, year = F.col("doc_id"), F.year("o_orderdate")
    joined = (
        d.select("doc_id", F.substring("text", 1, 60).alias("opening"), "text")
        .join(orders, F.col("o_orderkey") == k, "left")
        .join(judges, F.col("l_orderkey") == k, "left")
    )
    every = lambda m: k % m == 0
    long_text = F.concat(
        "text", F.lit(" Section "), k % 400, F.lit(" and Article "), k % 37, F.lit("(a); see "), year,
        F.lit(" SC "), k % 50, F.lit(". Order IV Rule "), k % 9, F.lit("."),
    )
    return joined.select(
        F.concat(F.lit("D"), F.lpad(k.cast("string"), 7, "0")).alias("id"),
        F.when(every(11), F.lit(None)).when(every(13), F.lit("Ab")).otherwise(F.col("opening")).alias("title"),
        F.when(every(5), F.lit(None)).when(every(7), F.lit("no-digits")).otherwise(F.concat(year, F.lit(" SC "), "o_orderkey")).alias("citation"),
        F.when(~every(9), F.col("n_name")).alias("court"),
        F.when(every(8), F.lit("15th March")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(~every(10), year).alias("year"),
        "judges",
        F.when(every(17), F.lit(None)).when(every(19), F.lit("Short.")).otherwise(long_text).alias("text"),
    )


#: The same view for DuckDB, as a common table expression.
CASES_SQL = """cases as (
select 'D' || lpad(cast(d.doc_id as varchar), 7, '0') as id,
       case when d.doc_id % 11 = 0 then null when d.doc_id % 13 = 0 then 'Ab' else substr(d.text, 1, 60) end as title,
       case when d.doc_id % 5 = 0 then null when d.doc_id % 7 = 0 then 'no-digits'
            else year(o.o_orderdate) || ' SC ' || o.o_orderkey end as citation,
       case when d.doc_id % 9 = 0 then null else n.n_name end as court,
       case when d.doc_id % 8 = 0 then '15th March' else strftime(o.o_orderdate, '%Y-%m-%d') end as date,
       case when d.doc_id % 10 = 0 then null else cast(year(o.o_orderdate) as int) end as year,
       j.judges as judges,
       case when d.doc_id % 17 = 0 then null when d.doc_id % 19 = 0 then 'Short.'
            else d.text || ' Section ' || (d.doc_id % 400) || ' and Article ' || (d.doc_id % 37) || '(a); see '
                 || year(o.o_orderdate) || ' SC ' || (d.doc_id % 50) || '. Order IV Rule ' || (d.doc_id % 9) || '.' end as text
from documents d
left join orders o on o.o_orderkey = d.doc_id
left join customer c on c.c_custkey = o.o_custkey
left join nation n on n.n_nationkey = c.c_nationkey
left join (select l_orderkey, list_sort(list(distinct s_name)) as judges
           from lineitem join supplier on s_suppkey = l_suppkey group by l_orderkey) j on j.l_orderkey = d.doc_id)"""
