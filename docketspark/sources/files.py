"""Reading cases from JSON, JSON Lines and Parquet, typed or with dynamic values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketspark.plans.schema import CASE_SCHEMA, Schema
from docketspark.plans.stored import partitions

#: The typed columns of a case.
CASE_TYPE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("citation", T.StringType()),
        T.StructField("court", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("judges", T.ArrayType(T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("headnotes", T.StringType()),
        T.StructField("statutes_cited", T.ArrayType(T.StringType())),
        T.StructField("_scraped_at", T.StringType()),
    ]
)


def read_json(spark: SparkSession, path: str, schema: T.StructType = CASE_TYPE, tolerant: bool = False) -> DataFrame:
    """One JSON document a file; a malformed file raises, or is left out if tolerant."""
    reader = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json")
    if not tolerant:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = reader.schema(marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def write_documents(cases: DataFrame, path: str) -> None:
    """One JSON document an id under `path`, in a folder named by the id; ids that are there already are replaced, others left alone.

    Files are written aside and put in place when the job commits, so a job that fails leaves
    every document as it was. Rows without an id are left out; of a repeated id the last by
    `_scraped_at`, if there is one, then by hash. A folder a document is for exports of a size that
    a file system can list; the store is for all else.

    The cost is that of files, not of bytes, so documents are dealt to a given number of tasks: by
    their bytes AQE would leave them all to one or two. They are dealt by a hash of the id, as the
    optimizer drops a second dealing by the id itself.
    """
    named = cases.where(F.coalesce(F.col("id").cast("string"), F.lit("")) != "")
    rest = [c for c in named.columns if c != "id"]
    order = F.struct(*([F.col("_scraped_at")] if "_scraped_at" in rest else []), F.xxhash64(*rest) if rest else F.lit(0))
    one = named.groupBy("id").agg(F.max_by(F.struct("id", *rest), order).alias("r")).select(F.col("id").alias("document"), "r.*")
    n = max(partitions(cases.sparkSession), cases.sparkSession.sparkContext.defaultParallelism)
    writer = one.repartition(n, F.xxhash64("document")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("pretty", True)
    writer.partitionBy("document").json(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType = CASE_TYPE, tolerant: bool = False) -> DataFrame:
    """What write_documents has written."""
    return read_json(spark, path, schema, tolerant).select(*schema.names)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = CASE_TYPE) -> DataFrame:
    """One JSON document a line; `year_key` of a partitioned folder becomes a column."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("year_key", T.StringType())])).json(path)


def read_dynamic(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document a file, every field of the case schema as a variant, the document's text in `_raw`.

    Values keep the kind they had in the file; files that are no JSON object are left out.
    """
    return as_variants(spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path))


def read_dynamic_lines(spark: SparkSession, path: str) -> DataFrame:
    """As read_dynamic, one JSON document a line."""
    return as_variants(spark.read.text(path))


def as_variants(documents: DataFrame, schema: Schema = CASE_SCHEMA) -> DataFrame:
    """The JSON texts of the column `value`, each field of the schema as a variant, the text in `_raw`; what is no JSON object goes."""
    parsed = documents.select(F.col("value").alias("_raw"), F.try_parse_json("value").alias("_doc")).where(F.col("_doc").isNotNull())
    objects = parsed.where(F.schema_of_variant("_doc").startswith("OBJECT"))
    names = dict.fromkeys(s.name for s in schema if s.name != "id")
    fields = [F.try_variant_get("_doc", f"$.{name}", "variant").alias(name) for name in names]
    return objects.select(F.try_variant_get("_doc", "$.id", "string").alias("id"), *fields, "_raw")


#: Bytes up to which a table is dealt out anew.
FEW_BYTES = 32 << 20


def dealt_out(df: DataFrame, most: int = FEW_BYTES) -> DataFrame:
    """The same rows, dealt to all cores if the table is at most `most` bytes in its files.

    A small Parquet file is one row group, so one task, however many cores wait; larger tables have
    row groups enough and are left as they are. Rows and results are the same either way.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= most else df
