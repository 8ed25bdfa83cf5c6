"""Source / sink round trips and streaming queries (IO1-IO11, K3, FS4).

Every file these queries write goes to a fresh folder under the shared
``spark.checkpoint.dir``; the returned DataFrame reads it back.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelab.functions.columns import round4
from featurelab.plans.registry import query
from featurelab.session import scratch_path, spread
from featurelab.sources import files as IO
from featurelab.sources.doc_files import file_heads, write_documents
from featurelab.sources.tables import Tables

NATION_TYPES = {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"}


@query("csv_union_roundtrip", "IO1 IO2 J7 P1 P2", sql="""
SELECT n_nationkey AS nation_id, n_name AS name,
       CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_regionkey END AS region_id
FROM nation
""")
def csv_union_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    n = Tables(spark, d).nation
    folder = scratch_path(spark, "csv-union")
    # two file sets with different headers: the second lacks n_regionkey and
    # orders its columns differently, as a later export would
    (n.where(F.pmod("n_nationkey", F.lit(3)) != 0)
     .write.option("sep", ";").option("header", True).csv(folder + "/a"))
    (n.where(F.pmod("n_nationkey", F.lit(3)) == 0).select("n_name", "n_nationkey")
     .write.option("sep", ";").option("header", True).csv(folder + "/b"))
    u = IO.read_csv_folder_by_name(spark, folder, NATION_TYPES, sep=";")
    u = IO.rename_columns(u, {"n_nationkey": "nation_id", "n_name": "name", "n_regionkey": "region_id"})
    return u.select("nation_id", "name", "region_id")


SUPPLIER_SCHEMA = T.StructType([
    T.StructField("s_suppkey", T.LongType(), False),
    T.StructField("s_name", T.StringType(), False),
    T.StructField("s_nationkey", T.IntegerType(), True),
    T.StructField("s_acctbal", T.DoubleType(), True)])


@query("table_load_roundtrip", "IO3 IO4 IO6 IO7 IO8", sql="""
SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 4) AS s_acctbal, CAST(n AS BIGINT) AS loaded_rows
FROM supplier, (SELECT count(*) AS n FROM supplier)
""")
def table_load_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    s = Tables(spark, d).supplier
    base = scratch_path(spark, "table-load")
    typed = IO.enforce_not_null(s.select(*[F.col(f.name).cast(f.dataType) for f in SUPPLIER_SCHEMA.fields]),
                                SUPPLIER_SCHEMA)
    # the table is declared first, if it is not there, and then loaded
    name = "supplier_" + os.path.basename(base).replace("-", "_")
    IO.create_table_if_missing(spark, name, SUPPLIER_SCHEMA, base + "/table")
    IO.create_table_if_missing(spark, name, SUPPLIER_SCHEMA, base + "/table")
    n1 = IO.load_table(typed, base + "/table")
    n2 = IO.load_table(typed, base + "/table")  # truncate-and-load is idempotent
    spark.catalog.refreshTable(name)
    n3 = spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    if not n1 == n2 == n3:
        raise RuntimeError("reload changed the row count")
    # JSONL export of the loaded table, then read back only the part files
    IO.write_jsonl(spark.read.parquet(base + "/table"), base + "/export")
    back = IO.read_jsonl(spark, base + "/export",
                         "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", "part-*.json")
    return IO.valid_rows(back, "s_suppkey").select(
        "s_suppkey", "s_name", "s_nationkey", round4("s_acctbal").alias("s_acctbal"),
        F.lit(n1).cast("bigint").alias("loaded_rows"))


@query("binary_and_text_scan", "IO9 IO10", sql="""
SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes,
       CAST(sum(length(text) + 1) AS BIGINT) AS n_chars
FROM documents GROUP BY source
""")
def binary_and_text_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = Tables(spark, d).documents
    folder = scratch_path(spark, "doc-files")
    docs.select("source", "text").write.partitionBy("source").text(folder)
    src = F.regexp_extract("path", r"source=([^/]+)", 1)
    b = IO.read_binary(spark, folder, "*.txt").select(src.alias("source"), "length",
                                                     F.length("content_b64").alias("b64"))
    w = IO.read_whole_text(spark, folder).select(src.alias("source"), F.length("value").alias("chars"))
    bytes_ = b.groupBy("source").agg(F.sum("length").cast("bigint").alias("n_bytes"))
    chars = w.groupBy("source").agg(F.sum("chars").cast("bigint").alias("n_chars"))
    return bytes_.join(chars, "source", "inner")


@query("document_files", "IO9 IO10", sql="""
SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, md5(coalesce(text, '')) AS content_md5,
       CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, (SELECT count(*) FROM documents) AS n_files
FROM documents
""")
def document_files(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a file of its own, found again by a binary and a
    whole-text scan.  Spark's scans skip files without a byte, so the documents
    themselves say which those are."""
    docs = spread(Tables(spark, d).documents.select("doc_id", "text"))
    folder = scratch_path(spark, "documents")
    place = F.format_string("%02x/%d.txt", F.pmod(F.xxhash64("doc_id"), F.lit(256)), F.col("doc_id"))
    write_documents(docs.withColumn("place", place), folder, "place", "text")
    doc_id = F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("bigint")
    b = IO.read_binary(spark, folder, "*.txt").select(doc_id.alias("doc_id"), F.col("length").alias("n_bytes"),
                                                     F.md5("content").alias("content_md5"))
    w = IO.read_whole_text(spark, folder, "*.txt").select(doc_id.alias("doc_id"), F.length("value").cast("bigint").alias("n_chars"))
    empty = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) == 0).select(
        "doc_id", F.lit(0).cast("bigint").alias("n_bytes"), F.md5(F.lit("")).alias("content_md5"), F.lit(0).cast("bigint").alias("n_chars"))
    n = file_heads(spark, folder, ".txt").count()
    return b.join(w, "doc_id").unionByName(empty).withColumn("n_files", F.lit(n).cast("bigint"))


EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


@query("stream_file_scoring", "K3 IO11", sql="""
SELECT event_id, round(0.5 * value + CASE WHEN event_type = 'purchase' THEN 10 ELSE 0 END, 4) AS score
FROM events
""")
def stream_file_scoring(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.streaming.file_scoring import score_new_files
    ev = Tables(spark, d).events
    base = scratch_path(spark, "stream-score")
    # the landing folder receives one file per day of events
    ev.withColumn("day", F.to_date("ts")).repartition("day").drop("day").write.parquet(base + "/landing")

    def score(batch: DataFrame) -> DataFrame:
        return batch.select("event_id", (0.5 * F.col("value") + F.when(F.col("event_type") == "purchase", 10)
                                         .otherwise(0)).alias("score"))

    score_new_files(spark, base + "/landing", EVENT_SCHEMA, base + "/out", base + "/checkpoint", score,
                    archive_dir=base + "/archive")
    # a second run finds nothing new: every file is scored once
    score_new_files(spark, base + "/landing", EVENT_SCHEMA, base + "/out", base + "/checkpoint", score)
    return spark.read.parquet(base + "/out").select("event_id", round4("score").alias("score"))


@query("stream_feature_sync", "FS4", sql="""
WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS entity_id, o_orderdate AS feature_timestamp,
                  o_totalprice AS total_price, CAST(o_orderkey AS DOUBLE) AS source_id FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY feature_timestamp DESC, source_id DESC) AS rn FROM f)
SELECT entity_id, feature_timestamp, round(total_price, 4) AS total_price FROM r WHERE rn = 1
""")
def stream_feature_sync(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.streaming.feature_sync import read_serving, sync_features
    o = Tables(spark, d).orders
    base = scratch_path(spark, "stream-sync")
    f = o.select(F.col("o_custkey").cast("string").alias("entity_id"),
                 F.col("o_orderdate").alias("feature_timestamp"),
                 F.col("o_totalprice").alias("total_price"),
                 F.col("o_orderkey").cast("double").alias("source_id"))
    # files arrive in hash order, not time order: older rows come late
    f.repartition(12, F.pmod(F.xxhash64("source_id"), F.lit(12))).write.parquet(base + "/landing")
    schema = "entity_id string, feature_timestamp timestamp, total_price double, source_id double"
    sync_features(spark, base + "/landing", schema, base + "/serving", base + "/checkpoint",
                  ["total_price"], tie=["source_id"], max_files_per_trigger=1, compact_every=5)
    s = read_serving(spark, base + "/serving", ["total_price"], tie=["source_id"])
    return s.select("entity_id", "feature_timestamp", round4("total_price").alias("total_price"))


@query("csv_batch_scoring", "K1 IO1 IO7 IO8", sql="""
SELECT o_orderkey, round(0.001 * o_totalprice + 0.5 * CAST(substr(o_orderpriority, 1, 1) AS DOUBLE), 4) AS prediction
FROM orders
""")
def csv_batch_scoring(spark: SparkSession, d: str) -> DataFrame:
    """Batch prediction from CSV files written the way the reference's batch
    inputs are (a space after every comma) to JSON Lines, then read back.

    Without trimming, a typed schema would turn every number into NULL; the
    reader trims, the scorer stays a column expression, and the read-back
    takes only the part files."""
    from featurelab.operators.score import linear_scorer
    from featurelab.plans.models import V1
    o = Tables(spark, d).orders
    base = scratch_path(spark, "csv-batch")
    inst = o.select("o_orderkey", "o_totalprice",
                    F.substring("o_orderpriority", 1, 1).cast("double").alias("priority_code"))
    inst.write.option("sep", ", ").option("header", True).csv(base + "/instances")
    back = IO.read_csv(spark, base + "/instances", "o_orderkey bigint, o_totalprice double, priority_code double",
                       sep=",", trim_spaces=True)
    x = {c: F.col(c) for c in ("o_totalprice", "priority_code")}
    scored = back.select("o_orderkey", linear_scorer(V1)(x).alias("prediction"))
    IO.write_jsonl(scored, base + "/predictions")
    out = IO.read_jsonl(spark, base + "/predictions", "o_orderkey bigint, prediction double", "part-*.json")
    return IO.valid_rows(out, "o_orderkey").select("o_orderkey", round4("prediction").alias("prediction"))


@query("prediction_preview", "K2 A15 A14", sql="""
SELECT o_orderkey, round(0.001 * o_totalprice + 0.5 * CAST(substr(o_orderpriority, 1, 1) AS DOUBLE), 4) AS prediction
FROM orders ORDER BY o_orderkey LIMIT 5
""")
def prediction_preview(spark: SparkSession, d: str) -> DataFrame:
    """Read predictions back and show the first five by key (K2): a preview
    whose limit is the feature; ``orderBy + limit`` is a distributed top-k."""
    return csv_batch_scoring(spark, d).orderBy("o_orderkey").limit(5)
