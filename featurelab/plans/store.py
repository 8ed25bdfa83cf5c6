"""Feature-store queries (FS1-FS8, J3, J4, P3, P4, P14, P15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.functions.columns import map_lookup, round4
from featurelab.operators import store as FS
from featurelab.operators.joins import asof_join
from featurelab.plans.registry import query
from featurelab.session import scratch_path
from featurelab.sources.tables import Tables

BATCH_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
# Fixed code books of the order features
PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}
STATUS_CODES = {"F": 0, "O": 1, "P": 2}
FEATURES = ["total_price", "priority_code", "status_code"]


def order_features(spark: SparkSession, d: str) -> DataFrame:
    """Orders as customer feature rows: key = customer, time = order date."""
    o = Tables(spark, d).orders
    feats = {"total_price": F.col("o_totalprice"),
             "priority_code": F.coalesce(map_lookup("o_orderpriority", PRIORITY_CODES), F.lit(0)),
             "status_code": F.coalesce(map_lookup("o_orderstatus", STATUS_CODES), F.lit(0))}
    # the order key rides along as a deterministic tie-break for equal times
    return FS.ingest_frame(o, "o_custkey", "o_orderdate", {**feats, "source_id": F.col("o_orderkey")},
                           BATCH_TS)


FEATURE_SQL = """
WITH f AS (
  SELECT CAST(o_custkey AS VARCHAR) AS entity_id, o_orderdate AS feature_timestamp,
         o_totalprice AS total_price,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
              WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 ELSE 0 END AS DOUBLE) AS priority_code,
         CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS DOUBLE) AS status_code,
         CAST(o_orderkey AS DOUBLE) AS source_id, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at
  FROM orders)
"""


@query("feature_ingest", "FS1 FS2 FS6 P4", sql=FEATURE_SQL + """
SELECT entity_id, feature_timestamp, round(total_price, 4) AS total_price, priority_code, status_code,
       source_id, ingested_at FROM f
""")
def feature_ingest(spark: SparkSession, d: str) -> DataFrame:
    f = order_features(spark, d)
    return f.select(FS.KEY, FS.TS, round4("total_price").alias("total_price"), "priority_code",
                    "status_code", "source_id", "ingested_at")


SLICES = {"spend": ["total_price"], "handling": ["priority_code", "status_code"]}


@query("entity_slices", "FS3 P3", sql=FEATURE_SQL + """
SELECT 'spend' AS slice, entity_id, feature_timestamp, 'total_price' AS feature, round(total_price, 4) AS value FROM f
UNION ALL SELECT 'handling', entity_id, feature_timestamp, 'priority_code', priority_code FROM f
UNION ALL SELECT 'handling', entity_id, feature_timestamp, 'status_code', status_code FROM f
""")
def entity_slices(spark: SparkSession, d: str) -> DataFrame:
    # the export arrives with upper-case names; the store uses lower case
    up = order_features(spark, d)
    up = up.toDF(*[c.upper() for c in up.columns])
    f = FS.lower_columns(up)
    out = None
    for name, df in FS.entity_slices(f, SLICES).items():
        feats = SLICES[name]
        long = df.select(F.lit(name).alias("slice"), FS.KEY, FS.TS, F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in feats])).alias("x"))
        long = long.select("slice", FS.KEY, FS.TS, "x.feature", round4("x.value").alias("value"))
        out = long if out is None else out.unionByName(long)
    return out


LATEST_SQL = """
, r AS (SELECT *, row_number() OVER (PARTITION BY entity_id
                                     ORDER BY feature_timestamp DESC, ingested_at DESC, source_id DESC) AS rn
        FROM f {where})
"""


@query("feature_latest", "FS4 A11", sql=FEATURE_SQL + LATEST_SQL.format(where="") + """
SELECT entity_id, feature_timestamp, round(total_price, 4) AS total_price, priority_code, status_code
FROM r WHERE rn = 1
""")
def feature_latest(spark: SparkSession, d: str) -> DataFrame:
    s = FS.latest_features(order_features(spark, d), FEATURES, tie=["source_id"])
    return s.select(FS.KEY, FS.TS, round4("total_price").alias("total_price"), "priority_code", "status_code")


@query("feature_multi_read", "FS5 J4 P14", sql=FEATURE_SQL + LATEST_SQL.format(where="") + """
SELECT entity_id, feature_timestamp, round(total_price, 4) AS total_price, priority_code, status_code
FROM r WHERE rn = 1 AND entity_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def feature_multi_read(spark: SparkSession, d: str) -> DataFrame:
    serving = FS.latest_features(order_features(spark, d), FEATURES, tie=["source_id"])
    keys = Tables(spark, d).customer.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").cast("string").alias(FS.KEY))
    out = FS.multi_read(serving, keys)
    return out.select(FS.KEY, FS.TS, round4("total_price").alias("total_price"), "priority_code", "status_code")


PIT_CUTOFF = "1998-01-01 00:00:00"


@query("feature_pit", "FS7 P15", sql=FEATURE_SQL + LATEST_SQL.format(
    where="WHERE feature_timestamp <= TIMESTAMP '1998-01-01 00:00:00'") + """
SELECT entity_id, feature_timestamp, round(total_price, 4) AS total_price, priority_code, status_code
FROM r WHERE rn = 1
""")
def feature_pit(spark: SparkSession, d: str) -> DataFrame:
    p = FS.point_in_time(order_features(spark, d), PIT_CUTOFF, FEATURES, tie=["source_id"])
    return p.select(FS.KEY, FS.TS, round4("total_price").alias("total_price"), "priority_code", "status_code")


@query("asof_join", "FS8 J3", sql="""
WITH r AS (
  SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate
                                 ORDER BY o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
l AS (SELECT o_custkey AS custkey, l_shipdate, l_orderkey, l_linenumber, l_partkey
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l.custkey, l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey,
       round(r.o_totalprice, 4) AS feature_total, r.o_orderkey AS feature_order
FROM l ASOF LEFT JOIN r ON l.custkey = r.o_custkey AND l.l_shipdate >= r.o_orderdate
""")
def asof_join_q(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    orders = t.orders
    inst = t.lineitem.join(orders.select("o_orderkey", F.col("o_custkey").alias("custkey")),
                           F.col("l_orderkey") == F.col("o_orderkey")).select(
        "custkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    feats = orders.select(F.col("o_custkey").alias("custkey"), "o_orderdate", "o_totalprice", "o_orderkey")
    j = asof_join(inst, feats, "custkey", "l_shipdate", "o_orderdate", ["o_totalprice", "o_orderkey"])
    return j.select("custkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                    round4("o_totalprice").alias("feature_total"), F.col("o_orderkey").alias("feature_order"))


@query("historical_serving", "FS8 FS2 FS1 J3", sql=FEATURE_SQL + """,
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, feature_timestamp
        ORDER BY total_price DESC, priority_code DESC, status_code DESC) AS rn FROM f) WHERE rn = 1),
l AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS entity_id,
             CAST(o_orderdate - INTERVAL 30 DAY AS TIMESTAMP) AS read_at FROM orders)
SELECT l.o_orderkey, l.entity_id, round(r.total_price, 4) AS total_price, r.priority_code, r.status_code
FROM l ASOF LEFT JOIN r ON l.entity_id = r.entity_id AND l.read_at >= r.feature_timestamp
""")
def historical_serving_q(spark: SparkSession, d: str) -> DataFrame:
    """What each customer's features were 30 days before each order, read
    from an offline table appended in two batches."""
    path = scratch_path(spark, "offline")
    feats = order_features(spark, d)
    early = F.col(FS.TS) < F.lit("1996-01-01").cast("timestamp")
    FS.write_offline(feats.where(early), path)
    FS.write_offline(feats.where(~early), path)
    reads = Tables(spark, d).orders.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer"),
        F.date_sub("o_orderdate", 30).cast("timestamp").alias("read_at"))
    out = FS.historical_serving(reads, spark.read.parquet(path), FEATURES, "customer", "read_at")
    return out.select("o_orderkey", FS.KEY, round4("total_price").alias("total_price"), "priority_code", "status_code")


@query("feature_pit_history", "FS7 P15 P14", sql=FEATURE_SQL + """
SELECT entity_id, feature_timestamp, round(total_price, 4) AS total_price, status_code
FROM f WHERE feature_timestamp <= TIMESTAMP '1998-01-01 00:00:00'
  AND entity_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY')
""")
def feature_pit_history(spark: SparkSession, d: str) -> DataFrame:
    """The filter-only point-in-time read: every row at or before the
    cut-off for the requested entities (several rows per entity), as the
    warehouse query returns them."""
    keys = Tables(spark, d).customer.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.col("c_custkey").cast("string").alias(FS.KEY))
    rows = FS.point_in_time(order_features(spark, d), PIT_CUTOFF, FEATURES, newest_only=False)
    from featurelab.operators.joins import semi_by_keys
    out = semi_by_keys(rows, keys, FS.KEY)
    return out.select(FS.KEY, FS.TS, round4("total_price").alias("total_price"), "status_code")
