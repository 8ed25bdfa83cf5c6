"""Core queries: sources, validation, scalar expressions, joins, aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.functions.columns import (
    bround_py, count_if, map_lookup, null_if_key_mod, pandas_concat, round4,
    stable_unit, yes_no_flag)
from featurelab.operators import aggregate as A
from featurelab.operators import joins as J
from featurelab.operators import rank as H
from featurelab.operators import validate as S
from featurelab.operators.text import short_text
from featurelab.plans.registry import query
from featurelab.session import scratch_path, spread
from featurelab.sources.tables import Tables


# --------------------------------------------------------------------------
# Flagship: the spend / revenue training set (IO1 -> P13 -> A1 -> A2 -> J1 -> A3)
# --------------------------------------------------------------------------

RETURN_FLAGS = ["A", "N", "R"]


def monthly_spend_revenue_df(orders: DataFrame, lineitem: DataFrame,
                             drop_keys: bool = False) -> DataFrame:
    revenue = A.group_sum(
        orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                      "o_totalprice"),
        ["year", "month"], "o_totalprice", "revenue")
    spend = A.pivot_sum(
        lineitem.select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
                        "l_returnflag",
                        (F.col("l_extendedprice") * F.col("l_discount")).alias("spend")),
        ["year", "month"], "l_returnflag", RETURN_FLAGS, "spend",
        rename={f: f"spend_{f.lower()}" for f in RETURN_FLAGS})
    joined = A.drop_any_null(revenue.join(spend, ["year", "month"], "inner"))
    out = joined.select("year", "month", round4("revenue").alias("revenue"),
                        *[round4(f"spend_{f.lower()}").alias(f"spend_{f.lower()}")
                          for f in RETURN_FLAGS])
    return out.drop("year", "month") if drop_keys else out


@query("monthly_spend_revenue", "A1 A2 J1 A3 P13", sql="""
WITH rev AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         sum(o_totalprice) AS revenue
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
sp AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice * l_discount END) AS spend_a,
         sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice * l_discount END) AS spend_n,
         sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount END) AS spend_r
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2)
SELECT r.year, r.month, round(revenue, 4) AS revenue, round(spend_a, 4) AS spend_a,
       round(spend_n, 4) AS spend_n, round(spend_r, 4) AS spend_r
FROM rev r JOIN sp s ON r.year = s.year AND r.month = s.month
WHERE revenue IS NOT NULL AND spend_a IS NOT NULL AND spend_n IS NOT NULL AND spend_r IS NOT NULL
""")
def monthly_spend_revenue(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return monthly_spend_revenue_df(t.orders, t.lineitem)


# --------------------------------------------------------------------------
# Required fields of a JSON request built from each event
# --------------------------------------------------------------------------

REQUIRED_FIELDS = ["event_type", "value", "user_id", "k"]


def event_payloads(events: DataFrame) -> DataFrame:
    """One JSON request per event.  Fields are left out by fixed rules so the
    check sees absent keys, blank text and an unparseable number."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    etype = (F.when(F.pmod("event_id", F.lit(13)) == 0, F.lit("   "))
             .otherwise(F.col("event_type")))
    value_txt = (F.when(F.pmod("event_id", F.lit(17)) == 0, F.lit("n/a"))
                 .otherwise(F.col("value").cast("string")))
    body = F.struct(
        null_if_key_mod(etype, "event_id", 7).alias("event_type"),
        null_if_key_mod(value_txt, "event_id", 11).alias("value"),
        null_if_key_mod(F.col("user_id"), "event_id", 19).alias("user_id"),
        null_if_key_mod(k, "event_id", 23).alias("k"))
    # to_json drops NULL fields: those keys are absent from the text
    return events.select("event_id", F.to_json(body).alias("payload"))


def required_fields_report_df(payloads: DataFrame) -> DataFrame:
    schema = "event_type string, value string, user_id bigint, k bigint"
    parsed = payloads.select("event_id", "payload", F.from_json("payload", schema).alias("p"))
    missing = S.missing_fields(F.col("payload"), REQUIRED_FIELDS)
    return parsed.select(
        "event_id",
        F.array_join(missing, ",").alias("missing"),
        F.size(missing).cast("int").alias("n_missing"),
        (F.col("p.event_type").isNotNull() & S.blank_text(F.col("p.event_type"))).alias("blank_type"),
        (F.col("p.value").isNotNull() & F.col("p.value").try_cast("double").isNull()).alias("bad_value"),
    ).withColumn("ok", (F.col("n_missing") == 0) & ~F.col("blank_type") & ~F.col("bad_value"))


@query("required_fields_report", "S4 S5", sql="""
WITH p AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '   ' ELSE event_type END AS et,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS v,
         CASE WHEN event_id % 19 = 0 THEN NULL ELSE user_id END AS u,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k
  FROM events)
SELECT event_id,
       concat_ws(',', CASE WHEN et IS NULL THEN 'event_type' END, CASE WHEN v IS NULL THEN 'value' END,
                 CASE WHEN u IS NULL THEN 'user_id' END, CASE WHEN k IS NULL THEN 'k' END) AS missing,
       CAST((et IS NULL)::INT + (v IS NULL)::INT + (u IS NULL)::INT + (k IS NULL)::INT AS INTEGER) AS n_missing,
       coalesce(et IS NOT NULL AND trim(et) = '', false) AS blank_type,
       coalesce(v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL, false) AS bad_value,
       (et IS NULL)::INT + (v IS NULL)::INT + (u IS NULL)::INT + (k IS NULL)::INT = 0
         AND NOT coalesce(et IS NOT NULL AND trim(et) = '', false)
         AND NOT coalesce(v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL, false) AS ok
FROM p
""")
def required_fields_report(spark: SparkSession, d: str) -> DataFrame:
    return required_fields_report_df(event_payloads(spread(Tables(spark, d).events)))


# --------------------------------------------------------------------------
# Null and range audit over customer with injected NULLs
# --------------------------------------------------------------------------

def customer_with_nulls(customer: DataFrame) -> DataFrame:
    """Driver tables hold no NULLs; inject them by a fixed key rule."""
    return customer.select(
        "c_custkey",
        null_if_key_mod("c_name", "c_custkey", 13).alias("c_name"),
        null_if_key_mod("c_nationkey", "c_custkey", 11).alias("c_nationkey"),
        null_if_key_mod("c_acctbal", "c_custkey", 17).alias("c_acctbal"),
        null_if_key_mod("c_mktsegment", "c_custkey", 7).alias("c_mktsegment"))


@query("null_and_range_audit", "S7 S8", sql="""
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS c_name,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer)
SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_c_custkey,
       CAST(sum(CASE WHEN c_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_c_name,
       CAST(sum(CASE WHEN c_nationkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_c_nationkey,
       CAST(sum(CASE WHEN c_acctbal IS NULL OR isnan(c_acctbal) THEN 1 ELSE 0 END) AS BIGINT) AS null_c_acctbal,
       CAST(sum(CASE WHEN c_mktsegment IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_c_mktsegment,
       CAST(sum(CASE WHEN coalesce(c_acctbal >= 0, false) THEN 0 ELSE 1 END) AS BIGINT) AS bad_acctbal_nonneg,
       CAST(sum(CASE WHEN coalesce(c_nationkey BETWEEN 0 AND 24, false) THEN 0 ELSE 1 END) AS BIGINT) AS bad_nationkey_range
FROM c
""")
def null_and_range_audit(spark: SparkSession, d: str) -> DataFrame:
    c = customer_with_nulls(Tables(spark, d).customer)
    checks = {"acctbal_nonneg": F.col("c_acctbal") >= 0,
              "nationkey_range": F.col("c_nationkey").between(0, 24)}
    # one pass: the audit and the range checks share a single aggregate
    nulls = [count_if(F.col(x).isNull() | (F.isnan(x) if t == "double" else F.lit(False)))
             .alias(f"null_{x}") for x, t in c.dtypes]
    bad = [count_if(~F.coalesce(cond, F.lit(False))).alias(f"bad_{n}") for n, cond in checks.items()]
    return c.agg(F.count(F.lit(1)).alias("n_rows"), *nulls, *bad)


# --------------------------------------------------------------------------
# Extracted line items as an array of structs
# --------------------------------------------------------------------------

ITEM_SCHEMA = "order_id bigint, total double, line_items array<struct<line: int, part: bigint, quantity: double, amount: double>>"


@query("nested_line_items", "P21 P22 S9", sql="""
WITH li AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS parts,
                   sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS amount, max(l_quantity) AS top
            FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS order_id, CAST(coalesce(n, 0) AS INTEGER) AS item_count, CAST(coalesce(parts, 0) AS INTEGER) AS n_parts,
       CAST(coalesce(amount, 0) AS DOUBLE) AS items_amount, round(top, 4) AS max_quantity,
       CAST(o_totalprice AS DECIMAL(18, 2)) = coalesce(amount, 0) AS reconciles
FROM orders LEFT JOIN li ON o_orderkey = l_orderkey
""")
def nested_line_items(spark: SparkSession, d: str) -> DataFrame:
    """Order documents whose line items are an array of structs, as extraction
    returns them: written as JSON text, parsed with a declared schema, and
    flattened inside the record (size and folds over the array, no explode)."""
    t = Tables(spark, d)
    item = F.struct(F.col("l_linenumber").cast("int").alias("line"), F.col("l_partkey").alias("part"),
                    F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("amount"))
    items = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(item).alias("line_items"))  # one order's items
    docs = t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.to_json(F.struct(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"), "line_items")).alias("json"))
    r = docs.select(F.from_json("json", ITEM_SCHEMA).alias("r")).select("r.*")
    found = F.coalesce("line_items", F.array().cast("array<struct<line:int,part:bigint,quantity:double,amount:double>>"))
    amount = F.aggregate(found, F.lit(0).cast("decimal(28,2)"),
                         lambda a, x: (a + x["amount"].cast("decimal(18,2)")).cast("decimal(28,2)"))
    return r.select("order_id", F.size(found).alias("item_count"),
                    F.size(F.array_distinct(F.transform(found, lambda x: x["part"]))).alias("n_parts"),
                    amount.cast("double").alias("items_amount"),
                    round4(F.array_max(F.transform(found, lambda x: x["quantity"]))).alias("max_quantity"),
                    (F.col("total").cast("decimal(18,2)") == amount).alias("reconciles"))


# --------------------------------------------------------------------------
# Stated order total vs the sum of its line items
# --------------------------------------------------------------------------

@query("order_total_reconcile", "S9 P22", sql="""
WITH li AS (
  SELECT l_orderkey, count(*) AS n_items,
         sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(18, 2)))
             * (1 + CAST(l_tax AS DECIMAL(18, 2)))) AS items_total
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(n_items, 0) AS n_items,
       CAST(round(coalesce(items_total, 0), 4) AS DOUBLE) AS items_total,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS stated_total,
       CAST(round(CAST(o_totalprice AS DECIMAL(18, 2)) - coalesce(items_total, 0), 4) AS DOUBLE) AS diff,
       abs(CAST(o_totalprice AS DECIMAL(18, 2)) - coalesce(items_total, 0)) > 0.01 AS mismatch
FROM orders LEFT JOIN li ON o_orderkey = l_orderkey
""")
def order_total_reconcile(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    orders = t.orders
    # partial aggregation per order, then one join on the same key: the
    # aggregate's hash partitioning on l_orderkey is reused by the join
    # money is summed as decimal(18, 2) inputs: the total is exact, so the
    # 0.01 tolerance is not at the mercy of summation order
    money = lambda c: F.col(c).cast("decimal(18,2)")
    items = (t.lineitem.groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_items"),
                  F.sum(money("l_extendedprice") * (1 - money("l_discount")) * (1 + money("l_tax")))
                  .alias("items_total")))
    j = orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
    total = F.coalesce("items_total", F.lit(0).cast("decimal(18,2)"))
    stated = money("o_totalprice")
    return j.select("o_orderkey", F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                    F.round(total, 4).cast("double").alias("items_total"),
                    stated.cast("double").alias("stated_total"),
                    F.round(stated - total, 4).cast("double").alias("diff"),
                    S.reconcile_flag(stated, total).alias("mismatch"))


# --------------------------------------------------------------------------
# Dictionary / ordinal / binary / band encodings
# --------------------------------------------------------------------------

# Fixed code books (values chosen for the driver's orders table)
PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
PRIORITY_ORDINAL = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3}
MONTH_BANDS = {"1": "Q1", "2": "Q1", "3": "Q1", "4": "Q2", "5": "Q2", "6": "Q2"}


@query("dict_ordinal_encode", "P5 P6 P7 P10", sql="""
SELECT o_orderkey,
       CAST(coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
                                          WHEN '3-MEDIUM' THEN 3 END, 0) AS INTEGER) AS priority_code,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
                                 WHEN '4-NOT SPECIFIED' THEN 3 END AS INTEGER) AS priority_ordinal,
       CAST(coalesce(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END = 'F', false) AS INTEGER) AS status_flag,
       coalesce(CASE CAST(month(o_orderdate) AS VARCHAR) WHEN '1' THEN 'Q1' WHEN '2' THEN 'Q1' WHEN '3' THEN 'Q1'
                WHEN '4' THEN 'Q2' WHEN '5' THEN 'Q2' WHEN '6' THEN 'Q2' END, 'H2') AS month_band
FROM orders
""")
def dict_ordinal_encode(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    status = null_if_key_mod("o_orderstatus", "o_orderkey", 9)
    return o.select(
        "o_orderkey",
        map_lookup("o_orderpriority", PRIORITY_CODES, 0).cast("int").alias("priority_code"),
        map_lookup("o_orderpriority", PRIORITY_ORDINAL).cast("int").alias("priority_ordinal"),
        yes_no_flag(status, "F").alias("status_flag"),
        map_lookup(F.month("o_orderdate").cast("string"), MONTH_BANDS, "H2").alias("month_band"))


# --------------------------------------------------------------------------
# Bucket with sentinel 999
# --------------------------------------------------------------------------

def bucket_with_sentinel(c, sentinel: int = 999, near: int = 30):
    """999 -> 0 (never), <= 30 -> 1, else 2; NULL -> 2 as NaN compares false."""
    return (F.when(c == sentinel, 0).when(c <= near, 1).otherwise(2)).cast("int")


@query("bucket_sentinel", "P9", sql="""
WITH p AS (
  SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 10 = 0 THEN 999
                         ELSE p_size END AS pdays FROM part)
SELECT p_partkey, pdays,
       CAST(CASE WHEN pdays = 999 THEN 0 WHEN pdays <= 30 THEN 1 ELSE 2 END AS INTEGER) AS pdays_bucket
FROM p
""")
def bucket_sentinel(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    pdays = (F.when(F.pmod("p_partkey", F.lit(13)) == 0, F.lit(None).cast("int"))
             .when(F.pmod("p_partkey", F.lit(10)) == 0, F.lit(999)).otherwise(F.col("p_size")))
    return p.select("p_partkey", pdays.alias("pdays")).withColumn(
        "pdays_bucket", bucket_with_sentinel(F.col("pdays")))


# --------------------------------------------------------------------------
# Log target, served rounding
# --------------------------------------------------------------------------

@query("log_target", "P12 P25", sql="""
SELECT event_id,
       round(CASE WHEN value > 0 THEN ln(value) END, 4) AS log_value,
       round_even(CASE WHEN value > 0 THEN ln(value) END, 2) AS served_2dp
FROM events
""")
def log_target(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events
    lv = F.when(F.col("value") > 0, F.ln("value"))
    return e.select("event_id", round4(lv).alias("log_value"), bround_py(lv, 2).alias("served_2dp"))


# --------------------------------------------------------------------------
# Interaction feature "a-b" with pandas' text for a missing value
# --------------------------------------------------------------------------

@query("interaction_concat", "P11", sql="""
SELECT c_custkey,
       coalesce(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END, 'nan') || '-' ||
       coalesce(CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS VARCHAR), 'nan') AS segment_nation
FROM customer
""")
def interaction_concat(spark: SparkSession, d: str) -> DataFrame:
    c = customer_with_nulls(Tables(spark, d).customer)
    return c.select("c_custkey", pandas_concat("-", "c_mktsegment", "c_nationkey").alias("segment_nation"))


# --------------------------------------------------------------------------
# Lookup with default through a size-checked broadcast left join
# --------------------------------------------------------------------------

@query("lookup_default", "P23 J2", sql="""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS nk
           FROM customer)
SELECT c_custkey, coalesce(n.n_name, 'UNKNOWN') AS nation,
       coalesce(lower(r.r_name), 'unknown') AS region
FROM c LEFT JOIN nation n ON c.nk = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def lookup_default(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    c = t.customer.select(
        "c_custkey",
        F.when(F.pmod("c_custkey", F.lit(17)) == 0, F.col("c_nationkey") + 100)
        .otherwise(F.col("c_nationkey")).alias("nk"))
    nation, region = t.nation, t.region
    lookup = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("nk"), "n_name", F.lower("r_name").alias("region_lc"))
    j = J.lookup_join(c, lookup, "nk")
    return j.select("c_custkey", F.coalesce("n_name", F.lit("UNKNOWN")).alias("nation"),
                    F.coalesce("region_lc", F.lit("unknown")).alias("region"))


# --------------------------------------------------------------------------
# Mode imputation fitted on the train split, then dedupe
# --------------------------------------------------------------------------

@query("mode_impute", "A5 A6 A4", sql="""
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
         (('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '42'), 1, 8))::BIGINT % 1000000) >= 300000 AS is_train
  FROM customer),
mn AS (SELECT c_nationkey AS m FROM c WHERE is_train AND c_nationkey IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
ms AS (SELECT c_mktsegment AS m FROM c WHERE is_train AND c_mktsegment IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT DISTINCT coalesce(c_nationkey, (SELECT m FROM mn)) AS c_nationkey,
                coalesce(c_mktsegment, (SELECT m FROM ms)) AS c_mktsegment
FROM c
""")
def mode_impute(spark: SparkSession, d: str) -> DataFrame:
    c = customer_with_nulls(Tables(spark, d).customer).withColumn(
        "is_train", stable_unit(F.col("c_custkey")) >= 300_000)
    cols = ["c_nationkey", "c_mktsegment"]
    modes = A.fit_modes(c.where("is_train"), cols)  # one aggregate, one row
    return A.dedupe_rows(A.apply_fill(c.select(*cols), modes))


# --------------------------------------------------------------------------
# A11 R2 IO5: metrics log -> latest row per algorithm, beat-the-last gate
# --------------------------------------------------------------------------

GATE_THRESHOLD = 5.0


@query("latest_metric_per_algo", "A11 R2 IO5", sql="""
WITH r AS (
  SELECT event_type AS algo_name, ts AS training_time, event_id, round(value, 4) AS metric,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
SELECT a.algo_name, a.event_id AS run_id, a.metric, b.metric AS previous_metric,
       (a.metric >= 5.0 AND (b.metric IS NULL OR a.metric >= b.metric)) AS passes
FROM r a LEFT JOIN r b ON a.algo_name = b.algo_name AND b.rn = 2
WHERE a.rn = 1
""")
def latest_metric_per_algo(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.operators.gates import beat_the_last
    from featurelab.sources.files import append_metrics
    e = Tables(spark, d).events
    log = e.select(F.col("event_type").alias("algo_name"), F.col("ts").alias("training_time"),
                   F.col("event_id").alias("run_id"), round4("value").alias("metric"))
    # the log as jobs leave it: rows appended by two runs, read back
    path = scratch_path(spark, "metrics-log")
    for run in (0, 1):
        append_metrics(log.where(F.pmod("run_id", F.lit(2)) == run), path)
    log = spark.read.parquet(path)
    return beat_the_last(log, "algo_name", ["training_time", "run_id"], "metric", GATE_THRESHOLD)


# --------------------------------------------------------------------------
# Top-k by absolute value per group
# --------------------------------------------------------------------------

@query("topk_by_abs", "A12", sql="""
SELECT l_orderkey, l_linenumber, attribution, CAST(rnk AS INTEGER) AS rank FROM (
  SELECT l_orderkey, l_linenumber, round(l_quantity - 25.5, 4) AS attribution,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY abs(l_quantity - 25.5) DESC, l_linenumber, l_quantity, l_partkey, l_suppkey) AS rnk
  FROM lineitem) WHERE rnk <= 3
""")
def topk_by_abs(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_quantity") - 25.5).alias("a"))
    # (l_orderkey, l_linenumber) is not unique in the data: break ties fully
    top = A.top_k_within(li, ["l_orderkey"], [F.abs("a").desc(), F.col("l_linenumber"), F.col("a"),
                                              F.col("l_partkey"), F.col("l_suppkey")], 3)
    return top.select("l_orderkey", "l_linenumber", round4("a").alias("attribution"), "rank")


# --------------------------------------------------------------------------
# Best trial per study (min metric, first trial wins ties)
# --------------------------------------------------------------------------

@query("best_trial", "A13", sql="""
SELECT event_type AS study, arg_min(event_id, (value, event_id)) AS best_trial,
       round(min(value), 4) AS best_value, count(*) AS n_trials
FROM events GROUP BY event_type
""")
def best_trial(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select(F.col("event_type").alias("study"),
                                       F.col("event_id").alias("best_trial"), "value")
    b = A.best_per_key(e, ["study"], "value", "best_trial", ["best_trial", "value"])
    return b.select("study", "best_trial", round4("value").alias("best_value"), "n_trials")


# --------------------------------------------------------------------------
# Ordered, role-tagged history per conversation
# --------------------------------------------------------------------------

@query("conversation_history", "A16 P16", sql="""
WITH c AS (
  SELECT conv_id, turn, role, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM conversations)
SELECT conv_id, turn,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS prior_turns,
       CAST(coalesce(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_user_turns,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_assistant_turns,
       '[' || role || '] ' || CASE WHEN length(t) <= 80 THEN t ELSE substr(t, 1, 79) || '...' END AS line
FROM c
""")
def conversation_history(spark: SparkSession, d: str) -> DataFrame:
    """Ordered, role-tagged history lines with the running context of each
    turn (turns, user turns and assistant turns before it).  Both the
    position and the running counts are H1 computations: a conversation with
    a huge number of turns is spread over turn buckets, not one task; no
    turn ever carries the whole earlier conversation."""
    c = Tables(spark, d).conversations
    line = F.concat(F.lit("["), F.col("role"), F.lit("] "), short_text(F.col("text"), 80))
    base = c.select("conv_id", "turn", "role", line.alias("line"))
    bucket = F.floor(F.col("turn") / 4096).cast("bigint")
    counted = H.bucketed_running_sums(base, ["conv_id"], bucket, [F.col("turn")], {
        "prior_turns": F.lit(1).cast("bigint"),
        "prior_user_turns": (F.col("role") == "user").cast("bigint"),
        "prior_assistant_turns": (F.col("role") == "assistant").cast("bigint")})
    return counted.select("conv_id", "turn", "prior_turns", "prior_user_turns", "prior_assistant_turns", "line")


# --------------------------------------------------------------------------
# Sorted preview with decoded status, target profile
# --------------------------------------------------------------------------

STATUS_LABELS = {"F": "fulfilled", "O": "open", "P": "partial"}


@query("preview_profile", "A14 A15 P8", sql="""
SELECT CAST(o_custkey AS VARCHAR) AS entity_id, o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' ELSE 'unknown' END AS status
FROM orders ORDER BY CAST(o_custkey AS VARCHAR), o_orderkey LIMIT 10
""")
def preview_profile(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    status = F.coalesce(map_lookup("o_orderstatus", STATUS_LABELS), F.lit("unknown"))
    # orderBy + limit plans a TakeOrderedAndProject: a per-partition top-10
    return (o.select(F.col("o_custkey").cast("string").alias("entity_id"), "o_orderkey",
                     status.alias("status"))
            .orderBy("entity_id", "o_orderkey").limit(10))


@query("target_profile", "A17", sql="""
SELECT round(min(o_totalprice), 4) AS min_value, round(max(o_totalprice), 4) AS max_value,
       round(avg(o_totalprice), 4) AS mean_value, count(o_totalprice) AS n
FROM orders
""")
def target_profile(spark: SparkSession, d: str) -> DataFrame:
    p = A.profile(Tables(spark, d).orders, "o_totalprice")
    return p.select(round4("min_value").alias("min_value"), round4("max_value").alias("max_value"),
                    round4("mean_value").alias("mean_value"), "n")


# --------------------------------------------------------------------------
# IO12: structured run log summary
# --------------------------------------------------------------------------

@query("run_log_summary", "IO12", sql="""
SELECT event_type AS keyword, count(*) AS n_entries,
       CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS n_failed,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM events GROUP BY event_type
""")
def run_log_summary(spark: SparkSession, d: str) -> DataFrame:
    from featurelab.sources.logs import append_log, read_log, run_log_entries
    entries = run_log_entries(Tables(spark, d).events)
    path = scratch_path(spark, "run-log")
    append_log(entries.where("status = 0"), path)
    append_log(entries.where("status = 1"), path)  # a second run appends
    log = read_log(spark, path)
    return log.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("n_entries"), count_if(F.col("status") == 1).alias("n_failed"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


# --------------------------------------------------------------------------
# Vertical slices re-attached by key
# --------------------------------------------------------------------------

@query("slices_rejoined", "J5 J6", sql="""
SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment,
       CASE WHEN c_acctbal >= 0 THEN round(c_acctbal, 4) END AS c_acctbal
FROM customer
""")
def slices_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Three slices written apart, two of them without some of the keys, and
    put together again bucket by bucket."""
    c = Tables(spark, d).customer
    base = scratch_path(spark, "slices")
    parts = {"names": c.select("c_custkey", "c_name"),
             "places": c.where(F.pmod("c_custkey", F.lit(7)) != 0).select("c_custkey", "c_nationkey", "c_mktsegment"),
             "accounts": c.where("c_acctbal >= 0").select("c_custkey", "c_acctbal")}
    tag = base.rsplit("-", 1)[-1]
    slices = [J.write_bucketed(df, "c_custkey", f"slice_{n}_{tag}", f"{base}/{n}", 8) for n, df in parts.items()]
    wide = J.rejoin_slices(slices, "c_custkey")
    return wide.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", round4("c_acctbal").alias("c_acctbal"))


# --------------------------------------------------------------------------
# J9 IO11: rows not yet in the processed manifest
# --------------------------------------------------------------------------

@query("unprocessed_rows", "J9 IO11", sql="""
WITH manifest AS (
  SELECT o_orderkey AS k FROM orders
  WHERE (('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '7'), 1, 8))::BIGINT % 1000000) < 700000)
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM manifest)
""")
def unprocessed_rows(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    manifest = o.where(stable_unit(F.col("o_orderkey"), seed=7) < 700_000).select(
        F.col("o_orderkey").alias("k"))
    return J.unprocessed(o.select("o_orderkey", "o_custkey"), manifest, "o_orderkey", "k")


# --------------------------------------------------------------------------
# Lenient date parsing of exported text dates
# --------------------------------------------------------------------------

def parse_date_lenient(c):
    """``pd.to_datetime(errors="coerce")``: unparseable text becomes NULL
    (``to_timestamp`` would raise under ANSI)."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
                      F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


@query("date_parse_lenient", "P13 A1", sql="""
WITH t AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
              WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS date_text FROM orders),
p AS (SELECT o_totalprice, coalesce(try_strptime(date_text, '%Y-%m-%d %H:%M:%S'),
                                    try_strptime(date_text, '%Y-%m-%d')) AS d FROM t)
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       count(*) AS n_orders, round(sum(o_totalprice), 4) AS revenue
FROM p WHERE d IS NOT NULL GROUP BY 1, 2
""")
def date_parse_lenient(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    text = (F.when(F.pmod("o_orderkey", F.lit(11)) == 0, F.lit("n/a"))
            .when(F.pmod("o_orderkey", F.lit(5)) == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    parsed = o.select("o_totalprice", parse_date_lenient(text).alias("d"))
    out = (parsed.select(F.year("d").alias("year"), F.month("d").alias("month"), "o_totalprice")
           .where(F.col("year").isNotNull())
           .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_orders"),
                                         F.sum("o_totalprice").alias("revenue")))
    return out.select("year", "month", "n_orders", round4("revenue").alias("revenue"))


# --------------------------------------------------------------------------
# Schema report of every input table against its declared columns
# --------------------------------------------------------------------------

def _schema_sql() -> str:
    from featurelab.sources.tables import TABLE_COLUMNS
    names = ", ".join(f"'{t}'" for t in TABLE_COLUMNS)
    expected = " ".join(f"WHEN '{t}' THEN '{','.join(c)}'" for t, c in TABLE_COLUMNS.items())
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLE_COLUMNS)
    return f"""
WITH c AS (SELECT table_name, string_agg(column_name, ',' ORDER BY ordinal_position) AS cols, count(*) AS n
           FROM information_schema.columns WHERE table_name IN ({names}) GROUP BY table_name),
e AS (SELECT *, CASE table_name {expected} END AS expected FROM c),
l AS (SELECT *, string_split(cols, ',') AS a, string_split(expected, ',') AS x FROM e),
r AS ({counts})
SELECT l.table_name, CAST(n AS INTEGER) AS n_columns, r.n_rows, cols = expected AS ordered_match,
       list_sort(a) = list_sort(x) AS set_match,
       array_to_string(list_filter(x, lambda v: NOT list_contains(a, v)), ',') AS missing,
       array_to_string(list_filter(a, lambda v: NOT list_contains(x, v)), ',') AS unexpected
FROM l JOIN r ON l.table_name = r.table_name
"""


@query("schema_diff_report", "S1 S2 S3", sql=_schema_sql())
def schema_diff_report(spark: SparkSession, d: str) -> DataFrame:
    """Ordered (S1) and set (S2) column checks of every input table plus the
    missing / unexpected lists (S3, always reported) and the row count."""
    from featurelab.sources.tables import TABLE_COLUMNS, table
    out = None
    for name, expected in TABLE_COLUMNS.items():
        df = table(spark, d, name)
        rep = S.column_set_report(df, expected)
        ordered = list(df.columns) == list(expected)
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(rep.n_actual).cast("int").alias("n_columns"), "n_rows",
            F.lit(ordered).alias("ordered_match"),
            F.lit(not rep.missing and not rep.unexpected).alias("set_match"),
            F.lit(",".join(rep.missing)).alias("missing"), F.lit(",".join(rep.unexpected)).alias("unexpected"))
        out = one if out is None else out.unionByName(one)
    return out
