"""Encoding, splitting and balancing queries (F-group, H1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.functions.columns import round4, round4_sql, stable_unit
from featurelab.operators import balance as B
from featurelab.operators import encode as E
from featurelab.operators import split as SP
from featurelab.plans.registry import query
from featurelab.session import spread
from featurelab.sources.tables import Tables


def sql_unit(expr: str, seed: int = 42) -> str:
    """SQL twin of ``stable_unit``: md5(key || seed), first 8 hex digits, mod 10^6."""
    return f"((('0x' || substr(md5(CAST({expr} AS VARCHAR) || '{seed}'), 1, 8))::BIGINT) % 1000000)"


def sql_md5_mod(expr: str, n: int) -> str:
    """SQL twin of ``md5_mod`` (Horner's rule on four 32-bit digits)."""
    r = "0"
    for i in range(4):
        d = f"('0x' || substr(md5({expr}), {1 + 8 * i}, 8))::BIGINT"
        r = f"(({r}) * 4294967296 + {d}) % {n}"
    return r


# ---------------------------------------------------------------- F1


@query("label_encode", "F1", sql="""
SELECT p_partkey,
       CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type
FROM part
""")
def label_encode(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part.select("p_partkey", "p_brand", "p_type")
    enc = E.fit_label_encoder(p, ["p_brand", "p_type"])
    return enc.transform(p)


# ---------------------------------------------------------------- F2

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _one_hot_sql() -> str:
    cols = []
    for s in ["O", "P"]:
        cols.append(f"CAST(o_orderstatus = '{s}' AS INTEGER) AS \"o_orderstatus_{s}\"")
    for p in PRIORITIES[1:]:
        cols.append(f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"o_orderpriority_{p}\"")
    return "SELECT o_orderkey, round(o_totalprice, 4) AS o_totalprice, " + ", ".join(cols) + " FROM orders"


@query("one_hot_drop_first", "F2", sql=_one_hot_sql())
def one_hot_drop_first(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", round4("o_totalprice").alias("o_totalprice"),
                                       "o_orderstatus", "o_orderpriority")
    oh = E.fit_one_hot(o, ["o_orderstatus", "o_orderpriority"])
    return oh.transform(o)


# ---------------------------------------------------------------- F3

HASHED = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "c_nationkey", "o_month"]


def _hashing_sql(n: int = 27) -> str:
    slots = [sql_md5_mod(f"CAST({c} AS VARCHAR)", n) for c in HASHED]
    cols = []
    for i in range(n):
        cols.append("CAST(" + " + ".join(f"CASE WHEN {c} IS NOT NULL AND {s} = {i} THEN 1 ELSE 0 END"
                                         for c, s in zip(HASHED, slots)) + f" AS BIGINT) AS col_{i}")
    return ("WITH x AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, "
            "CAST(month(o_orderdate) AS INTEGER) AS o_month, round(o_totalprice, 4) AS o_totalprice "
            "FROM orders JOIN customer ON o_custkey = c_custkey) "
            "SELECT " + ", ".join(cols) + ", o_orderkey, o_totalprice FROM x")


@query("one_hot_sparse", "F2", sql="""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS seg, c_nationkey, c_name FROM customer),
a AS (SELECT c_mktsegment AS v, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code
      FROM (SELECT DISTINCT seg AS c_mktsegment FROM c WHERE seg IS NOT NULL)),
b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT c_nationkey AS v FROM c)),
n AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT c_name AS v FROM c)),
z AS (SELECT (SELECT count(*) - 1 FROM a) AS za, (SELECT count(*) - 1 FROM b) AS zb, (SELECT count(*) - 1 FROM n) AS zn),
x AS (SELECT c_custkey, list_filter([CASE WHEN a.code > 0 THEN a.code - 1 END, CASE WHEN b.code > 0 THEN za + b.code - 1 END,
                                     CASE WHEN n.code > 0 THEN za + zb + n.code - 1 END], lambda i: i IS NOT NULL) AS ix, za + zb + zn AS w
      FROM c LEFT JOIN a ON a.v = seg JOIN b ON b.v = c_nationkey JOIN n ON n.v = c_name, z)
SELECT c_custkey, array_to_string(ix, ',') AS indices, CAST(w AS BIGINT) AS width FROM x
""")
def one_hot_sparse(spark: SparkSession, d: str) -> DataFrame:
    """Sparse dummies of three columns, one of them different in every row."""
    c = Tables(spark, d).customer.select(
        "c_custkey", F.when(F.pmod("c_custkey", F.lit(11)) != 0, F.col("c_mktsegment")).alias("seg"), "c_nationkey", "c_name")
    rows, width = E.one_hot_sparse(c, ["seg", "c_nationkey", "c_name"])
    return rows.select("c_custkey", F.array_join("indices", ",").alias("indices"), F.lit(width).cast("bigint").alias("width"))


@query("hashing_encode", "F3", sql=_hashing_sql())
def hashing_encode(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    x = spread(t.orders).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment", "c_nationkey",
        F.month("o_orderdate").alias("o_month"), round4("o_totalprice").alias("o_totalprice"))
    return E.hashing_encode(x, HASHED, 27)


# ---------------------------------------------------------------- F4

SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("standard_scale", "F4", sql=f"""
WITH s AS (SELECT avg(l_quantity) mq, stddev_pop(l_quantity) sq, avg(l_extendedprice) mp,
                  stddev_pop(l_extendedprice) sp, avg(l_discount) md, stddev_pop(l_discount) sd FROM lineitem)
SELECT l_orderkey, l_linenumber,
       {round4_sql("(l_quantity - mq) / sq")} AS l_quantity,
       {round4_sql("(l_extendedprice - mp) / sp")} AS l_extendedprice,
       {round4_sql("(l_discount - md) / sd")} AS l_discount
FROM lineitem, s
""")
def standard_scale(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", *SCALED)
    sc = E.fit_standard_scaler(li, SCALED)
    out = sc.transform(li)
    return out.select("l_orderkey", "l_linenumber", *[round4(c).alias(c) for c in SCALED])


# ---------------------------------------------------------------- F5

POLY = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _poly_sql() -> str:
    cols = ["CAST(1.0 AS DOUBLE) AS poly_1"] + [f"round({c}, 4) AS poly_{c}" for c in POLY]
    for i, a in enumerate(POLY):
        for b in POLY[i:]:
            name = f"poly_{a}_sq" if a == b else f"poly_{a}_x_{b}"
            cols.append(f"round({a} * {b}, 4) AS {name}")
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(cols) + " FROM lineitem"


@query("poly_features", "F5", sql=_poly_sql())
def poly_features(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem
    p = E.polynomial_features(li, POLY, keep=["l_orderkey", "l_linenumber"])
    return p.select(*[round4(c).alias(c) if c.startswith("poly_") else F.col(c) for c in p.columns])


# ---------------------------------------------------------------- F6 F7 F8


@query("hash_split", "F6", sql=f"""
SELECT o_orderkey, CASE WHEN {sql_unit('o_orderkey')} < 200000 THEN 'test' ELSE 'train' END AS split
FROM orders
""")
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return o.select("o_orderkey", SP.split_column(F.col("o_orderkey"), 0.2).alias("split"))


@query("stratified_split", "F7 H1", sql=f"""
WITH h AS (SELECT o_orderkey, o_orderstatus, {sql_unit('o_orderkey')} AS h FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM h)
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split
FROM r
""")
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return SP.stratified_split(o, "o_orderkey", "o_orderstatus", 0.25)


@query("three_way_split", "F8", sql=f"""
SELECT o_orderkey,
       CASE WHEN {sql_unit('o_orderkey')} < 600000 THEN 'train'
            WHEN {sql_unit('o_orderkey')} < 800000 THEN 'validation' ELSE 'test' END AS split
FROM orders
""")
def three_way_split(spark: SparkSession, d: str) -> DataFrame:
    o = Tables(spark, d).orders
    return o.select("o_orderkey", SP.three_way_column(F.col("o_orderkey")).alias("split"))


# ---------------------------------------------------------------- F9


@query("random_oversample", "F9", sql=f"""
WITH tr AS (SELECT doc_id, toxic AS label, {sql_unit('doc_id')} AS h FROM labels
            WHERE {sql_unit('doc_id', 5)} >= 200000),
cnt AS (SELECT label, count(*) AS n FROM tr GROUP BY label),
mx AS (SELECT max(n) AS m FROM cnt),
rk AS (SELECT tr.*, row_number() OVER (PARTITION BY tr.label ORDER BY h, doc_id) AS rn FROM tr)
SELECT rk.doc_id, rk.label, CAST(c.copy_id AS INTEGER) AS copy_id
FROM rk JOIN cnt ON rk.label = cnt.label CROSS JOIN mx,
     LATERAL (SELECT unnest(range(0, (mx.m // cnt.n) + CASE WHEN rk.rn <= mx.m % cnt.n THEN 1 ELSE 0 END)) AS copy_id) c
""")
def random_oversample(spark: SparkSession, d: str) -> DataFrame:
    lab = Tables(spark, d).labels
    # resample the training rows only (the reference resampled before splitting)
    train = lab.where(stable_unit(F.col("doc_id"), 5) >= 200_000).select(
        "doc_id", F.col("toxic").alias("label"))
    return B.random_oversample(train, "doc_id", "label").select("doc_id", "label", "copy_id")


# ---------------------------------------------------------------- F11 F13

TYPED_SPEC = {"p_brand": "categorical", "p_type": "auto", "p_size": "numeric", "p_retailprice": "auto"}
FEATURE_ORDER = ["p_brand", "p_type", "p_size", "p_retailprice"]


@query("typed_columns_plan", "F11 F13", sql="""
WITH s AS (SELECT avg(p_size) ms, stddev_pop(p_size) ss, avg(p_retailprice) mr,
                  stddev_pop(p_retailprice) sr FROM part)
SELECT p_partkey,
       CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type,
       round((p_size - ms) / ss, 4) AS p_size,
       round((p_retailprice - mr) / sr, 4) AS p_retailprice
FROM part, s
""")
def typed_columns_plan(spark: SparkSession, d: str) -> DataFrame:
    p = Tables(spark, d).part
    plan = E.fit_typed_plan(p, TYPED_SPEC)
    out = E.assemble(plan.transform(p), ["p_partkey"] + FEATURE_ORDER)
    return out.select("p_partkey", "p_brand", "p_type", round4("p_size").alias("p_size"),
                      round4("p_retailprice").alias("p_retailprice"))
