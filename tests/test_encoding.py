"""Encoders, splits and balancing: reference assertions plus invariants."""

import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from featurelab.functions.columns import md5_mod
from featurelab.operators import balance as B
from featurelab.operators import encode as E
from featurelab.operators import split as SP

# Golden feature list of the bike-demand model (fixed values of the reference's test)
BIKE_COLUMNS = [
    'temp', 'humidity', 'season_2', 'season_3', 'season_4', 'month_2',
    'month_3', 'month_4', 'month_5', 'month_6', 'month_7', 'month_8',
    'month_9', 'month_10', 'month_11', 'month_12', 'hour_1', 'hour_2',
    'hour_3', 'hour_4', 'hour_5', 'hour_6', 'hour_7', 'hour_8', 'hour_9',
    'hour_10', 'hour_11', 'hour_12', 'hour_13', 'hour_14', 'hour_15',
    'hour_16', 'hour_17', 'hour_18', 'hour_19', 'hour_20', 'hour_21',
    'hour_22', 'hour_23', 'holiday_1', 'weekday_1', 'weekday_2',
    'weekday_3', 'weekday_4', 'weekday_5', 'weekday_6', 'workingday_1',
    'weather_2', 'weather_3', 'weather_4'
]


def test_one_hot_golden_columns(spark):
    rows = []
    for i in range(24 * 12):
        rows.append((0.5, 0.4, 1 + i % 4, 1 + i % 12, i % 24, i % 2, i % 7, (i + 1) % 2, 1 + i % 4))
    df = spark.createDataFrame(rows, "temp double, humidity double, season int, month int, hour int, "
                                     "holiday int, weekday int, workingday int, weather int")
    cats = ["season", "month", "hour", "holiday", "weekday", "workingday", "weather"]
    oh = E.fit_one_hot(df, cats)
    out = oh.transform(df)
    assert out.columns == BIKE_COLUMNS
    # null and unseen categories give all zeros
    extra = spark.createDataFrame([(0.1, 0.2, None, 99, 5, 0, 1, 1, 2)], df.schema)
    r = oh.transform(extra).first()
    assert all(r[c] == 0 for c in BIKE_COLUMNS if c.startswith(("season_", "month_")))


def test_md5_mod_equals_python(spark):
    vals = ["Home-No Urgent Place", "1-1", "80-Sunny", "Restaurant(<20)", "x" * 50, "é"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.v: r.m for r in df.select("v", md5_mod(F.col("v"), 27).alias("m")).collect()}
    for v in vals:
        assert got[v] == int(hashlib.md5(v.encode()).hexdigest(), 16) % 27


def test_hashing_layout(spark):
    df = spark.createDataFrame([("a", "b", "c", "d", "e", 1, 2)],
                               "c1 string, c2 string, c3 string, c4 string, c5 string, k int, z int")
    out = E.hashing_encode(df, ["c1", "c2", "c3", "c4", "c5"], 27)
    assert out.columns == [f"col_{i}" for i in range(27)] + ["k", "z"]
    r = out.first()
    assert sum(r[f"col_{i}"] for i in range(27)) == 5


def test_split_partition_independent(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    a = o.repartition(2).select("o_orderkey", SP.split_column(F.col("o_orderkey"), 0.2).alias("s"))
    b = o.repartition(17).select("o_orderkey", SP.split_column(F.col("o_orderkey"), 0.2).alias("s"))
    assert sorted(a.collect()) == sorted(b.collect())
    frac = a.where("s = 'test'").count() / a.count()
    assert 0.15 < frac < 0.25


def test_stratified_exact_sizes(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus")
    s = SP.stratified_split(o, "o_orderkey", "o_orderstatus", 0.3)
    got = {(r.o_orderstatus): r.n for r in s.where("split = 'test'").groupBy("o_orderstatus")
           .agg(F.count("*").alias("n")).collect()}
    for r in o.groupBy("o_orderstatus").count().collect():
        assert got[r.o_orderstatus] == SP.expected_test_size(r["count"], 0.3)


def test_oversample_balances(spark):
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    out = B.random_oversample(lab, "doc_id", "label")
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert len(set(counts.values())) == 1
    # majority rows are kept exactly once
    maj = B.class_sizes(lab, "label").orderBy(F.col("n").desc()).first()["label"]
    assert out.where(F.col("label") == maj).where("copy_id > 0").count() == 0


def test_standard_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    sc = E.fit_standard_scaler(df, ["a", "b"])
    rows = sc.transform(df).orderBy("a").collect()
    assert [r.a for r in rows] == [-1.0, 1.0]
    assert [r.b for r in rows] == [0.0, 0.0]


def test_poly_has_bias_and_15_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "a double, b double, c double, d double")
    out = E.polynomial_features(df, ["a", "b", "c", "d"])
    assert len(out.columns) == 15
    assert out.first()["poly_1"] == 1.0


def test_assemble_missing_feature_raises(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(E.MissingFeature):
        E.assemble(df, ["a", "b"])


def test_any_number_of_categories(spark):
    n = 12_000
    df = spark.range(n).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("v"), "id")
    out = E.fit_label_encoder(df, ["v"]).transform(df)
    assert out.columns == ["v", "id"]
    assert out.where(F.col("v") != F.col("id")).count() == 0 and out.count() == n


def test_label_codes_of_unseen_null_and_mixed_types(spark):
    fit = spark.createDataFrame([("b", 3), ("a", 10), (None, None), ("b", -1)], "s string, n int")
    new = spark.createDataFrame([("a", -1), ("c", 3), (None, 10)], "s string, n int")
    got = [tuple(r) for r in E.fit_label_encoder(fit, ["s", "n"]).transform(new).collect()]
    assert sorted(got, key=str) == sorted([(0, 0), (None, 1), (None, 2)], key=str)


def test_null_labels_and_keys_are_not_lost(spark):
    rows = [(i, "a" if i % 3 else None) for i in range(90)] + [(None, "a"), (None, None), (None, "b")]
    df = spark.createDataFrame(rows, "k long, label string")
    assert SP.stratified_split(df, "k", "label", 0.25).count() == 93
    out = B.random_oversample(df, "k", "label")
    assert {r["count"] for r in out.groupBy("label").count().collect()} == {61}


def test_explode_copies_chunked_equals_plain(spark):
    from featurelab.operators.balance import explode_copies
    df = spark.createDataFrame([(1, 7), (2, 0), (3, 25)], "k long, n int")
    plain = explode_copies(df, F.col("n"), "c", "k", chunk=100)
    chunked = explode_copies(df, F.col("n"), "c", "k", chunk=4)
    a = sorted((r.k, r.c) for r in plain.collect())
    b = sorted((r.k, r.c) for r in chunked.collect())
    assert a == b and len(a) == 32
    assert {r.k: r.m for r in chunked.groupBy("k").agg(F.max("c").alias("m")).collect()} == {1: 6, 3: 24}
