"""Hot-key inputs (one key holds most rows) against brute force: the
skew-safe operators must give exactly the plain answers."""

import pandas as pd
from pyspark.sql import functions as F

from featurelab.operators import aggregate as A
from featurelab.operators.rank import bucketed_row_number


def hot_frame(spark, n=6000):
    rows = [(0 if i % 3 else i % 17, i, float((i * 7919) % 1000)) for i in range(n)]
    return spark.createDataFrame(rows, "k long, t long, v double"), pd.DataFrame(rows, columns=["k", "t", "v"])


def test_latest_per_key_hot(spark):
    df, pdf = hot_frame(spark)
    got = {r.k: (r.t, r.v) for r in A.latest_per_key(df, ["k"], ["t"], ["t", "v"]).collect()}
    exp = pdf.sort_values("t").groupby("k").tail(1)
    assert got == {int(r.k): (int(r.t), float(r.v)) for r in exp.itertuples()}


def test_top_k_hot(spark):
    df, pdf = hot_frame(spark)
    got = sorted((r.k, r.t) for r in A.top_k_within(df, ["k"], [F.col("v").desc(), F.col("t")], 3).collect())
    exp = sorted((int(r.k), int(r.t)) for r in pdf.sort_values(["v", "t"], ascending=[False, True])
                 .groupby("k").head(3).itertuples())
    assert got == exp


def test_positions_hot_key_many_buckets(spark):
    df, pdf = hot_frame(spark)
    # narrow buckets: the hot key spans hundreds of them
    got = bucketed_row_number(df, ["k"], F.floor(F.col("t") / 16).cast("bigint"), [F.col("t")], "pos")
    got = {(r.k, r.t): r.pos for r in got.collect()}
    pdf = pdf.sort_values(["k", "t"])
    pdf["pos"] = pdf.groupby("k").cumcount() + 1
    assert got == {(int(r.k), int(r.t)): int(r.pos) for r in pdf.itertuples()}


def test_best_per_key_first_trial_wins_ties(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.5), ("a", 3, 0.7)] + [("b", i, 1.0) for i in range(100)],
                               "study string, trial long, value double")
    got = {r.study: r.trial for r in A.best_per_key(df, ["study"], "value", "trial", ["trial"]).collect()}
    assert got == {"a": 1, "b": 0}
