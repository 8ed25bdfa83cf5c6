"""Gram-matrix regression and Arrow Shapley values against plain numpy."""

import time
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurelab.operators import attribution as A
from featurelab.operators import linear as L

RNG = np.random.default_rng(4)


def test_folds_equal_separate_fits(spark):
    x = RNG.normal(size=(400, 3)) * [1, 50, 0.01] + [0, 1000, 5]
    y = x @ [2.0, -0.3, 7.0] + 1 + RNG.normal(size=400)
    fold = RNG.integers(0, 5, 400)
    df = spark.createDataFrame([(int(f), *map(float, r), float(t)) for f, r, t in zip(fold, x, y)], "f int, a double, b double, c double, y double")
    df = df.unionByName(spark.createDataFrame([(0, None, 1.0, 1.0, 1.0), (1, float("nan"), 1.0, 1.0, 1.0)], df.schema))
    for got in L.cross_validate(df, ["a", "b", "c"], "y", "f"):
        tr, te = fold != got.fold, fold == got.fold
        one = np.c_[np.ones(400), x]
        beta = np.linalg.lstsq(one[tr], y[tr], rcond=None)[0]
        assert np.allclose(got.coefficients, beta, rtol=1e-6) and (got.n_train, got.n_test) == (tr.sum(), te.sum())
        assert got.rmse == pytest.approx(np.sqrt(((y[te] - one[te] @ beta) ** 2).mean()), rel=1e-6)


def scorer():
    # a nested function goes to the workers by value
    def score(x):
        return x[:, 0] * x[:, 1] + np.where(x[:, 2] > 0, x[:, 1], -1.0)

    return score


score = scorer()


def test_all_orders_are_exact_and_rows_stay(spark):
    x = RNG.normal(size=(50, 3))
    df = spark.createDataFrame([(i % 40, f"k{i}", *map(float, r)) for i, r in enumerate(x)], "id int, attr_a string, a double, b double, c double")
    got = A.shapley(df.drop("attr_a").withColumn("k", F.lit(1)), "id", ["a", "b", "c"], score, {"a": 0.1, "b": 0.2, "c": -0.3}, paths=None)
    base = np.array([0.1, 0.2, -0.3])
    by = {}
    for r in x:
        phi = np.zeros(3)
        for p in permutations(range(3)):
            z = base.copy()
            for j in p:
                before = score(z[None])[0]
                z[j] = r[j]
                phi[j] += (score(z[None])[0] - before) / 6
        by[tuple(r)] = phi
    rows = got.collect()
    assert len(rows) == 50
    for r in rows:
        phi = by[r["a"], r["b"], r["c"]]
        assert np.allclose([r["attr_a"], r["attr_b"], r["attr_c"]], phi)
        assert sum(phi) == pytest.approx(r["instance_score"] - r["baseline_score"])
    with pytest.raises(ValueError):
        A.shapley(df, "id", list("abcdefgh"), score, {}, paths=None)


def test_sampled_paths_depend_on_the_row_alone(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 3), float(-i)) for i in range(60)], "id long, a double, b double, c double")
    base = {"a": 0.0, "b": 1.0, "c": 2.0}
    one = A.shapley(df, "id", ["a", "b", "c"], score, base, paths=4)
    two = A.shapley(df.repartition(7), "id", ["a", "b", "c"], score, base, paths=4)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert "Exchange hashpartitioning" not in one._jdf.queryExecution().executedPlan().toString()
    assert A.shapley(df.limit(0), "id", ["a", "b", "c"], score, base).collect() == []


def test_fifty_features_in_seconds(spark):
    w = RNG.normal(size=50)
    names = [f"f{i}" for i in range(50)]
    df = spark.range(2000).select("id", *[(F.rand(i) * 10).alias(n) for i, n in enumerate(names)]).repartition(8)
    df.limit(1).collect()
    t = time.time()
    got = A.shapley(df, "id", names, A.linear(w), {n: 1.0 for n in names}, paths=25).limit(2000).collect()
    assert time.time() - t < 20 and len(got) == 2000
    assert all(abs(r["attr_f7"] - w[7] * (r["f7"] - 1.0)) < 1e-9 for r in got)
