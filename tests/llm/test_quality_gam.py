"""Boosted tables on known functions, held-out quality, odd rows."""

import zlib

import numpy as np

from featurelab.llm import quality_gam as Q
from featurelab.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_three_leaf_tree_is_the_best_of_all_cuts():
    rng = np.random.default_rng(1)
    g, h = rng.normal(size=12), rng.uniform(0.1, 1, 12)
    gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1)
    best = max(gain(0, i) + gain(i, j) + gain(j, 12) for i in range(1, 12) for j in range(i, 12))
    v = Q.three_leaf_tree(g, h, 1.0)
    cuts = [0, *(np.flatnonzero(np.diff(v)) + 1), 12]
    assert np.isclose(sum(gain(a, b) for a, b in zip(cuts, cuts[1:])), best)


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = Q.fit_gam(x, y)
    assert (0, 1) in m.pairs
    assert ((m.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_held_out_quality(spark):
    out = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert set(out) == {r["doc_id"] for r in docs}
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == r["held_out"] for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())
    labels = [(out[r["doc_id"]], r["quality"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(r["predicted"], q) for r, q in labels if r["held_out"]]
    good = [p for p, q in held if q == 1]
    bad = [p for p, q in held if q == 0]
    assert len(bad) > 4 and np.mean(good) > 0.95 and np.mean(bad) < 0.3


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "some words", 3), (4, "x" * 300_000, 4),
                                  (5, "Good text here. " * 20, 5), (5, "Good text here. " * 20, 5)],
                                 "doc_id long, text string, score long")
    labels = spark.createDataFrame([(5, 1), (4, 0), (4, 0), (2, None), (None, 1), (99, 1)], "doc_id long, quality int")
    model = Q.train(docs, labels)
    rows = Q.score(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert Q.score(docs.limit(0), model).collect() == []
    unlabelled = Q.train(docs, labels.limit(0))
    assert {r["score"] for r in Q.score(docs, unlabelled).collect()} == {0.5}
    kept = Q.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == 6
    assert Q.keep_good(docs.limit(0), labels).collect() == []
