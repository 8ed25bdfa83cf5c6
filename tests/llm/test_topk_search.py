"""Exact top-k against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurelab.llm import topk_search as K

SF = "/root/testdata/sf0.001"


def brute(rows, k, every, scale=256):
    """rows: (id, vector or None)"""
    ok = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, seen = set(), {}
    raw = {}
    for i, v in rows:
        if i is not None and i % every == 0 and v is not None and all(x is not None and np.isfinite(x) for x in v):
            if i not in raw or list(v) < raw[i]:
                raw[i] = list(v)
                seen[i] = [int(np.floor(np.float64(x) * scale)) for x in v]
    for q, qv in seen.items():
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)[:k]
        out |= {(q, n + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, i) in enumerate(scored)}
    return out


def rows_of(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 17)])
def test_matches_all_pairs(spark, blocks):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 5, 50)
    assert rows_of(K.top_k(df, F.pmod("vec_id", F.lit(50)) == 0, query_block=blocks[0], row_block=blocks[1])) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [9.0, 9.0]),
            (5, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [-3.0, 0.5]), (8, [2.0]), (9, []), (10, [0.1, -0.1, 5.0]),
            (7, [-3.0, 0.5]), (20, [1e12, 3e11]), (30, [1e12, -1.0]), (0, [0.5, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    for k in (1, 3, 50):
        assert rows_of(K.top_k(df, F.pmod("vec_id", F.lit(10)) == 0, k=k, row_block=4)) == brute(data, k, 10)


def test_copies_of_one_vector(spark):
    data = [(i, [0.25, -0.5, 0.125] if i % 3 else [float(i % 7), 1.0, 0.0]) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows_of(K.top_k(df, F.pmod("vec_id", F.lit(20)) == 0, row_block=64)) == brute(data, 5, 20)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert K.top_k(df, F.pmod("vec_id", F.lit(50)) == 0).collect() == []


@pytest.mark.parametrize("big", [False, True])
def test_products_are_resolved_only_for_rows_that_can_reach_the_cutoff(big):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(20, 32)) * 256
    c = np.floor(centre[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 32)) * 20) * (10 ** 9 if big else 1)
    q, c = K._exact(c[:40], c)
    assert (c.dtype == object) == big
    q_len, c_len = K.part_lengths(q, 4), K.part_lengths(c, 4)
    computed = 0
    for r in range(len(q)):
        score = np.asarray(c @ q[r])
        cutoff = int(np.sort(score)[-6])
        at, got, n = K.resolve(q[r], c, 4, q_len[r], c_len, cutoff)
        want = np.flatnonzero(score >= cutoff)
        assert at.tolist() == want.tolist() and got.tolist() == score[want].tolist()
        computed += n
    print(f"{computed} of {40 * 3000 * 4} partial products computed in the second pass")
    assert computed < 0.6 * 40 * 3000 * 4
    low = K.resolve(q[0], c, 4, q_len[0], c_len, -(10 ** 30))
    assert len(low[0]) == 3000 and low[2] == 12_000
