"""The vector index against comparing everything, and what it opens."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurelab.operators.knn import nearest
from featurelab.operators.retrieval import top_k_similar
from featurelab.operators.vector_index import VectorIndex, choose_pivots

RNG = np.random.default_rng(11)


def clustered(n, dim=6, centres=12, spread=0.02):
    c = RNG.normal(size=(centres, dim)) * 5
    return c[RNG.integers(0, centres, n)] + RNG.normal(size=(n, dim)) * spread


def brute(q, c, k, same=lambda a, b: False):
    out = {}
    for qid, v in q:
        d = [(float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in c if not same(qid, i)]
        out[qid] = [i for _, i in sorted(d)[:k]]
    return out


def listed(nn):
    out = {}
    for r in nn.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r["tid"])
    return out


@pytest.mark.parametrize("few_bytes", [1 << 20, 0])
@pytest.mark.parametrize("shape", ["clustered", "even", "copies"])
def test_nearest_is_exact(spark, shape, few_bytes):
    x = {"clustered": clustered(900), "even": RNG.normal(size=(900, 6)),
         "copies": np.repeat(RNG.normal(size=(9, 6)), 100, axis=0)}[shape].tolist()
    rows = [(i, v, i % 3) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    got = nearest(df.where("id % 30 = 0").select("id", "v"), df, 4, exclude_self=True, query_block_rows=5,
                  corpus_block_rows=60, few_bytes=few_bytes)
    assert listed(got) == brute([(i, v) for i, v, _ in rows if i % 30 == 0], [(i, v) for i, v, _ in rows], 4, lambda a, b: a == b)


def test_groups_odd_rows_and_text_ids(spark):
    rows = [(f"r{i}", v, "ab"[i % 2] if i % 7 else None) for i, v in enumerate(clustered(300).tolist())]
    odd = [("n1", None, "a"), ("n2", [1.0] * 5 + [None], "a"), ("n3", [float("nan")] * 6, "b"), ("n4", [float("inf")] * 6, None)]
    df = spark.createDataFrame(rows + odd, "id string, v array<double>, g string").withColumn("label", F.lit(1))
    got = listed(nearest(df.select("id", "v", "g"), df, 3, exclude_self=True, corpus_block_rows=20, group="g", few_bytes=0))
    want = {}
    for g in ("a", "b", None):
        mine = [(i, v) for i, v, x in rows if x == g]
        want |= brute(mine, mine, 3, lambda a, b: a == b)
    assert got == want


def test_clustered_data_opens_few_tiles(spark):
    x = clustered(4000, centres=20)
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "id long, v array<double>, label int")
    index = VectorIndex.build(df, "id", "v", "label", cell_rows=200)
    q = df.select(F.lit("").alias("grp"), F.col("id").alias("qid"), F.col("v").alias("qv"), F.lit(0.5).alias("bound"))
    pairs = index.routes(q, home=False).count()
    all_pairs = 4000 * (len(index.cells[""]) - 1)
    print(f"{pairs} of {all_pairs} (query, cell) pairs opened beside the own cells")
    assert len(index.cells[""]) >= 15 and pairs < all_pairs / 10


def test_few_queries_leave_the_corpus_where_it_is(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(clustered(500).tolist())], "id long, v array<double>")
    index = VectorIndex.build(df, "id", "v", metric="cosine", cell_rows=50)
    q = index.routes(df.limit(3).select(F.lit("").alias("grp"), F.col("id").alias("qid"), F.col("v").alias("qv"),
                                        F.lit(float("inf")).alias("bound")), home=True)
    plan = index._opened(q, 2, False, True, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [In(cell" in plan


def test_cosine_with_zero_vectors_and_text_ids(spark):
    """Tiles that give no rows, ids as text."""
    c = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [0.0, 0.0]), ("c", [1.0, 0.0]), ("d", [2.0, 0.0]), ("e", [0.0, 3.0])],
                              "id string, v array<double>")
    q = spark.createDataFrame([("q1", [1.0, 0.1]), ("q2", [0.0, 0.0]), ("q3", None)], "qid string, v array<double>")
    got = [tuple(r)[:3] for r in top_k_similar(c, "id", "v", q, "qid", "v", k=2, query_block=1, corpus_block=1).orderBy("rank").collect()]
    assert got == [("q1", 1, "c"), ("q1", 2, "d")]
    assert top_k_similar(c.where("id < 'c'"), "id", "v", q, "qid", "v").collect() == []
    assert top_k_similar(c, "id", "v", q.limit(0), "qid", "v").collect() == []


def test_pivots_of_copies():
    assert len(choose_pivots(np.ones((10, 3)), 4)) == 1 and choose_pivots(np.zeros((0, 0)), 4).shape[0] == 1
