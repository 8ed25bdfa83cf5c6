"""Codewords, decoding, and accuracy on documents held out."""

from itertools import combinations

import numpy as np
import pytest

from featurelab.llm import language_id as I
from featurelab.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("k", [2, 3, 4, 6, 9, 40])
def test_codewords_differ(k):
    code = I.codewords(k)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1, 1}
    apart = min((code[i] != code[j]).sum() for i, j in combinations(range(k), 2))
    assert apart >= max(1, code.shape[1] // 4)
    assert all(0 < (col > 0).sum() < k for col in code.T)


def test_decoding_corrects_a_wrong_bit():
    code = I.codewords(4)
    model = I.EcocModel(list("abcd"), code, np.zeros((1, code.shape[1])), np.full(code.shape, 1 / code.shape[1]))
    for i in range(4):
        margins = code[i] * 0.6
        margins[2] = -margins[2]
        assert model.decode(margins)[0] == i
    assert model.decode(np.zeros(code.shape[1]))[2]  # nothing known: ambiguous


def test_held_out_accuracy_and_contract(spark):
    out = QUERIES["op5_language_id"](spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = out.collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    import zlib
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in rows)
    right = sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_whole_text_counts():
    long = "abc " * 200_000
    n = sum(len(x) for x in I.gram_buckets(long))
    assert n == sum(len(long) - k + 1 for k in I.ORDERS)
    short = long[:1000]
    want = np.sort(np.concatenate(list(I.gram_buckets(short))))
    old, I.CHUNK = I.CHUNK, 37
    try:
        assert np.array_equal(np.sort(np.concatenate(list(I.gram_buckets(short)))), want)
    finally:
        I.CHUNK = old


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog sat on the mat " * 5, "en"), (2, "le chat et le chien sont sur la table " * 5, "fr"),
            (3, None, "en"), (4, "", "fr"), (5, "123 ... 456", None), (None, "the dog", None), (6, "12", "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "lang as score", "1 as id")
    model = I.train(df)
    assert model.langs == ["en", "fr"]
    got = {r["doc_id"]: (r["lang_pred"], r["ambiguous"]) for r in I.predict(df, model).collect()}
    assert got[1][0] == "en" and got[2][0] == "fr" and got[None][0] == "en"
    assert [got[i] for i in (3, 4, 5, 6)] == [("und", True)] * 4
    assert I.predict(df.limit(0), model).collect() == []
    nothing = I.train(df.limit(0))
    assert {r["lang_pred"] for r in I.predict(df, nothing).collect()} == {"und"}
    single = I.train(df.where("lang = 'en'"))
    assert {r["lang_pred"] for r in I.predict(df.where("doc_id = 2"), single).collect()} == {"en"}


def test_sample_does_not_shuffle_texts(spark):
    df = spark.createDataFrame([(i, "xy"[i % 2], "t" * 50) for i in range(4000)], "id long, lang string, t string")
    got = I.bounded_sample(df, "lang", "id", 100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert all(60 < n < 140 for n in [got.where(f"lang = '{x}'").count() for x in "xy"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, I.bounded_sample(df.repartition(7), "lang", "id", 100).collect()))
