"""Repeated windows against a dictionary of all windows."""

import random

import pytest

from featurelab.llm import suffix_dedup as S

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.collect()), key=str)


def expected(rows, length):
    return sorted([(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], length))], key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(S.drop_repeats(docs, length=200)) == expected(rows, 200)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_passages(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(3, 40))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 30)))
                 for _ in range(rng.randint(0, 5))]
        texts.append(" ".join(parts))
    texts += ["ab" * 200, "x" * 500, None, "", texts[0], "short", "y" * 39, "z" * 40, "q" * 41]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(S.drop_repeats(df, length=40, digit=12)) == expected(rows, 40)


def test_hot_anchors_take_the_counted_path(spark):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh") for _ in range(70))
    rows = [(i, "".join(rng.choice("ijklmnop") for _ in range(50)) + shared[rng.randint(0, 20):]
             + "".join(rng.choice("qrstuvw") for _ in range(50))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id as k", "text as t")
    spans = {}
    for r in S.repeated_spans(df, 40, 12, bucket_rows=10).collect():
        spans.setdefault(r["k"], []).append((r["start"], r["stop"]))
    for (i, t), (_, removed, _, _) in zip(rows, brute([t for _, t in rows], 40)):
        covered = {p for a, b in spans.get(i, []) for p in range(a, b)}
        assert len(covered) == removed


def test_chunk_borders(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 100)
    rng = random.Random(9)
    data = bytes(rng.choice(b"abc") for _ in range(1000))
    a, first, last, _ = S.anchors(data, 40, 12)
    owned = [w for s, e in zip(first, last) for w in range(s, e + 1)]
    assert owned == list(range(1000 - 40 + 1))
    assert all(w <= p <= w + 28 for p, s, e in zip(a, first, last) for w in (s, e))


def test_odd_rows(spark):
    long = "abcdefghij" * 30 + "tail of it"
    rows = [(1, None), (2, ""), (None, long), (3, "x" * 199), (4, "unique " + "".join(chr(300 + i) for i in range(300))),
            (5, long[:200]), (6, "other text"), (6, "another text"), (7, "p" * 100 + "q" * 120), (7, "p" * 100 + "q" * 120)]
    df = spark.createDataFrame([(a, b, "z") for a, b in rows], "doc_id long, text string, k string")
    assert result(S.drop_repeats(df)) == expected(rows, 200)
    assert S.drop_repeats(df.limit(0)).collect() == []
