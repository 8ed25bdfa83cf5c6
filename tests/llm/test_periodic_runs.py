"""Periodic runs against brute force over all periods."""

import hashlib
import tempfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from featurelab.llm import periodic_runs as R
from featurelab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(x, min_words=24, min_periods=3):
    """Maximal stretches for each period, without those of a smaller period."""
    out, n = [], len(x)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            smallest = all(any(x[k] != x[k + d] for k in range(i, i + size - d)) for d in range(1, q))
            if size >= max(min_words, min_periods * q) and smallest:
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts, min_words=24, min_periods=3):
    return [[tuple(r) for r in runs.tolist()] for _, runs, _ in R.text_runs(texts, min_words, min_periods)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=70), min_size=1, max_size=4), st.integers(4, 26), st.integers(2, 4))
def test_two_letter_texts(docs, min_words, min_periods):
    assert found([" ".join(d) for d in docs], min_words, min_periods) == [brute(d, min_words, min_periods) for d in docs]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 12)), max_size=8))
def test_planted_repeats(parts):
    doc = [w for unit, k in parts for w in unit * k]
    assert found([" ".join(doc), "x " + " ".join(doc)]) == [brute(doc), brute(["x", *doc])]


def test_long_repeats():
    one = ["w"] * 100_000
    period = [str(i) for i in range(777)] * 60
    mixed = period[:5000] + one[:400] + period
    got = found([" ".join(one), " ".join(period), " ".join(mixed)])
    assert got[0] == [(0, 100_000, 1)] and got[1] == [(0, 777 * 60, 777)]
    assert got[2] == [(0, 5000, 777), (5000, 400, 1), (5400, 777 * 60, 777)]


def test_least_prefix():
    assert R.least_prefix(24, 3) == 16


def expected(doc_id, text):
    """The query's row by the contract's words, through brute force."""
    x = (text or "").encode().split()
    n = len(x)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    runs = brute(x)
    drop = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()),
            sha(b" ".join(w for k, w in enumerate(x) if k not in drop)))


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def test_query_on_odd_rows(spark):
    docs = [(i, t) for i, t in enumerate([None, "", " \t", "a", "a b " * 40, "\x1c\x1c \x1c x" * 30, "é é é " * 30,
                                          "one two three four five six seven"] * 12)]
    docs += [(None, "a b c " * 20), (None, None), (3, "p q r s " * 9), (3, "p q r s " * 9),
             (500, "u " * 30 + "v w " * 20 + "v w u " * 11)]
    root = tempfile.mkdtemp(prefix="runs-test-")
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "doc_id AS runs", "doc_id AS start").write.parquet(
        f"{root}/documents.parquet")
    assert rows(QUERIES["op13_periodic_runs"](spark, root)) == sorted((expected(*d) for d in docs), key=str)


def test_query_on_an_empty_table(spark):
    root = tempfile.mkdtemp(prefix="runs-test-")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    assert rows(QUERIES["op13_periodic_runs"](spark, root)) == []


def test_query_on_given_documents(spark):
    got = {r[0]: r for r in rows(QUERIES["op13_periodic_runs"](spark, SF))}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [d for d in docs if len(d["text"] or "") < 4000]
    assert len(got) == len(docs) and len(short) > 100
    assert {got[d["doc_id"]] for d in short} == {expected(d["doc_id"], d["text"]) for d in short}


def test_clashing_columns_and_batches(spark):
    df = spark.createDataFrame([(1, "a " * 30, 5, "z"), (2, "b c", 6, "y")], "doc_id long, text string, n_words int, collapsed string")
    got = {r["doc_id"]: r for r in R.collapse_runs(df, batch_words=1).collect()}
    assert got[1]["n_words"] == 30 and got[1]["collapsed"] == "a" and got[1]["text"] == "a " * 30
    assert got[2]["collapsed"] == "b c" and got[2]["runs"] == []


def test_links_are_true_prefixes():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, 300)
    d = np.zeros(300, dtype=np.int32)
    for p, q, n in zip(*R.suffix_links(d, x, 4)):
        real = 0
        while max(p, q) + real < 300 and x[p + real] == x[q + real]:
            real += 1
        assert real == n


@pytest.mark.parametrize("texts, sizes", [([None, "", "a"], [3]), (["a" * 60, "b" * 60], [1, 1]), ([], [])])
def test_batches(texts, sizes):
    assert [s.stop - s.start for s in R.batches_of_words(texts, 10)] == sizes
