"""Collocations against brute force; the bidirectional index against counting."""

import collections
import re
import tempfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from featurelab.llm import phrases as P
from featurelab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs, depth=3):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, depth + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(docs, depth=3, min_count=10, top=2000):
    f, n = counted(docs, depth)
    cands = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= min_count}
    longest = collections.Counter()
    for (lang, w), c in cands.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    longest[lang, w[i:j]] = max(longest[lang, w[i:j]], c)
    out = collections.defaultdict(list)
    for (lang, w), a in cands.items():
        if 100 * longest[lang, w] >= 50 * a:
            continue
        score, k = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rs in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(rs)[:top]))


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abAé ,\n\t", max_size=60), max_size=5), st.integers(1, 5))
def test_index_counts(texts, depth):
    f, n = counted([("x", t) for t in texts], depth)
    want = {" ".join(w): c for (_, w), c in f.items()} | ({"": n["x"]} if n["x"] else {})
    got = {p.decode(): c for ps, cs, _ in P.shard_counts([t.encode() for t in texts], depth)
           for p, c in zip(ps.to_pylist(), cs.tolist())}
    assert got == want


def test_deep_keys_are_packed_in_several_numbers():
    rng = np.random.default_rng(1)
    symbols = np.append(rng.integers(0, 1 << 20, 400), 0)
    symbols[200:399] = symbols[:199]
    deep = P.Transform(symbols, 1 << 20, 8)
    rows = sorted(range(401), key=lambda i: [*symbols[i:i + 8], 0, 0, 0, 0, 0, 0, 0][:8])
    assert [int(x) for x in deep.bwt] == [int(symbols[i - 1]) for i in rows]


def test_a_phrase_has_one_hash_in_all_shards():
    one, two = ({p: h for ps, _, hs in P.shard_counts([t], 3) for p, h in zip(ps.to_pylist(), hs.tolist())}
                for t in (b"a b c d", b"x d. a b c"))
    assert all(one[p] == two[p] for p in (b"a", b"a b", b"b c", b"a b c", b"d")) and one[b"a b"] != one[b"b c"]


def test_both_intervals_stay_in_step():
    symbols, words = P.word_ids([b"a b a b c. a b a c, b a b"])
    index = P.BiIndex(symbols, len(words), 4)
    grown = list(index.phrases(4))
    assert all((s > 0).all() for _, s in grown)
    assert sum(s.sum() for _, s in grown) == 12 + 9 + 6 + 3


DOCS = [("en", "New York. new york, new York in fall! of the of the new york " * 5), (None, "x y z " * 12), ("en", None),
        ("en", ""), ("de", " ;.\t! "), (None, None), ("fr", "é è\x0bé è\x0cé è é " * 11), ("en", "of the " * 400),
        ("en", "of the " * 400), ("zz", "rare words only"), ("en", "A B c\x1cd " * 10), ("", "p q " * 11)]


def given_tables(spark, docs):
    root = tempfile.mkdtemp(prefix="phrases-test-")
    spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "text AS phrase", "lang AS f").write.parquet(
        f"{root}/documents.parquet")
    return root


def test_query_on_odd_rows(spark):
    assert rows(QUERIES["op12_phrases"](spark, given_tables(spark, DOCS))) == brute(DOCS)


def test_query_on_an_empty_table(spark):
    assert rows(QUERIES["op12_phrases"](spark, given_tables(spark, []))) == []


def test_query_on_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert rows(QUERIES["op12_phrases"](spark, SF)) == brute(docs)


@pytest.mark.parametrize("broadcast_bytes", [16 << 20, 0])
def test_deeper_phrases_ties_and_small_shards(spark, broadcast_bytes):
    rng = np.random.default_rng(3)
    docs = [("x", " ".join(rng.choice(list("abc"), 60))) for _ in range(30)]
    df = spark.createDataFrame(docs, "lang string, text string")
    got = P.collocations(df, depth=4, min_count=3, top=25, broadcast_bytes=broadcast_bytes)
    assert rows(got) == brute(docs, depth=4, min_count=3, top=25)
    parts = P.phrase_counts(df, 2, 3, shard_bytes=100, bucket_bytes=90).collect()
    whole = P.phrase_counts(df, 2, 3).collect()
    assert sorted(map(tuple, parts)) == sorted(map(tuple, whole))
