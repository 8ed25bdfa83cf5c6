"""BPE against the tokenizers library on the same vocabulary file."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from featurelab.llm import bpe

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", None, " \n\t ", "<|endoftext|> Hello<|startoftext|>x<|endoftext|>", "ΣΑΣ ΌΣΟΣ. ΣΣΣ",
        "I'm don't we'll 'S it'S aaaa aaaaaaaaaaaaa", "日本語 テスト 123 ４５ ½", "é İstanbul ﬁ",
        "a\x1cb\x85c d​e \x00 z", "🙂🙂🙂👩‍👩‍👧 " + "x" * 3000 + " " + "ab" * 5000, "<|endoftext|",
        "...!!!'''s''t'", "ͅΙ", "́a", "٣ ⅷ Ⅷ ²³", "AA" * 20_000 + " b"]


@pytest.fixture(scope="module")
def both():
    return bpe.load(PATH), Tokenizer.from_file(PATH)


def check(both, texts):
    mine, library = both
    for t, ids in zip(texts, mine.encode_batch(texts)):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert ids.tolist() == want
        assert mine.decode(ids.tolist()) == library.decode(want, skip_special_tokens=False)


def test_hard_texts(both):
    check(both, HARD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"])), max_size=5))
def test_any_text(both, texts):
    # letters newer than the library's Unicode tables may be classed otherwise
    check(both, [t for t in texts if all(ord(c) < 0x2E80 for c in t)])


def test_cache_restart_gives_the_same(both, monkeypatch):
    mine, _ = both
    before = mine.encode_batch(HARD)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 0)
    assert all(np.array_equal(a, b) for a, b in zip(before, mine.encode_batch(HARD)))


def test_documents(spark, both):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    library = both[1]
    got = {r["doc_id"]: r for r in bpe.encode_decode(docs, PATH, slice_bytes=5000).collect()}
    for r in docs.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        out = got[r["doc_id"]]
        assert out["n_tokens"] == len(ids)
        assert out["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    ids = bpe.encode(docs, PATH)
    text = {r["doc_id"]: r["text"] for r in bpe.decode(ids, PATH).collect()}
    assert {k: hashlib.sha256(v.encode()).hexdigest() for k, v in text.items()} == {
        k: r["decoded_sha256"] for k, r in got.items()}


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "two words", None), (2, "two words", None)],
                               "doc_id long, text string, ids string")
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in bpe.encode_decode(df, PATH).collect())
    assert got == [("1", 0), ("2", 2), ("2", 2), ("None", 0)]
    assert bpe.encode_decode(df.limit(0), PATH).collect() == []
    assert bpe.encode(df.limit(0), PATH).collect() == []
