"""Token counts against the libraries, whole texts at once."""

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from featurelab.llm import token_count as T

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["", None, " ", "a  b", " lead", "trail ", "a\nb c\td", "<s> hi </s>", "▁ ▁a b▁ c", "x y " * 300,
        "word" * 900, "1 2 3 4 5 " * 100, "日本 語 a b c d", "é è ê a b c", "　a b", "a\x00b c d e f"]


@pytest.mark.parametrize("max_chars", [8, 60, 16_384])
def test_split_texts_count_alike(spark, max_chars):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = HARD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    got = T.count_batch(texts, MODEL, max_chars, 1000)
    assert got.tolist() == [len(sp.encode(t or "")) for t in texts]


def test_json_vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    assert T.count_batch(HARD, path, 8, 1000).tolist() == [len(tk.encode(t or "", add_special_tokens=False).ids) for t in HARD]


def test_pieces_join_to_the_text():
    t = "some words here, and (others) there " * 50
    pieces = T.split_safely(t, 40)
    assert " ".join(pieces) == t and len(pieces) > 20


def test_table(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "é a", 9), (3, "a " * 5000, 9), (3, "a " * 5000, 9)],
                               "doc_id long, text string, n_tokens long")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in T.token_counts(df, MODEL).collect()), key=str)
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (None, 4, 2, False), (3, 10000, 5001, True),
                          (3, 10000, 5001, True)], key=str)
    assert T.token_counts(df.limit(0), MODEL).collect() == []
