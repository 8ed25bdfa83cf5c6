"""Summaries weigh a bounded number of words at a time."""

import pyarrow as pa

from featurelab.operators import retrieval as R


def _batch(texts):
    words = [[s.split() for s in t] for t in texts]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.list_(pa.string())),
                                       pa.array(words, pa.list_(pa.list_(pa.string())))], ["id", "s", "w"])


TEXTS = [[f"w{i % 7} w{j} x" for j in range(1 + i % 5)] for i in range(200)] + [["..."], ["a a", "b", "a c"]]


def test_parts_hold_few_words_and_every_text():
    for b in (_batch(TEXTS), _batch(TEXTS).slice(13, 90)):
        R_words, R.WORDS_AT_ONCE = R.WORDS_AT_ONCE, 30
        try:
            parts = list(R._parts(b))
        finally:
            R.WORDS_AT_ONCE = R_words
        assert all(p.num_rows == 1 or sum(len(s) for t in p.column("w").to_pylist() for s in t) <= 30 for p in parts)
        assert [x for p in parts for x in p.column("id").to_pylist()] == b.column("id").to_pylist()


def test_parts_give_the_same_summaries():
    b = _batch(TEXTS)

    def run(words):
        R_words, R.WORDS_AT_ONCE = R.WORDS_AT_ONCE, words
        try:
            return pa.Table.from_batches(R._summaries(2)(iter([b, b.slice(5, 0), b.slice(3, 40)]))).to_pylist()
        finally:
            R.WORDS_AT_ONCE = R_words

    assert run(1) == run(30) == run(10**9)
