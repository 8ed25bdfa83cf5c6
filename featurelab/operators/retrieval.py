"""Vector retrieval and extractive summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.operators.vector_index import CELL_ROWS, VectorIndex


def centroids(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Mean vector per key: one (key, dim) partial aggregate, re-assembled
    in dimension order."""
    per_dim = (df.select(key, F.posexplode(vec).alias("i", "v"))
               .groupBy(key, "i").agg(F.avg(F.col("v").cast("double")).alias("m")))
    return per_dim.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias(vec))


def top_k_similar(corpus: DataFrame, corpus_id: str, corpus_vec: str, queries: DataFrame,
                  query_id: str, query_vec: str, k: int = 5, query_block: int = 1024,
                  corpus_block: int = CELL_ROWS) -> DataFrame:
    """Top-k corpus rows by cosine similarity for every query (K9).

    The corpus is indexed by cells around pivots and a query opens only those
    that can hold one of its k best (see ``vector_index``).  Queries proven
    few go to the tasks that scan the cells; more meet the cells in tiles of
    bounded size.  Ids keep their own type.  Zero, null and non-finite vectors
    have no score and are left out; ties go to the smaller id.
    """
    index = VectorIndex.build(corpus, corpus_id, corpus_vec, metric="cosine", cell_rows=corpus_block)
    return similar(index, queries, query_id, query_vec, corpus_id, k, query_block)


def similar(index: VectorIndex, queries: DataFrame, query_id: str, query_vec: str, corpus_id: str,
            k: int = 5, query_block: int = 1024) -> DataFrame:
    """``top_k_similar`` over an index that is there already."""
    top = index.search(queries, query_id, query_vec, k, query_block=query_block)
    return top.select(F.col("qid").alias(query_id), "rank", F.col("tid").alias(corpus_id), (-F.col("key")).alias("score"))


def citations(top: DataFrame, query_id: str, doc_id: str, extra: Sequence[str] = ()) -> DataFrame:
    """Answer assembly (K10): the ranked hits of each query as one citation
    string; at most k hits per query, so the list is bounded."""
    hits = F.array_sort(F.collect_list(F.struct("rank", doc_id, *extra)))
    return top.groupBy(query_id).agg(hits.alias("_h")).select(
        query_id, F.size("_h").alias("n_hits"),
        F.array_join(F.transform("_h", lambda h: F.concat(F.lit("["), h["rank"].cast("string"),
                                                          F.lit("] "), h[doc_id].cast("string"))),
                     " ").alias("citations"))


# Sentence and word patterns of the extractive summary (fixed values)
SENTENCE_RE = r"[^.!?]+[.!?]*"
WORD_RE = r"\p{L}+"


def lead_summary(docs: DataFrame, id_col: str, text_col: str, sentences: int = 5,
                 max_words: int = 50) -> DataFrame:
    """The first ``sentences`` sentences, cut to ``max_words`` words (K11, P24):
    a projection, each document on its own.  A text without a sentence gives
    an empty summary, a null text a null one."""
    found = F.transform(F.regexp_extract_all(F.col(text_col), F.lit(SENTENCE_RE), 0), lambda s: F.trim(s))
    lead = F.array_join(F.slice(F.filter(found, lambda s: s != ""), 1, sentences), " ")
    # the one-element explode makes the words a column, read twice below
    words = docs.select(id_col, F.explode(F.array(F.filter(F.split(lead, r"[ \t\n\r\f]+"), lambda w: w != ""))).alias("_w"))
    return words.select(id_col, F.array_join(F.slice("_w", 1, max_words), " ").alias("summary"),
                        F.least(F.size("_w"), F.lit(max_words)).alias("n_words"),
                        (F.size("_w") > max_words).alias("was_cut"))


WORDS_AT_ONCE = 100_000


def _parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``WORDS_AT_ONCE`` words each, one text at
    least: a word takes some hundred bytes while it is weighed."""
    w = b.column("w")
    # words before each text: a text's sentences, then their words
    before = w.flatten().offsets.to_numpy()[w.offsets.to_numpy() - w.offsets[0].as_py()] if len(w.flatten()) else np.zeros(b.num_rows + 1)
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(before, before[at] + WORDS_AT_ONCE, "right")) - 1)
        yield b.slice(at, end - at)
        at = end


def _summaries(n: int):
    """Arrow function from (id, sentences, words per sentence): each text's
    ``n`` sentences of the highest mean word count, in text order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in _parts(whole)):
            sents, words = b.column("s"), b.column("w")
            of_doc = np.repeat(np.arange(b.num_rows), np.diff(words.offsets.to_numpy()))
            lists = words.flatten()
            of_sent = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            code = lists.flatten().dictionary_encode()
            ids = code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            # how often a word occurs in its text, for every occurrence
            _, at, n_of = np.unique(of_doc[of_sent] * max(1, len(code.dictionary)) + ids, return_inverse=True, return_counts=True)
            total = np.bincount(of_sent, weights=n_of[at], minlength=len(lists))
            count = np.bincount(of_sent, minlength=len(lists))
            score = np.where(count > 0, total / np.maximum(count, 1), -1.0)
            order = np.lexsort((np.arange(len(lists)), -score, of_doc))
            place = np.arange(len(lists)) - np.searchsorted(of_doc, of_doc)
            first = np.zeros(len(lists), dtype=bool)
            first[order] = (place < n) & (score[order] > 0)
            text = sents.flatten().filter(pa.array(first)).to_pylist()
            cuts = np.concatenate([[0], np.cumsum(np.bincount(of_doc[first], minlength=b.num_rows))])
            out = [" ".join(text[cuts[i]:cuts[i + 1]]) or None for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.bincount(of_doc, minlength=b.num_rows).astype(np.int64)),
                                              pa.array(out, pa.string())], ["id", "n_sentences", "summary"])

    return run


def extractive_summary(docs: DataFrame, id_col: str, text_col: str, n: int = 3) -> DataFrame:
    """Top-n sentences by mean term weight, in document order.

    Term weight = how often the word occurs in the whole document.  Sentences
    and words are cut in the row and weighed batch by batch; nothing is
    shuffled.  Texts without a sentence give no row; one without a word gives
    a null summary.
    """
    cut = F.transform(F.regexp_extract_all(F.col(text_col), F.lit(SENTENCE_RE), 0), lambda s: F.trim(s))
    rows = docs.select(F.col(id_col).alias("id"), F.filter(cut, lambda s: s != "").alias("s")).where(F.size("s") > 0)
    rows = rows.select("id", "s", F.transform("s", lambda s: F.regexp_extract_all(F.lower(s), F.lit(WORD_RE), 0)).alias("w"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(_summaries(n), f"id {kind}, n_sentences long, summary string")
            .withColumnRenamed("id", id_col))
