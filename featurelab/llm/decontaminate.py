"""Benchmark decontamination (operator 8): a BM25 inverted index of the test
items, asked by every training passage through block-max WAND, then an overlap
check of question and answer.

* Index.  A test item's first line is the question, the rest the answer.
  Term impacts are BM25 and divided by the item's own score, so an item
  scores 1 against a passage that holds all of its terms, and one threshold
  serves all items.  Posting lists are cut into blocks of items; each (term,
  block) keeps its largest impact.
* Query.  A training passage is a run of twice the longest item's words; runs
  overlap by half, so every place where an item could stand lies in one
  passage.  The terms' block maxima, summed, bound the score of every item of
  a block; blocks below the threshold are skipped, the items of the rest are
  scored exactly.  Every item at or above the threshold is retrieved.
* Check.  Five-word shingles of the question and of the answer (a shorter part as
  a whole) must be in the passage: ``min_overlap`` of both together, ``min_part`` of each.

Document frequencies and the mean length are counted over all items in Spark.
The index itself goes to the workers in parts of at most ``part_bytes`` of item
text, one pass over the documents each, so a task's memory does not grow with
the benchmark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.llm.bpe import ranges
from featurelab.llm.common import text_rows

WORD = re.compile(r"\w+")
K1, B = 1.2, 0.75  # the usual BM25 constants
BLOCK = 8          # items per block
SHINGLE = 5


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(words: list[str], n: int = SHINGLE) -> set[tuple]:
    """The n-word shingles of a list that has n words, else none."""
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def part_shingles(text: str) -> set[tuple]:
    """Five-word shingles of a question or an answer; a shorter one is one
    shingle of all its words, an empty one has none."""
    words = words_of(text)
    return shingles(words, min(SHINGLE, len(words)))


@dataclass
class Index:
    items: list                 # item ids
    question: list              # shingle sets
    answer: list
    term: dict                  # term -> number
    post_start: np.ndarray      # postings of each term: (item, impact)
    post_item: np.ndarray
    post_impact: np.ndarray
    block_start: np.ndarray     # block maxima of each term: (block, impact)
    block_no: np.ndarray
    block_max: np.ndarray
    longest: int                # words of the longest item of the whole benchmark

    @property
    def blocks(self) -> int:
        return -(-len(self.items) // BLOCK)


def build_index(items: list[tuple], df: dict, n_items: int, mean_words: float, longest: int) -> Index:
    """Index of one part: ``items`` are (id, text); the statistics are those
    of the whole benchmark."""
    kept, posts = [], []
    for item, text in sorted(items, key=lambda x: (str(x[0]), x[1] or "")):
        words = words_of(text)
        if not words:
            continue
        tf = Counter(words)
        norm = K1 * (1 - B + B * len(words) / mean_words)
        w = {t: np.log1p((n_items - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + norm) for t, c in tf.items()}
        own = sum(w.values())
        posts += [(t, len(kept), x / own) for t, x in w.items()]
        question, _, answer = text.partition("\n")
        kept.append((item, part_shingles(question), part_shingles(answer)))
    term = {t: i for i, t in enumerate(sorted({t for t, _, _ in posts}))}
    t = np.array([term[p[0]] for p in posts], dtype=np.int64)
    i = np.array([p[1] for p in posts], dtype=np.int64)
    x = np.array([p[2] for p in posts], dtype=np.float64)
    order = np.lexsort((i, t))
    t, i, x = t[order], i[order], x[order]
    start = np.searchsorted(t, np.arange(len(term) + 1))
    blocks = max(1, -(-len(kept) // BLOCK))
    cell, which = np.unique(t * blocks + i // BLOCK, return_inverse=True)
    top = np.zeros(len(cell))
    np.maximum.at(top, which, x)
    return Index([k[0] for k in kept], [k[1] for k in kept], [k[2] for k in kept], term, start, i, x,
                 np.searchsorted(cell // blocks, np.arange(len(term) + 1)), cell % blocks, top, longest)


def wand(index: Index, passage: np.ndarray, term: np.ndarray, n_passages: int,
         threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, score) of all pairs that reach the threshold, from the
    distinct (passage, term) pairs, sorted by passage."""
    nb = index.blocks
    found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    step = max(1, 2_000_000 // nb)  # passages at a time: bounds the table of sums
    for lo in range(0, n_passages, step):
        a, b = np.searchsorted(passage, (lo, lo + step))
        p, t = passage[a:b] - lo, term[a:b]
        if not len(p):
            continue
        n = index.block_start[t + 1] - index.block_start[t]
        at = ranges(index.block_start[t], n)
        size = int(p[-1]) + 1
        bound = np.bincount(np.repeat(p, n) * nb + index.block_no[at], weights=index.block_max[at], minlength=size * nb)
        open_ = (bound >= threshold - 1e-9).reshape(size, nb)
        live = np.flatnonzero(open_.any(1))
        if not len(live):
            continue
        keep = np.isin(p, live)
        p, t = p[keep], t[keep]
        n = index.post_start[t + 1] - index.post_start[t]
        at = ranges(index.post_start[t], n)
        who, item = np.repeat(p, n), index.post_item[at]
        inside = open_[who, item // BLOCK]
        who, item, x = who[inside], item[inside], index.post_impact[at][inside]
        pair, which = np.unique(who * len(index.items) + item, return_inverse=True)
        score = np.bincount(which, weights=x, minlength=len(pair))
        hit = score >= threshold - 1e-9
        found.append((pair[hit] // len(index.items) + lo, pair[hit] % len(index.items), score[hit]))
    return tuple(np.concatenate(x) for x in zip(*found))


def found_in(part: set, words: list[str]) -> int:
    """How many shingles of ``part`` (all of one length) the words hold."""
    return len(part & shingles(words, len(next(iter(part))))) if part else 0


def is_leak(question: set, answer: set, words: list[str], min_overlap: float,
            min_part: float) -> tuple[bool, float, float]:
    """(verified, question overlap, answer overlap) of an item in a passage;
    a part without a word does not count."""
    q, a = found_in(question, words), found_in(answer, words)
    both = len(question) + len(answer)
    qo, ao = (n / len(part) if part else 1.0 for n, part in ((q, question), (a, answer)))
    return bool(both) and (q + a) / both >= min_overlap and min(qo, ao) >= min_part, qo, ao


def search_texts(index: Index, texts: list, threshold: float, min_overlap: float,
                 min_part: float) -> list[list[tuple]]:
    """For each text its verified (item, score, question overlap, answer
    overlap), the best passage of each item."""
    half = max(SHINGLE, index.longest)
    look = index.term.get
    out: list[list[tuple]] = [[] for _ in texts]
    if not index.items:
        return out
    lists, firsts, owners, codes = [], [], [], []
    base = 0
    for d, text in enumerate(texts):
        words = words_of(text)
        lists.append(words)
        firsts.append(base)
        if not words:
            continue
        t = np.fromiter((look(w, -1) for w in words), np.int64, len(words))
        slot = np.arange(len(words)) // half
        n = int(slot[-1]) + 1
        known = t >= 0
        t, slot = t[known], slot[known]
        # passage j holds the half-runs j and j + 1
        for into in (slot, slot - 1):
            ok = (into >= 0) & (into < max(1, n - 1))
            codes.append((into[ok] + base) * len(index.term) + t[ok])
        owners += [d] * max(1, n - 1)
        base += max(1, n - 1)
    pairs = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
    found = wand(index, pairs // len(index.term), pairs % len(index.term), base, threshold)
    best: dict[tuple, tuple] = {}
    for p, i, s in zip(*(x.tolist() for x in found)):
        d = owners[p]
        lo = (p - firsts[d]) * half
        sure, qo, ao = is_leak(index.question[i], index.answer[i], lists[d][lo:lo + 2 * half], min_overlap, min_part)
        if sure:
            new = (s, qo, ao)
            if new > best.get((d, i), (-1.0,)):
                best[d, i] = new
    for (d, i), (s, qo, ao) in sorted(best.items()):
        out[d].append((index.items[i], s, qo, ao))
    return out


def index_parts(bench: DataFrame, item_col: str = "item_id", text_col: str = "text",
                part_bytes: int = 8 << 20) -> Iterator[Index]:
    """The index in parts of about ``part_bytes`` of item text, one by one.
    Items without a word, or with a null id or text, are not indexed."""
    items = bench.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(item_col).alias("item"), F.col(text_col).alias("t"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(w, 1, n) for t in b["t"] for ws in [words_of(t)] for w, n in
                    [*((w, 0) for w in set(ws)), *([("", len(ws))] if ws else [])]]
            yield pd.DataFrame(rows, columns=["w", "df", "n"]).astype({"w": object, "df": "int64", "n": "int64"})

    terms = (items.mapInPandas(count, "w string, df long, n long").groupBy("w")
             .agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.max("n").alias("longest")))
    total = terms.where("w = ''").first()
    if total is None:
        return
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    numbered = items.withColumn("part", F.pmod(F.xxhash64("item", "t"), F.lit(parts)))

    def vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"w": sorted({w for t in b["t"] for w in words_of(t)})}, dtype=object)

    for k in range(parts):
        mine = numbered.where(F.col("part") == k)
        known = mine.mapInPandas(vocabulary, "w string").distinct()
        df = {r["w"]: r["df"] for r in terms.join(known, "w").select("w", "df").collect()}
        yield build_index([(r["item"], r["t"]) for r in mine.select("item", "t").collect()],
                          df, total["df"], total["n"] / total["df"], total["longest"])


def find_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", bench_text_col: str = "text", threshold: float = 0.5,
               min_overlap: float = 0.8, min_part: float = 0.5, part_bytes: int = 8 << 20) -> DataFrame:
    """(id_col, item_col, score, question_overlap, answer_overlap): one row per
    document row and test item found in it, from all whole texts.

    Null, empty and wordless texts or items match nothing.  Repeated rows
    report each; equal items under several ids report each id.  Without items
    or documents the result is empty.  Other columns are not read.
    """
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")))
    kind = src.schema["id"].dataType.simpleString()
    item_kind = bench.schema[item_col].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, score double, question_overlap double, answer_overlap double"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in index_parts(bench, item_col, bench_text_col, part_bytes):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, batch.num_rows, 500):
                    b = batch.slice(s, 500)
                    hits = search_texts(index, b.column("t").to_pylist(), threshold, min_overlap, min_part)
                    rows = [(k, *h) for k, of in zip(b.column("id").to_pylist(), hits) for h in of]
                    if rows:
                        cols = list(zip(*rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cols[0], b.column("id").type), pa.array(cols[1]),
                             *(pa.array(c, pa.float64()) for c in cols[2:])],
                            ["id", "item", "score", "question_overlap", "answer_overlap"])

        out = out.unionByName(src.mapInArrow(run, schema))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score",
                      "question_overlap", "answer_overlap")


def drop_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", bench_text_col: str = "text", threshold: float = 0.5,
               min_overlap: float = 0.8, min_part: float = 0.5, part_bytes: int = 8 << 20) -> DataFrame:
    """The input rows, all columns, that hold no test item, judged row by row."""
    out = text_rows(docs)
    for index in index_parts(bench, item_col, bench_text_col, part_bytes):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, batch.num_rows, 500):
                    b = batch.slice(s, 500)
                    hits = search_texts(index, b.column(text_col).to_pylist(), threshold, min_overlap, min_part)
                    yield b.filter(pa.array([not h for h in hits], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
