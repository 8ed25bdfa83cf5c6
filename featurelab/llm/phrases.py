"""Phrase collocations from an FM-index per shard over word ids (operator 12).

A shard is the pieces of one language that a task holds in about 8 MB of
text.  Its words become ids, a piece ends in the sentinel 0, and two
Burrows-Wheeler transforms (of the ids and of the ids reversed) answer interval
extensions in both directions at once: a phrase's interval grows by a word to
the right or left, and the phrase's extensions on a side are the distinct
symbols of its interval in that side's transform.  All intervals of one depth
are extended together in numpy.  A shard's phrases leave it dealt into buckets by
their hash, a bucket's phrases packed in one row; Spark shuffles the buckets,
whose number follows the bytes of text, and each is summed on its own.  Scores
come from joins of the phrases that are frequent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurelab.llm.common import shared_table, small_side, text_rows

SHARD_BYTES = 8 << 20
BUCKET_BYTES = 2 << 20  # of text for each bucket: about a million phrases of up to three words
#: fixed values of the operator: piece separators and word separators (bytes)
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b" \t"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_PIECE = np.isin(np.arange(256), list(PIECE_ENDS))
_SPLIT = _PIECE | np.isin(np.arange(256), list(WORD_ENDS))


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """(symbols, words): the texts' words as ids from 1 into ``words`` with the
    sentinel 0 after every piece that has words."""
    raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    split = _SPLIT[raw]
    edge = np.diff(np.concatenate([[True], split, [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, dtype=np.int64), pa.array([], pa.binary())
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    body = _LOWER[raw[~split]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.concatenate([[0], np.cumsum(_PIECE[raw], dtype=np.int64)])
    last = np.ones(len(start), dtype=bool)  # the word ends its piece
    last[:-1] = ends[start[1:]] != ends[start[:-1]]
    at = np.arange(len(ids)) + np.concatenate([[0], np.cumsum(last)[:-1]])
    symbols = np.zeros(len(ids) + int(last.sum()), dtype=np.int64)
    symbols[at] = ids
    return symbols, coded.dictionary


class Transform:
    """Burrows-Wheeler transform of symbols ending in 0, its suffixes sorted by
    their first ``depth`` symbols, which is as deep as intervals go."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, depth: int) -> None:
        n = len(symbols)
        key, keys, span = np.zeros(n, dtype=np.int64), [], 1
        for d in range(depth):
            if span * n_symbols >= 1 << 62:
                keys.append(key)
                key, span = np.zeros(n, dtype=np.int64), 1
            key = key * n_symbols
            key[:max(n - d, 0)] += symbols[d:]
            span *= n_symbols
        rows = np.argsort(key, kind="stable") if not keys else np.lexsort((key, *keys[::-1]))
        self.bwt = symbols[rows - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        by_symbol = np.argsort(self.bwt, kind="stable")
        self.width = n + 1
        self.places = self.bwt[by_symbol] * self.width + by_symbol

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where ``symbol`` before an interval that begins at ``row`` begins."""
        return np.searchsorted(self.places, symbol * self.width + row)

    def extensions(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, symbol, count, count of smaller symbols) for each
        distinct symbol before each interval, the sentinel left out."""
        of = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + low[of]
        n_symbols = len(self.first) - 1
        key = np.sort(of * n_symbols + self.bwt[rows])
        new = np.flatnonzero(np.diff(key, prepend=-1))
        count = np.diff(np.append(new, len(key)))
        interval, symbol = np.divmod(key[new], n_symbols)
        before = new - (np.cumsum(size) - size)[interval]
        real = symbol > 0
        return interval[real], symbol[real], count[real], before[real]


class BiIndex:
    """Both transforms of a shard; phrases keep an interval in each."""

    def __init__(self, symbols: np.ndarray, n_words: int, depth: int) -> None:
        self.n_symbols = n_words + 1
        self.left = Transform(symbols, self.n_symbols, depth)
        self.right = Transform(np.append(symbols[:-1][::-1], 0), self.n_symbols, depth)

    def phrases(self, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word ids as one column per word, counts) of all phrases of 1, 2,
        ... ``depth`` words, from extension to the right and left in turn."""
        words = np.arange(1, self.n_symbols)[:, None]
        low, size = self.left.first[1:-1], np.diff(self.left.first)[1:]
        back = self.right.first[1:-1]
        yield words, size
        for d in range(2, depth + 1):
            to_right = d % 2 == 0
            near, other = (back, low) if to_right else (low, back)
            index = self.right if to_right else self.left
            of, symbol, count, before = index.extensions(near, size)
            near, other, size = index.step(symbol, near[of]), other[of] + before, count
            words = np.hstack([words[of], symbol[:, None]] if to_right else [symbol[:, None], words[of]])
            low, back = (other, near) if to_right else (near, other)
            yield words, size


def shard_counts(texts: list[bytes], depth: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(phrases, counts, hashes) of a shard's phrases of each depth, then the
    number of its words under ''."""
    symbols, words = word_ids(texts)
    if not len(symbols):
        return
    names = words.cast(pa.large_binary())
    hashes = np.fromiter(map(crc_pair, words.to_pylist()), dtype=np.uint64, count=len(words))
    for ids, count in BiIndex(symbols, len(words), depth).phrases(depth):
        cols = [names.take(pa.array(ids[:, i] - 1)) for i in range(ids.shape[1])]
        phrase = cols[0] if len(cols) == 1 else pc.binary_join_element_wise(*cols, pa.scalar(b" ", pa.large_binary()))
        h = np.zeros(len(ids), dtype=np.uint64)
        for i in range(ids.shape[1]):
            h = mixed(h * np.uint64(3) + hashes[ids[:, i] - 1])
        yield phrase, count, h
    yield pa.array([b""], pa.large_binary()), np.array([int((symbols > 0).sum())]), np.zeros(1, dtype=np.uint64)


def crc_pair(word: bytes) -> int:
    """64 bits of a word that are alike in every worker."""
    return zlib.crc32(word) << 32 | zlib.adler32(word)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over the whole number (multiply and shift, twice)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def packed(lang: str, phrase: pa.Array, count: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """One row per bucket: its phrases' bytes, their lengths and their counts."""
    order = np.argsort(bucket, kind="stable")
    phrase, count, bucket = phrase.take(pa.array(order)), count[order], bucket[order]
    at = np.frombuffer(phrase.buffers()[1], dtype=np.int64)[phrase.offset:phrase.offset + len(phrase) + 1]
    new = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))

    def rows(cuts: np.ndarray, data: pa.Buffer) -> pa.Array:
        cuts = pa.py_buffer(cuts.astype(np.int32))
        return pa.BinaryArray.from_buffers(pa.binary(), len(new) - 1, [None, cuts, data])

    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[new[:-1]]), pa.array([lang]).take(pa.array(np.zeros(len(new) - 1, dtype=np.int8))),
         rows(at[new], phrase.buffers()[2]), rows(new * 4, pa.py_buffer(np.diff(at).astype(np.int32))),
         rows(new * 8, pa.py_buffer(count.astype(np.int64)))], ["bucket", "lang", "phrases", "lengths", "counts"])


def bucket_sums(rows: pa.Table, min_count: int) -> pa.Table:
    """(lang, phrase, f) of a bucket: the sums over its rows, at least
    ``min_count`` (any, for the phrase '')."""
    lang = rows.column("lang").combine_chunks().dictionary_encode()
    code, parts = lang.indices.to_pylist(), []
    for i, c in enumerate(code):
        n = np.frombuffer(rows.column("lengths")[i].as_buffer(), dtype=np.int32)
        data = rows.column("phrases")[i].as_buffer()
        cuts = pa.py_buffer(np.concatenate([[0], np.cumsum(n)]).astype(np.int64))
        parts.append(pa.table({
            "lang": pa.array(np.full(len(n), c, dtype=np.int32)),
            "phrase": pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, cuts, data]),
            "f": np.frombuffer(rows.column("counts")[i].as_buffer(), dtype=np.int64)}))
    sums = pa.concat_tables(parts).group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
    sums = sums.filter(pc.or_(pc.greater_equal(sums["f_sum"], min_count), pc.equal(pc.binary_length(sums["phrase"]), 0)))
    return pa.table({"lang": lang.dictionary.take(sums["lang"].combine_chunks()), "phrase": sums["phrase"].cast(pa.string()),
                     "f": sums["f_sum"]})


def phrase_counts(docs: DataFrame, depth: int = 3, min_count: int = 10, text_col: str = "text",
                  lang_col: str = "lang", shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(lang, phrase, n_words, f) of the phrases of up to ``depth`` words met
    at least ``min_count`` times in their language, and per language one row of
    the phrase '' with ``n_words`` 0, whose f counts all its words.

    A phrase's extensions to a side are the rows one word longer that begin
    (right) or end (left) with it.  Texts are lower-cased in A-Z; phrases do
    not cross the ends of pieces.  A null text has no words, a null language is
    ``und``; repeated rows count each time; an empty table gives no rows; other
    columns are not read.
    """
    src = text_rows(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                                F.col(text_col).cast("string").alias("t")).where("t <> ''"))
    total = src.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = np.uint64(1 + total // bucket_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                for phrase, count, h in shard_counts(held.pop(lang), depth):
                    yield packed(lang, phrase, count, (h % buckets).astype(np.int64))

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("t").to_pylist()):
                data = text.encode()
                held.setdefault(lang, []).append(data)
                size += len(data)
                if size >= shard_bytes:
                    yield from flush()
                    size = 0
        yield from flush()

    dealt = src.mapInArrow(run, "bucket long, lang string, phrases binary, lengths binary, counts binary")
    sums = dealt.groupBy("bucket").applyInArrow(lambda rows: bucket_sums(rows, min_count), "lang string, phrase string, f long")
    n_words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return sums.select("lang", "phrase", n_words.cast("int").alias("n_words"), "f")


def _words(a: object, b: object) -> object:
    """Words a..b (from 1) of ``phrase``, space-joined."""
    return F.array_join(F.slice(F.split("phrase", " "), a, b), " ")


def collocations(docs: DataFrame, depth: int = 3, min_count: int = 10, swallow_pct: int = 50, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang", row_bytes: int = 96,
                 broadcast_bytes: int = 16 << 20) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    phrases of 2 to ``depth`` words by score, count and phrase.

    A phrase's score is the least of floor(1000000 a a / (l r)) over its cuts
    into a first part met l times and a rest met r times, the shortest first
    part among equals, in exact decimals.  A phrase inside a longer one of at
    least ``swallow_pct`` percent of its count goes.  Languages, nulls and odd
    texts are as in ``phrase_counts``; ties of all but the phrase go by its
    bytes.
    """
    grams = shared_table(phrase_counts(docs, depth, min_count, text_col, lang_col), "phrases")
    cands = grams.where("n_words >= 2").withColumnRenamed("f", "a")
    # a part is met at least as often as the whole, so it is among the grams
    parts = grams.where(F.col("n_words").between(1, depth - 1)).select("lang", F.col("phrase").alias("part"), F.col("f").alias("met"))
    parts = small_side(parts, row_bytes, broadcast_bytes)
    cuts = cands.select("lang", "phrase", "n_words", "a", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", _words(1, F.col("k"))).withColumn("rest", _words(F.col("k") + 1, F.col("n_words")))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("met").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("rest"), F.col("met").alias("r")), ["lang", "rest"])
    big = [F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")]
    cuts = cuts.withColumn("a2", F.lit(1_000_000).cast("decimal(7,0)") * (big[0] * big[0])).withColumn("lr", big[1] * big[2])
    scored = (cuts.withColumn("score", F.expr("a2 div lr")).groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*"))
    inside = (cands.where("n_words >= 3")
              .select("lang", "a", "phrase", "n_words", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("m"))
              .select("lang", "a", "phrase", "m", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("m") + 1)).alias("at"))
              .select("lang", "a", _words(F.col("at"), F.col("m")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = (scored.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(swallow_pct) * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = grams.where("n_words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
