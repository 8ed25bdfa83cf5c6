"""Sparse hashed TF-IDF vectors and their exact cosine top-k (K8, K9).

A vector is a sorted array of buckets and an array of integer weights
(term count times a thousand times the inverse document frequency, rounded), so
dot products and norms are whole numbers: equal texts score exactly alike and
any engine gets the same order.  Nothing is fitted but one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from featurelab.functions.columns import md5_prefix_int
from featurelab.session import workers_import

BUCKETS = 1 << 14
FEW_BYTES = 4 << 20  # of queries that go to the tasks that scan the corpus
CELLS = 1 << 22      # (row, query) scores that a task holds at once


def term_counts(rows: DataFrame, token_col: str, keep: list[str], buckets: int = BUCKETS,
                keep_empty: bool = False) -> DataFrame:
    """(*keep, idx array<int>, tf array<int>) of the rows that have tokens, or
    of all (``keep_empty``, then with empty arrays); a projection.  Null tokens
    do not count."""
    none = F.array().cast("array<int>")
    real = F.coalesce(F.filter(token_col, lambda t: t.isNotNull()), F.array().cast("array<string>"))
    hashed = F.array_sort(F.transform(real, lambda t: F.pmod(md5_prefix_int(t), F.lit(buckets)).cast("int")))
    # one-element explodes keep the sorted buckets and the starts of their runs as columns, read twice below
    x = rows.select(*keep, F.explode(F.array(hashed)).alias("_s"))
    if not keep_empty:
        x = x.where(F.size("_s") > 0)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_s"), F.lit(1))), lambda i: (i <= F.size("_s")) & (
        (i == 1) | (F.get("_s", i - 1) != F.get("_s", F.greatest(i - 2, F.lit(0))))))
    x = x.select(*keep, "_s", F.explode(F.array(starts)).alias("_i"))
    ends = F.concat(F.slice("_i", F.lit(2), F.size("_i")), F.array(F.size("_s") + 1))
    return x.select(*keep, F.transform("_i", lambda i: F.get("_s", i - 1)).alias("idx"),
                    F.when(F.size("_i") > 0, F.zip_with(ends, "_i", lambda e, i: e - i)).otherwise(none).alias("tf"))


def idf_weights(counts: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """For every bucket ``round(1000 * ln((N + 1) / (df + 1)))``; as many
    numbers as there are buckets reach the driver, whatever the corpus."""
    per = counts.select(F.explode(F.concat(F.array(F.lit(-1)), "idx")).alias("b")).groupBy("b").count()
    found = {r["b"]: r["count"] for r in per.collect()}
    n = found.get(-1, 0)
    rows = counts.sparkSession.createDataFrame([(b, found.get(b, 0)) for b in range(buckets)], "b int, df long")
    w = F.round(F.lit(1000.0) * F.ln(F.lit(n + 1.0) / (F.col("df") + F.lit(1.0)))).cast("long")
    return [r["w"] for r in rows.select("b", w.alias("w")).orderBy("b").collect()]


def weighted(counts: DataFrame, idf: list[int]) -> DataFrame:
    """``counts`` with w (array<long>: tf times the bucket's idf) and norm2
    (long: the sum of squares) in place of tf."""
    table = F.split(F.lit(",".join(map(str, idf))), ",").cast("array<bigint>")
    w = F.zip_with("idx", "tf", lambda i, t: t * F.get(table, i))
    keep = [c for c in counts.columns if c not in ("idx", "tf")]
    x = counts.select(*keep, "idx", F.explode(F.array(w)).alias("w"))
    return x.withColumn("norm2", F.aggregate("w", F.lit(0).cast("long"), lambda a, v: a + v * v))


def sparse_top_k(corpus: DataFrame, corpus_id: str, queries: DataFrame, query_id: str, k: int = 5,
                 few_bytes: int = FEW_BYTES) -> DataFrame:
    """(query_id, rank, corpus_id, dot, score): every query's ``k`` best rows by
    cosine among those whose cosine is above zero; both sides have idx, w and
    norm2.  Ties go to the smaller corpus id; zero vectors have no score.

    Queries proven few go to the tasks that scan the corpus, which keep ``k``
    rows per query and batch.  More queries meet the corpus by bucket in a
    join that adds up products per pair, on both sides of the exchange.
    """
    q = queries.where("norm2 > 0").select(F.col(query_id).alias("qid"), "idx", "w", F.col("norm2").alias("qn"))
    c = corpus.where("norm2 > 0").select(F.col(corpus_id).alias("cid"), "idx", "w", F.col("norm2").alias("cn"))
    size = q.agg(F.sum(F.size("idx").cast("long") * 12 + 64)).first()[0] or 0
    dots = _scan(c, q, k) if size <= few_bytes else _join(c, q)
    score = F.col("dot") / (F.sqrt(F.col("qn").cast("double")) * F.sqrt(F.col("cn").cast("double")))
    best = dots.where("dot > 0").withColumn("score", score)
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    top = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(F.col("qid").alias(query_id), "rank", F.col("cid").alias(corpus_id), "dot", "score")


def _join(c: DataFrame, q: DataFrame) -> DataFrame:
    def postings(df: DataFrame, *cols: str) -> DataFrame:
        return df.select(*cols, F.explode(F.arrays_zip("idx", "w")).alias("p")).select(*cols, "p.idx", F.col("p.w").alias(f"{cols[0]}_w"))

    return (postings(c, "cid", "cn").join(postings(q, "qid", "qn"), "idx").groupBy("qid", "qn", "cid", "cn")
            .agg(F.sum(F.col("cid_w") * F.col("qid_w")).alias("dot")))


def _scan(c: DataFrame, q: DataFrame, k: int) -> DataFrame:
    """Dot products of corpus batches with all queries at once."""
    rows = q.collect()
    workers_import(c.sparkSession)
    place = {b: i for i, b in enumerate(sorted({b for r in rows for b in r["idx"]}))}
    table = np.zeros((len(place), len(rows)), dtype=np.int64)
    for j, r in enumerate(rows):
        np.add.at(table, ([place[b] for b in r["idx"]], j), r["w"])
    known = np.array(list(place), dtype=np.int64)
    qn = np.array([r["qn"] for r in rows], dtype=np.int64)
    kinds = [x.schema[n].dataType.simpleString() for x, n in ((q, "qid"), (c, "cid"))]
    qids = [r["qid"] for r in rows]
    step = max(1, CELLS // max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows if len(known) else 0, step):
                b = whole.slice(s, step)
                idx, w = b.column("idx"), b.column("w")
                of = np.repeat(np.arange(b.num_rows), np.diff(idx.offsets.to_numpy()))
                bucket = idx.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                weight = w.flatten().to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(known, bucket), len(known) - 1)
                hit = known[at] == bucket
                of, at, weight = of[hit], at[hit], weight[hit]
                dot = np.zeros((b.num_rows, len(rows)), dtype=np.int64)
                for i in np.unique(of):
                    mine = slice(*np.searchsorted(of, [i, i + 1]))
                    dot[i] = weight[mine] @ table[at[mine]]
                cn = b.column("cn").to_numpy(zero_copy_only=False)
                score = dot / (np.sqrt(qn.astype(float)) * np.sqrt(cn.astype(float))[:, None])
                r, j = np.nonzero((dot > 0) & (score >= _kth(score, k)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([qids[x] for x in j], qtype), pa.array(qn[j]), b.column("cid").take(pa.array(r)),
                     pa.array(cn[r]), pa.array(dot[r, j])], ["qid", "qn", "cid", "cn", "dot"])

    qtype = to_arrow_type(q.schema["qid"].dataType)
    return c.mapInArrow(run, f"qid {kinds[0]}, qn long, cid {kinds[1]}, cn long, dot long")


def _kth(score: np.ndarray, k: int) -> np.ndarray:
    """Each query's ``k``-th best score of a batch; what ties with it stays."""
    if len(score) <= k:
        return np.full(score.shape[1], -np.inf)
    return np.partition(score, len(score) - k, axis=0)[len(score) - k]
