"""Exact top-k inner products by a three-phase uniform threshold (operator 9).

The score of a pair is a sum of partial products, one per group of
dimensions; each group is a list of local scores.

1. Every tile (block of queries x block of rows) looks up the best entries of
   each of its local lists, completes the scores of those alone and reports the
   k best per query.  The k-th best of all reports is a score that k rows do
   reach: a safe cutoff t for the query.
2. The cutoff goes back to the tiles with the query.  A row that reaches t has
   a partial product of at least t / groups in some list, so the entries at or
   above that uniform threshold are sufficient.  Lists are opened one after
   the other; a row stays only while what it has, and the most that the
   products of the lengths of its unopened parts allow, can reach t, and while
   some list can still hold t / groups.
3. Remaining partial products are resolved exactly for the rows that stay,
   entries below t go, and the k best of each query are merged.

Scores are exact: float64 matrix products while every sum stays below 2^53,
Python integers beyond (then limited to the range of a long).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OUT = "query_id long, vec_id long, score long"
LONG_MAX = (1 << 63) - 1


def _matrix(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each vector, short ones extended by zeros."""
    m = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        m[i, :len(v)] = np.floor(np.asarray(v, dtype=np.float64) * scale)
    return m


def _exact(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The matrices as they are while every sum of products stays below 2^53,
    else of Python integers."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2.0 ** 53:
        return q, c
    return tuple(np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (q, c))


def _cuts(width: int, groups: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, width, groups + 1).astype(int)
    return list(zip(cuts, cuts[1:]))


def partial_products(q: np.ndarray, c: np.ndarray, groups: int) -> list[np.ndarray]:
    """One (queries, rows) matrix of exact partial products per group."""
    q, c = _exact(q, c)
    return [np.asarray(q[:, a:b] @ c[:, a:b].T) for a, b in _cuts(q.shape[1], groups)]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def part_lengths(m: np.ndarray, groups: int) -> np.ndarray:
    """Length of each row's part in each group, rounded up."""
    m = m.astype(np.float64)
    return np.stack([np.sqrt((m[:, a:b] ** 2).sum(1)) for a, b in _cuts(m.shape[1], groups)], axis=1) * (1 + 1e-12)


def resolve(q: np.ndarray, c: np.ndarray, groups: int, q_len: np.ndarray, c_len: np.ndarray,
            cutoff: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows, scores, partial products computed): the rows that reach
    ``cutoff``, with their exact scores, of one query."""
    at, computed, seen = None, 0, False  # at: the rows that stay, None for all
    score, room = 0, q_len * c_len  # room: the most that a list can hold for a row
    for g, (a, b) in enumerate(_cuts(c.shape[1], groups)):
        x = np.asarray((c[:, a:b] if at is None else c[at, a:b]) @ q[a:b])
        computed += len(x)
        score, seen = score + x, seen | (x * groups >= cutoff)
        if g + 1 < groups:
            left = room[:, g + 1:] if at is None else room[at, g + 1:]
            most = score + (left.sum(1) * (1 + 1e-12) + 1)
            if c.dtype == object:
                most = most + np.abs(score).astype(np.float64) * 1e-12
            stay = ((most >= cutoff) & (seen | ((left.max(1) * (1 + 1e-12) + 1) * groups >= cutoff))).astype(bool)
            if not stay.all():
                at = np.flatnonzero(stay) if at is None else at[stay]
                score, seen = score[stay], seen[stay]
    keep = np.flatnonzero((seen & (score >= cutoff)).astype(bool))
    return keep if at is None else at[keep], score[keep], computed


def _tile(k: int, groups: int, scale: int, second: bool):
    """Phase 1 of one tile, or with ``second`` phases 2 and 3."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            width = max(max(map(len, queries["q"])), max(map(len, rows["v"])))
            rows_, cid = _matrix(rows["v"], width, scale), rows["vec_id"].to_numpy(np.int64)
            c_len = part_lengths(rows_, groups) if second else None
            for s in range(0, len(queries), 128):
                part = queries.iloc[s:s + 128]
                qid = part["query_id"].to_numpy(np.int64)
                q, c = _exact(_matrix(part["q"], width, scale), rows_)
                q_len = part_lengths(q, groups) if second else None
                lists = None if second else [np.asarray(q[:, a:b] @ c[:, a:b].T) for a, b in _cuts(width, groups)]
                for r in range(len(part)):
                    other = cid != qid[r]
                    if second and part["enough"].iloc[r]:
                        at, score, _ = resolve(q[r], c, groups, q_len[r], c_len, int(part["cutoff"].iloc[r]))
                        at, score = at[other[at]], score[other[at]]
                    elif second:
                        at = np.flatnonzero(other)
                        score = np.asarray(c[at] @ q[r])
                    else:
                        near = np.flatnonzero(other)
                        picks = [near if len(near) <= k else near[np.argpartition(-x[r][near], k - 1)[:k]]
                                 for x in lists]
                        at = np.unique(np.concatenate(picks))
                        score = np.asarray(c[at] @ q[r])
                    first = _best(score, cid[at], k)
                    out["query_id"] += [qid[r]] * len(first)
                    out["vec_id"] += cid[at[first]].tolist()
                    out["score"] += [max(-LONG_MAX - 1, min(LONG_MAX, int(v))) for v in score[first]]
        return pd.DataFrame(out).astype("int64")

    return run


def usable(v: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 256, groups: int = 4,
          query_block: int = 1024, row_block: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` best other rows
    by the integer inner product of floor(scale * x); fewer if there are not
    as many; ties go to the smaller id.

    Rows whose id is null, or whose vector is null or holds a null, NaN or
    infinite component, take no part.  Vectors of different length meet as if
    the shorter ended in zeros.  If an id is repeated, its smallest vector is
    the query, rows of that id are not candidates for it, and for other
    queries each such row is one.  An empty table gives an empty result.
    """
    v = (vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
         .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), is_query.alias("_q")))
    queries = v.where("_q").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    sizes = v.agg(F.count(F.lit(1)).alias("n"), F.count_if("_q").alias("q")).first()
    q_blocks = max(1, math.ceil(sizes["q"] / query_block))
    r_blocks = max(1, math.ceil(sizes["n"] / row_block))
    # rows are dealt by their place in the scan, so copies of one id or vector
    # spread over all blocks
    rows = (v.withColumn("rb", F.pmod(F.monotonically_increasing_id(), F.lit(r_blocks)).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
            .select("qb", "rb", "vec_id", "v"))

    def over_tiles(q: DataFrame, second: bool) -> DataFrame:
        dealt = (q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int"))
                 .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1)))))
        return (dealt.groupBy("qb", "rb").cogroup(rows.groupBy("qb", "rb"))
                .applyInPandas(_tile(k, groups, scale, second), OUT))

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    reports = over_tiles(queries, False).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    cutoffs = reports.groupBy("query_id").agg(F.min("score").alias("cutoff"),
                                              ((F.count(F.lit(1)) == k)
                                               & (F.min("score") > -LONG_MAX - 1)).alias("enough"))
    ready = queries.join(cutoffs, "query_id", "left").select(
        "query_id", "q", F.coalesce("cutoff", F.lit(0)).alias("cutoff"),
        F.coalesce("enough", F.lit(False)).alias("enough"))
    return (over_tiles(ready, True).withColumn("rank", F.row_number().over(best).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
