"""Exact k-nearest neighbours (T6, F10) over the partitioned vector index.

``vector_index`` opens only the cells that the triangle inequality cannot rule
out, so the work follows the spread of the data: clustered vectors meet few
others, and in the worst case every (query, vector) tile of an exact search is
opened, each of bounded size.  No pair table is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.operators.vector_index import CELL_ROWS, FEW_BYTES, VectorIndex


def nearest(queries: DataFrame, corpus: DataFrame, k: int, exclude_self: bool = False,
            query_block_rows: int = 1024, corpus_block_rows: int = CELL_ROWS,
            group: str | None = None, few_bytes: int = FEW_BYTES) -> DataFrame:
    """(qid, tid, dist, tlabel, rank): k nearest corpus rows per query
    (Euclidean), ties by smaller id.

    ``queries``: (id, v array<double>[, group]); ``corpus``: (id, v, label[,
    group]).  With ``group`` only rows of the same group are candidates (e.g.
    same-class neighbours for SMOTE); null is a group too.  Rows whose vector
    is null or holds a null or non-finite value take no part.
    """
    index = VectorIndex.build(corpus, "id", "v", "label", group, cell_rows=corpus_block_rows)
    return index.search(queries, "id", "v", k, group, exclude_self, query_block_rows, few_bytes).withColumnRenamed("key", "dist")


def knn_classify(train: DataFrame, test: DataFrame, k: int = 5) -> DataFrame:
    """Majority vote of the k nearest training rows (T6); a tied vote goes
    to the lowest label."""
    nn = nearest(test, train, k)
    votes = nn.groupBy("qid", "tlabel").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("qid").agg(F.min_by("tlabel", F.struct((-F.col("n")).alias("m"), F.col("tlabel")))
                                    .alias("prediction"))
    return best.withColumnRenamed("qid", "id")
