"""Distributed ranks and prefix sums (H1).

A window with an ``orderBy`` and no (or a low-cardinality) ``partitionBy``
sends every row of a partition key to one task.  Here the order key is cut
into buckets first; rows are numbered inside (key, bucket) and each bucket
adds the size of the buckets before it.  The per-bucket counts are a small
table (keys x buckets) and nothing is collected.  The number of buckets
follows the number of rows, so a bucket stays one task's work at any size.

NULL keys, buckets and order values are values like any other: NULLs sort
first and form their own group, and no row is lost.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelab.session import materialize

ROWS_PER_BUCKET = 500_000


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, math.ceil(rows / rows_per_bucket))


def _bucket_offsets(df: DataFrame, keys: Sequence[str], bucket: str,
                    values: dict[str, Column]) -> DataFrame:
    """Per (keys, bucket): totals of ``values`` in all earlier buckets
    (``_off_<v>``) and in the whole key (``_tot_<v>``)."""
    agg = df.groupBy(*keys, bucket).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    w = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*keys)
    return agg.select(*[F.col(k).alias(f"_o_{k}") for k in [*keys, bucket]],
                      *[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"_off_{n}") for n in values],
                      *[F.sum(n).over(wt).alias(f"_tot_{n}") for n in values])


def _with_offsets(df: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the bucket totals back; NULL keys meet NULL keys."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    return df.join(offsets, same, "inner").drop(*[f"_o_{k}" for k in keys])


def bucketed_row_number(df: DataFrame, keys: Sequence[str], bucket: Column,
                        order: Sequence[Column], out: str = "rank",
                        size_col: str | None = None) -> DataFrame:
    """1-based row number within ``keys`` ordered by ``order``.

    ``bucket`` must be monotone in ``order`` (every row of bucket b sorts
    before every row of bucket b+1, a NULL bucket first).  The window runs
    per (keys, bucket), so a key holding a third of all rows is spread over
    its buckets.
    """
    b = "_bucket"
    df = df.withColumn(b, bucket)
    offsets = _bucket_offsets(df, keys, b, {"n": F.lit(1).cast("bigint")})
    w = Window.partitionBy(*keys, b).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w))
    out_df = (_with_offsets(ranked, offsets, [*keys, b])
              .withColumn(out, (F.col("_off_n") + F.col("_rn")).cast("bigint")))
    if size_col:  # rows in the whole key, from the same small table
        out_df = out_df.withColumn(size_col, F.col("_tot_n").cast("bigint"))
    return out_df.drop(b, "_rn", "_off_n", "_tot_n")


def bucketed_running_sums(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column],
                          values: dict[str, Column]) -> DataFrame:
    """Per-key running totals over all *earlier* rows (exclusive), e.g. how
    many user turns came before this one (A16), computed like
    ``bucketed_row_number``: a window inside (key, bucket) plus the totals of
    earlier buckets from the small (key x bucket) table.  Adds one column
    per entry of ``values`` (name -> per-row amount)."""
    b = "_bucket"
    d = df.withColumn(b, bucket).withColumns({f"_x_{n}": v for n, v in values.items()})
    offsets = _bucket_offsets(d, keys, b, {n: F.col(f"_x_{n}") for n in values}).drop(
        *[f"_tot_{n}" for n in values])
    w = Window.partitionBy(*keys, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({f"_in_{n}": F.coalesce(F.sum(f"_x_{n}").over(w), F.lit(0)) for n in values})
    out = _with_offsets(d, offsets, [*keys, b])
    return out.select(*df.columns, *[(F.col(f"_off_{n}") + F.col(f"_in_{n}")).cast("bigint").alias(n)
                                     for n in values])


def hash_rank(df: DataFrame, keys: Sequence[str], h: str, tie: str,
              resolution: int = 1_000_000, buckets: int | None = None,
              out: str = "rank", size_col: str | None = None) -> DataFrame:
    """Rank within ``keys`` by (h, tie) where h is uniform in [0, resolution).

    Hash values are uniform, so equal-width buckets of h are equal-sized.
    Rows with a NULL h (a NULL row key) come first.
    """
    buckets = buckets or buckets_for(df.count())
    width = max(1, resolution // buckets)
    return bucketed_row_number(df, keys, F.floor(F.col(h) / F.lit(width)).cast("bigint"),
                               [F.col(h), F.col(tie)], out, size_col)


def with_range_bucket(df: DataFrame, order: Sequence[str], buckets: int | None = None) -> tuple[DataFrame, int]:
    """(``df`` with a ``_range`` column, number of ranges): range partitions
    of ``order``, numbered in order.  The rows are written once (reliable
    checkpoint), so every later read sees the same cut; a table of one range
    is returned as it is."""
    buckets = buckets or buckets_for(df.count())
    if buckets == 1:
        return df.withColumn("_range", F.lit(0)), 1
    return materialize(df.repartitionByRange(buckets, *order).withColumn("_range", F.spark_partition_id())), buckets


def range_rank(df: DataFrame, order: Sequence[str], out: str = "rank", keys: Sequence[str] = (),
               buckets: int | None = None) -> DataFrame:
    """1-based row number over all rows (or within ``keys``) by ``order``,
    ascending, NULLs first; no window holds more than one range's rows."""
    d, n = with_range_bucket(df, [*keys, *order], buckets)
    by = [F.col(c) for c in order]
    if n == 1:
        return d.withColumn(out, F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*by)).cast("bigint")) \
            .drop("_range")
    return bucketed_row_number(d, keys, F.col("_range"), by, out).drop("_range")


def prefix_sums(df: DataFrame, order: str, values: Sequence[str], buckets: int | None = None,
                inclusive: bool = False) -> DataFrame:
    """Running totals of ``values`` over rows sorted by ``order`` (global).

    Rows with equal ``order`` must already be combined (one row per value),
    e.g. a ``groupBy(score)`` before an exact ROC AUC.  Adds ``cum_<v>``
    holding the sum over strictly smaller (or, if inclusive, <=) values.
    """
    d, n = with_range_bucket(df, [order], buckets)
    b = "_range"
    frame = (Window.unboundedPreceding, 0) if inclusive else (Window.unboundedPreceding, -1)
    w = Window.partitionBy(b).orderBy(order).rowsBetween(*frame)
    inside = d.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in values})
    if n == 1:
        return inside.select(*df.columns, *[F.col(f"_in_{v}").alias(f"cum_{v}") for v in values])
    offsets = _bucket_offsets(d, [], b, {v: F.col(v) for v in values}).drop(*[f"_tot_{v}" for v in values])
    return _with_offsets(inside, offsets, [b]).select(
        *df.columns, *[(F.col(f"_off_{v}") + F.col(f"_in_{v}")).alias(f"cum_{v}") for v in values])
