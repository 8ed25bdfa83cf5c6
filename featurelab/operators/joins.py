"""Joins (J-group): size-checked lookups, slices, anti-joins, as-of.

Lookup joins carry no broadcast hint: the planner and AQE broadcast a side by
its measured bytes and sort-merge join anything larger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurelab.operators.rank import buckets_for, with_range_bucket
from featurelab.session import materialize


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left lookup join."""
    return df.join(lookup, on, "left")


def semi_by_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Multi-key point read (J4, P14): ``left_semi`` against the key list."""
    return df.join(keys, on, "left_semi")


def vertical_slices(df: DataFrame, key: str, groups: Sequence[Sequence[str]]) -> list[DataFrame]:
    """Entity-type slices of one wide row, each keeping the key (FS3)."""
    return [df.select(key, *g) for g in groups]


def write_bucketed(df: DataFrame, key: str, name: str, path: str, buckets: int) -> DataFrame:
    """One slice as a table bucketed and sorted by its key, in the shared
    folder ``path``; all slices of one entity take the same ``buckets``, which
    should give each some hundreds of megabytes.

    A row per key is expected.  Rows that share a key meet in one bucket."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def rejoin_slices(slices: Sequence[DataFrame], key: str) -> DataFrame:
    """Re-attach slices on their key (J5): the first has the keys, the others
    add their columns, NULL for a key that they lack.

    Slices written by ``write_bucketed`` with equal bucket counts are merged
    bucket by bucket as they lie, without an exchange on any side; the merge
    hint keeps a small slice from being broadcast instead.  Column-wise concat
    by row index (J6) becomes this join on the key, since rows of a table have
    no order.
    """
    out = slices[0]
    for s in slices[1:]:
        out = out.join(s.hint("merge"), key, "left")
    return out


def unprocessed(df: DataFrame, manifest: DataFrame, key: str, manifest_key: str) -> DataFrame:
    """Rows whose key is not in the manifest (J9): ``left_anti``."""
    m = manifest.select(F.col(manifest_key).alias(key)).dropDuplicates()
    return df.join(m, key, "left_anti")


def side_by_side(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str],
                 names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Champion vs challenger outputs (J10): full outer join + deltas."""
    l = a.select(key, *[F.col(c).alias(f"{c}_{names[0]}") for c in cols])
    r = b.select(key, *[F.col(c).alias(f"{c}_{names[1]}") for c in cols])
    out = l.join(r, key, "full_outer")
    return out.withColumns({f"{c}_delta": F.col(f"{c}_{names[1]}") - F.col(f"{c}_{names[0]}")
                            for c in cols})


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              value_cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Point-in-time join (J3): every left row gets the newest right row of
    the same key with ``right_ts <= left_ts`` (equal times match).

    Both sides are unioned and cut into ranges of (key, time) of about equal
    row counts, so a hot key, even with all its rows in one hour, spreads
    over as many tasks as its rows need:
    1. one window over each (range, key), ordered by time, carries the newest
       right row forward to each left row (right rows first at equal time);
    2. a left row with no right row before it in its own range takes the
       newest right row of an earlier range of its key, from a small table of
       one row per (range, key).
    The two inputs are written once as one table in the shared folder, which
    the count, the ranges and the undated rows all read.  No pairs are formed.
    Right rows with equal (key, time) resolve to the largest struct of values,
    so the result is deterministic.  Left rows with a NULL key or time get NULL
    values and skip the window.
    """
    r = (right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
         .select(F.col(key).alias("_k"), F.col(right_ts).alias("_t"),
                 F.struct(*[F.col(c) for c in value_cols]).alias("_v")))
    lcols = left.columns
    dated = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    l = left.select(F.col(key).alias("_k"), F.col(left_ts).alias("_t"), F.when(dated, 1).otherwise(2).alias("_side"),
                    F.struct(*[F.col(c) for c in lcols]).alias("_row"))
    vtype, rtype = r.schema["_v"].dataType, l.schema["_row"].dataType
    both = materialize(r.select("_k", "_t", F.lit(0).alias("_side"), "_v", F.lit(None).cast(rtype).alias("_row"))
                       .unionByName(l.select("_k", "_t", "_side", F.lit(None).cast(vtype).alias("_v"), "_row")))
    if buckets is None:
        buckets = buckets_for(both.count())
    u, buckets = with_range_bucket(both.where(F.col("_side") < 2), ["_k", "_t", "_side"], buckets)
    order = Window.partitionBy("_range", "_k").orderBy("_t", "_side", "_v")
    newest = F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    j = u.withColumn("_in", newest).where(F.col("_side") == 1)
    v = F.col("_in")
    if buckets > 1:
        last = u.where(F.col("_side") == 0).groupBy("_k", "_range").agg(
            F.max_by("_v", F.struct("_t", "_v")).alias("_last"))
        here = u.select("_k", "_range").distinct().join(last, ["_k", "_range"], "left")
        before = Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carry = here.select("_k", "_range", F.last("_last", ignorenulls=True).over(before).alias("_prev"))
        j = j.join(carry, ["_k", "_range"], "left")
        v = F.coalesce(F.col("_in"), F.col("_prev"))
    found = j.select(*[F.col("_row")[c].alias(c) for c in lcols], *[v[c].alias(c) for c in value_cols])
    undated = both.where(F.col("_side") == 2).select(
        *[F.col("_row")[c].alias(c) for c in lcols], *[F.lit(None).cast(vtype[c].dataType).alias(c) for c in value_cols])
    return found.unionByName(undated)
