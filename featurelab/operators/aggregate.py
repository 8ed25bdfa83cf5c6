"""Grouping, pivot, dedupe, imputation, latest/best-per-key, top-k (A-group).

pandas null rules are kept where the reference relies on them: a group with a
NULL key is dropped, the sum of nothing is 0, ``dropna`` also drops NaN.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelab.functions.columns import col_, qcol


def group_sum(df: DataFrame, keys: Sequence[str], value: str | Column, alias: str,
              drop_null_keys: bool = True) -> DataFrame:
    """``groupby(keys)[value].sum()`` (A1): null keys dropped, empty sum 0.

    Partial aggregation runs map-side, so the shuffle carries one row per
    key per input partition however skewed the keys are.
    """
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    return df.groupBy(*keys).agg(F.coalesce(F.sum(col_(value)), F.lit(0.0)).alias(alias))


def pivot_sum(df: DataFrame, index: Sequence[str], column: str, values: Sequence,
              value: str | Column, rename: Mapping | None = None,
              drop_null_keys: bool = True) -> DataFrame:
    """``pivot_table(values, index, columns, aggfunc='sum')`` (A2).

    The category list is explicit, so the schema is fixed and Spark needs no
    extra job to discover it; a missing cell stays NULL as in pandas.
    """
    if drop_null_keys:
        for k in index:
            df = df.where(F.col(k).isNotNull())
    out = df.groupBy(*index).pivot(column, list(values)).agg(F.sum(col_(value)))
    if rename:
        out = out.withColumnsRenamed({str(k): v for k, v in rename.items()})
    return out


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna()`` (A3): NULL or NaN in any (subset) column drops the row."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """``drop_duplicates()`` over all columns (A4); any copy is the same."""
    return df.distinct()


def _is_missing(c: str, kind: str) -> Column:
    gone = qcol(c).isNull()
    return gone | F.isnan(qcol(c)) if kind in ("double", "float") else gone


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Per-column mode, lowest value on a tie, NULL and NaN ignored (A5).

    One job for all columns: grouping sets count each column's values with
    partial counts before the shuffle, so no task ever holds all distinct
    values of a column; then a global ``min_by`` over (-count, value) per
    column.  Only one value per column reaches the driver.
    """
    kinds = dict(df.dtypes)
    names = [f"_m{j}" for j in range(len(cols))]
    d = df.select(*[F.when(~_is_missing(c, kinds[c]), qcol(c)).alias(n) for c, n in zip(cols, names)])
    counts = d.groupingSets([[F.col(n)] for n in names], *names).agg(
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    every = (1 << len(names)) - 1
    picks = []
    for j, n in enumerate(names):
        mine = (F.col("_set") == every - (1 << len(names) - 1 - j)) & F.col(n).isNotNull()
        picks.append(F.min_by(F.col(n), F.when(mine, F.struct((-F.col("_n")).alias("n"), F.col(n).alias("v")))).alias(n))
    row = counts.agg(*picks).first()
    return {c: row[n] for c, n in zip(cols, names)}


def apply_fill(df: DataFrame, values: Mapping) -> DataFrame:
    """Fill NULLs and NaNs from fitted statistics (A6); works on any split."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(_is_missing(c, kinds[c]), F.lit(v)).otherwise(qcol(c))
                           for c, v in values.items() if v is not None})


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   cols: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order`` (A11): ``max_by`` over a struct.

    An aggregate, not a window: partial ``max_by`` runs before the shuffle,
    so a key holding a third of all rows costs one row per map partition.
    """
    payload = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[F.col(c) for c in order])
    out = df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_latest"))
    return out.select(*keys, *[F.col("_latest." + c).alias(c) for c in cols])


def best_per_key(df: DataFrame, keys: Sequence[str], metric: str, tie: str,
                 cols: Sequence[str], minimize: bool = True) -> DataFrame:
    """Best trial per key (A13): strict comparison, first trial wins ties."""
    payload = F.struct(*[F.col(c) for c in cols])
    if minimize:
        agg = F.min_by(payload, F.struct(F.col(metric), F.col(tie)))
    else:
        agg = F.min_by(payload, F.struct((-F.col(metric)).alias("m"), F.col(tie)))
    out = df.groupBy(*keys).agg(agg.alias("_best"), F.count(F.lit(1)).alias("n_trials"))
    return out.select(*keys, *[F.col("_best." + c).alias(c) for c in cols], "n_trials")


def top_k_within(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                 k: int, rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per group.

    Written this way Spark plans a ``WindowGroupLimit`` on both sides of the
    shuffle: each map task keeps only k rows per group before exchanging.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def profile(df: DataFrame, value: str) -> DataFrame:
    """``y.min(), y.max(), y.mean()`` plus count in one aggregate."""
    return df.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"),
                  F.avg(value).alias("mean_value"), F.count(value).alias("n"))


def category_counts(df: DataFrame, col: str, categories: Sequence[str],
                    other: str = "other") -> DataFrame:
    """Counts in a fixed category order plus ``other``; zero rows appear.

    The category list is a literal of known size, so joining the (tiny)
    aggregated counts onto it is a broadcast by construction.
    """
    cats = list(categories)
    known = F.when(F.col(col).isin(cats), F.col(col)).otherwise(F.lit(other))
    counts = df.select(known.alias("category")).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    order = spark.createDataFrame([(c, i) for i, c in enumerate(cats + [other])],
                                  "category string, position int")
    return (order.join(F.broadcast(counts), "category", "left")
            .select("category", "position", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
