"""Class balancing (F9 random oversampling, F10 SMOTE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.functions.columns import copy_ids, stable_unit
from featurelab.operators.rank import hash_rank

RES = 1_000_000
COPY_CHUNK = 1_000_000


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, n): rows per class as a table, a NULL label one class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def explode_copies(df: DataFrame, copies: Column, out: str, key: str, chunk: int = COPY_CHUNK) -> DataFrame:
    """One output row per copy id ``0 .. copies-1`` of every input row.

    The copies are first cut into chunk ids, the chunks are spread over tasks
    by (key, chunk), and only then exploded: no task has to emit an unbounded
    number of rows when a tiny class grows to a huge majority size.
    """
    d = df.withColumn("_copies", copies)
    n_chunks = F.ceil(F.col("_copies") / F.lit(chunk)).cast("int")
    d = d.withColumn("_chunk", F.explode(copy_ids(n_chunks))).repartition(F.col(key), F.col("_chunk"))
    lo = F.col("_chunk") * F.lit(chunk)
    hi = F.least(lo + F.lit(chunk), F.col("_copies"))
    return (d.withColumn(out, F.explode(F.sequence(lo.cast("int"), (hi - 1).cast("int"))))
            .drop("_copies", "_chunk"))


def random_oversample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Every class grows to the majority size M.

    A class of n rows gets ``M // n`` copies of every row plus one more copy
    of the ``M % n`` rows with the smallest (hash, key): the counts are exact
    and the choice is deterministic (sampling with replacement, made
    repeatable).  Each row's rank and its class size come from the same
    bucket counts; only M reaches the driver, so there may be any number of
    classes.  Rows with a NULL label are a class of their own, a NULL key is
    a key.
    """
    m = class_sizes(df, label).agg(F.max("n")).first()[0]
    if m is None:
        return df.withColumn("copy_id", F.lit(0))
    d = df.withColumn("_h", F.coalesce(stable_unit(F.col(key), seed, RES), F.lit(0)))
    ranked = hash_rank(d, [label], "_h", key, RES, out="_rank", size_col="_n")
    copies = F.floor(F.lit(m) / F.col("_n")) + F.when(
        F.col("_rank") <= F.pmod(F.lit(m), F.col("_n")), 1).otherwise(0)
    return explode_copies(ranked, copies, "copy_id", key).drop("_h", "_rank", "_n")
