"""Feature store as tables (FS1-FS8).

Offline store = an append-only parquet table keyed by (entity_id,
feature_timestamp), partitioned by feature date so point-in-time reads prune
partitions.  The serving table is the newest row per entity.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelab.operators.aggregate import latest_per_key
from featurelab.operators.joins import asof_join, semi_by_keys
from featurelab.session import materialize

KEY, TS = "entity_id", "feature_timestamp"


def feature_schema(features: Sequence[str]) -> T.StructType:
    """Feature table schema (FS1): two required columns, then doubles."""
    return T.StructType([T.StructField(KEY, T.StringType(), False),
                         T.StructField(TS, T.TimestampType(), False)]
                        + [T.StructField(f, T.DoubleType(), True) for f in features])


def check_required(df: DataFrame, required: Sequence[str] = (KEY, TS)) -> DataFrame:
    """File sources do not enforce NOT NULL: fail the job on a NULL in a
    required column (``assert_true`` runs on the executors, no extra scan)."""
    cond = None
    for c in required:
        x = F.col(c).isNotNull()
        cond = x if cond is None else cond & x
    from featurelab.functions.columns import assert_rows
    return assert_rows(df, cond, "required feature column is NULL", required[0])


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def ingest_frame(df: DataFrame, key: str, ts: str, features: dict, batch_ts: dt.datetime) -> DataFrame:
    """Encode + cast to double + one ingestion time for the whole batch (FS2).

    ``features`` maps feature name -> Column expression (encodings included);
    ``try_cast`` turns unparseable text into NULL instead of failing.
    """
    out = df.select(F.col(key).cast("string").alias(KEY), F.col(ts).cast("timestamp").alias(TS),
                    *[F.col(c).try_cast("double").alias(n) if isinstance(c, str) else
                      c.try_cast("double").alias(n) for n, c in features.items()],
                    F.lit(batch_ts).cast("timestamp").alias("ingested_at"))
    return check_required(out)


DAY_ROWS = 2_000_000  # rows of one date that one task writes


def write_offline(df: DataFrame, path: str, mode: str = "append", day_rows: int = DAY_ROWS) -> None:
    """Append a batch to the offline store, partitioned by feature date.

    Appending keeps history, so point-in-time reads stay possible (the
    reference truncated the table on every ingest and lost it).  The rows of a
    date meet in one task, so a batch adds one file per date; a date of more
    than ``day_rows`` (counted from the time column alone) is dealt over as many
    tasks and files as it needs."""
    spark = df.sparkSession
    dated = df.withColumn("feature_date", F.to_date(TS))
    large = dated.groupBy("feature_date").count().where(F.col("count") > day_rows).select(
        F.col("feature_date").alias("_day"), F.ceil(F.col("count") / day_rows).alias("_parts"))
    large = materialize(large)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if large.isEmpty():
        out = dated.repartition(tasks, "feature_date")
    else:
        # at most a row per day_rows of the batch: a small table whatever the batch
        out = dated.join(F.broadcast(large), F.col("feature_date").eqNullSafe(F.col("_day")), "left").withColumn(
            "_part", F.pmod(F.xxhash64(KEY, TS), F.coalesce("_parts", F.lit(1))))
        out = out.repartition(tasks, "feature_date", "_part").drop("_day", "_parts", "_part")
    out.write.mode(mode).partitionBy("feature_date").parquet(path)


def entity_slices(df: DataFrame, slices: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Entity-type slices (FS3): one projection per slice, sharing the key."""
    return {name: df.select(KEY, TS, *cols) for name, cols in slices.items()}


def latest_features(df: DataFrame, features: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Serving table (FS4): newest row per entity by feature time, then
    ingestion time, then the ``tie`` columns; a late-arriving older row
    never wins because feature time is compared first."""
    order = [TS] + (["ingested_at"] if "ingested_at" in df.columns else []) + list(tie)
    return latest_per_key(df, [KEY], order, [TS, *features])


def multi_read(serving: DataFrame, keys: DataFrame) -> DataFrame:
    """Online single / multi read (FS5, J4): semi-join on the key list."""
    return semi_by_keys(serving, keys.select(KEY), KEY)


def point_in_time(df: DataFrame, cutoff, features: Sequence[str], newest_only: bool = True,
                  tie: Sequence[str] = ()) -> DataFrame:
    """Rows at or before ``cutoff`` (P15, FS7); optionally newest per entity.
    On a table partitioned by feature date the cut-off prunes partitions."""
    cut = df.where(F.col(TS) <= F.lit(cutoff).cast("timestamp"))
    return latest_features(cut, features, tie) if newest_only else cut


def historical_serving(instances: DataFrame, offline: DataFrame, features: Sequence[str],
                       instance_key: str, instance_ts: str) -> DataFrame:
    """Historical serving (FS8): as-of join of read instances to features."""
    inst = instances.withColumnRenamed(instance_key, KEY) if instance_key != KEY else instances
    return asof_join(inst, offline, KEY, instance_ts, TS, list(features))
