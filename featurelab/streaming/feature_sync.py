"""Streaming feature sync (FS4): newest row per entity into a serving table.

The table is a snapshot and the batches since it:

    deltas/batch_id=N        newest row per entity of micro-batch N
    snapshots/through=N      newest row per entity of all batches up to N
    versions/N               empty marker: snapshot N is whole

A batch writes only its own newest rows, under its id (``overwrite``, so a
replayed batch rewrites the same folder).  Every ``compact_every`` batches the
newest snapshot and the deltas after it are folded into the next snapshot; the
marker is written last.  A read opens the newest marked snapshot and the
deltas after it, at most ``compact_every`` of them, however long the stream has
run.  Feature time decides, so a late file with older rows never replaces a
newer value.  The state lives in the table, not in the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from featurelab.operators.store import KEY, TS, feature_schema, latest_features
from featurelab.sources.shared_fs import child_names, put_marker


def current_version(spark: SparkSession, serving: str) -> int:
    """Last batch of the newest whole snapshot; -1 if there is none."""
    return max((int(n) for n in child_names(spark, f"{serving}/versions")), default=-1)


def serving_paths(spark: SparkSession, serving: str) -> list[str]:
    """What a read opens: the newest snapshot and the deltas after it."""
    v = current_version(spark, serving)
    deltas = sorted(int(n.partition("=")[2]) for n in child_names(spark, f"{serving}/deltas") if n.startswith("batch_id="))
    return ([f"{serving}/snapshots/through={v}"] if v >= 0 else []) + [f"{serving}/deltas/batch_id={b}" for b in deltas if b > v]


def _schema(features: Sequence[str], tie: Sequence[str]) -> str:
    # what is on disk does not enforce NOT NULL, so the columns are read as they may be
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feature_schema([*features, *tie]).fields)


def read_serving(spark: SparkSession, serving: str, features: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per entity over the snapshot and the deltas after it (partial
    ``max_by`` before the shuffle, so a hot entity costs one row per map
    task)."""
    schema = _schema(features, tie)
    paths = serving_paths(spark, serving)
    log = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return latest_features(log, [*features, *tie], tie)


def compact(spark: SparkSession, serving: str, through: int, features: Sequence[str], tie: Sequence[str] = ()) -> None:
    """Fold the table up to batch ``through`` into a snapshot.  A replay finds
    the marker and does nothing; a run that was lost half way left no marker
    and is written over."""
    if current_version(spark, serving) >= through:
        return
    state = read_serving(spark, serving, features, tie)
    state.write.mode("overwrite").parquet(f"{serving}/snapshots/through={through}")
    put_marker(spark, f"{serving}/versions/{through}")


def sync_features(spark: SparkSession, landing: str, schema: str, serving: str, checkpoint: str,
                  features: Sequence[str], tie: Sequence[str] = (), max_files_per_trigger: int = 4,
                  compact_every: int = 8) -> None:
    stream = (spark.readStream.format("parquet").schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing))
    cols = [KEY, TS, *features, *tie]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        newest = latest_features(batch.select(*cols), [*features, *tie], tie)
        newest.write.mode("overwrite").parquet(f"{serving}/deltas/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, serving, batch_id, features, tie)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
