"""Session construction and shared-folder helpers.

Everything that must survive an executor loss (lineage cuts, written
intermediate tables, streaming checkpoints) lives under the folder the
cluster names in ``spark.checkpoint.dir``.  A local scratch folder is only
chosen when that setting is unset *and* the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC so timestamps compare with the
# oracle, AQE for runtime coalescing / skew splitting, ANSI on (default).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "featurelab", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_conf(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Runtime SQL settings (safe on an existing session)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, SESSION_CONF[k])


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediates.

    Reads ``spark.checkpoint.dir``; only a local session may fall back to a
    fresh scratch folder (that is what tests and the bench use).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="featurelab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    p = os.path.join(base, "featurelab", f"{name}-{uuid.uuid4().hex[:12]}")
    return p


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def workers_import(spark: SparkSession) -> None:
    """Let Python workers of functions made from now on import this package
    from where the driver has it; a cluster whose executors do not share that
    path gets the package by ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


SPREAD_MAX = 64


def spread(df, max_partitions: int = SPREAD_MAX):
    """Spread rows over the cores before CPU-heavy per-row work.

    A small input stored as one file with one row group is a single scan
    task; heavy projections (regexes over whole texts, hashing, path
    expansion) would then run on one core.  When the input has fewer
    partitions than min(default parallelism, ``max_partitions``) it is
    round-robin repartitioned to that many (round-robin repartitioning sorts
    first, so a retried task gets the same rows); a large input (thousands
    of splits) is returned unchanged, so no shuffle is added at scale, and a
    small file on a big cluster is not cut into thousands of slivers.
    """
    target = min(df.sparkSession.sparkContext.defaultParallelism, max_partitions)
    if _partitions(df) < target:
        return df.repartition(target)
    return df


def _partitions(df) -> int:
    """Partitions of the plan as it would run without adaptive changes, which
    is known without running its shuffles (an adaptive plan runs them first)."""
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*").rdd.getNumPartitions()
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where one intermediate feeds several jobs (e.g. quantile bounds and
    then the prefix sums over the same grouped table): the upstream work runs
    once, and a lost executor re-reads the checkpoint instead of recomputing
    the whole lineage.  Never ``localCheckpoint``: executor-local copies die
    with the executor.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str):
    """``df`` as Parquet under the shared folder, read back: like
    ``materialize`` for many rows of few distinct values, which take less disk
    as columns and of which a reader opens only those it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
