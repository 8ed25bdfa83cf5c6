"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.session import checkpoint_dir, spread

ROOT = str(Path(__file__).resolve().parents[2])
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def workers_import(spark: SparkSession) -> None:
    """Let the Python workers of functions made from now on import this
    package from where the driver has it.  A cluster whose executors do not
    share that path gets the package by ``--py-files`` as usual."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """A query run in this block removes its shuffle files when it ends; they
    else wait for a garbage collection of the driver."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def shared_table(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: the lineage ends there, so a lost executor costs only its own tasks
    and several jobs can read the result without recomputing it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    with shuffles_end(spark):
        df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Remove tables of ``shared_table`` that nothing reads any more: what is
    made from them has been written itself."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.shared_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, row_bytes: int, max_bytes: int = 16 << 20) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows, at ``row_bytes`` each,
    take at most ``max_bytes``; else as it is, for a shuffled join of the same
    rows."""
    return F.broadcast(df) if df.count() * row_bytes <= max_bytes else df


def semi_join_small(df: DataFrame, keys: DataFrame, on: str, row_bytes: int = 16,
                    max_bytes: int = 16 << 20) -> DataFrame:
    """Rows of ``df`` whose ``on`` is among ``keys`` (distinct, few columns).

    The keys are broadcast only when their counted size is at most
    ``max_bytes``; a larger list takes the shuffled semi-join, same rows.
    """
    return df.join(small_side(keys, row_bytes, max_bytes), on, "left_semi")


def _bytes(size: str) -> int:
    """A size as Spark's settings name it ("64m", "1gb", "4096")."""
    size = size.strip().lower().removesuffix("b")
    power = " kmgtp".find(size[-1:])
    return int(size[:-1]) << 10 * power if power > 0 else int(size)


def text_rows(df: DataFrame) -> DataFrame:
    """Spread a one-file input over the cores before per-row CPU work, and bound
    the bytes of texts that a Python worker gets at once: 10,000 long texts,
    Spark's own bound, are held several times over on their way."""
    spark = df.sparkSession
    workers_import(spark)
    if _bytes(spark.conf.get(BATCH, "64m")) > BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    return spread(df)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until it is none of ``df``'s columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out
