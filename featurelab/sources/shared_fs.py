"""Small files of the shared folder through Hadoop's FileSystem: metadata that
a job writes once and reads on the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder; none if it is not there."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def put_marker(spark: SparkSession, path: str) -> None:
    """An empty file, there as a whole or not at all."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()
