"""Structured run log (IO12): keyword, timestamp, message, status 0/1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAIL_ABOVE = 100.0


def run_log_entries(events: DataFrame) -> DataFrame:
    """Events read as log entries; a value above 100 marks a failed step."""
    return events.select(
        F.col("event_type").alias("keyword"), "ts",
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.when(F.col("value") > FAIL_ABOVE, 1).otherwise(0).alias("status"))


LOG_SCHEMA = "keyword string, ts timestamp_ntz, message string, status int"


def append_log(df: DataFrame, path: str) -> None:
    """Append entries as JSON lines (one file set per call)."""
    # all of a timestamp's digits
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    df.select(F.to_json(F.struct(*df.columns), options).alias("value")).write.mode("append").text(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(path)
