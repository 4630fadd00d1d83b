"""File sinks. Every path is under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.session import work_path


def archive_raw(spark: SparkSession, records: DataFrame, path: str | None = None) -> str:
    """Append raw records, key and arrival time included, to a day-partitioned
    archive (one folder per arrival day, as the collector's daily rolling log
    file). Returns the path."""
    path = path or work_path(spark, "raw_archive")
    (records.select("key", "value", "topic", "partition", "offset", "timestamp",
                    F.to_date("timestamp").alias("arrival_dt"))
     .write.mode("append").partitionBy("arrival_dt").parquet(path))
    return path


def write_routed(spark: SparkSession, routed: DataFrame, path: str | None = None) -> str:
    """File twin of the per-row topic sink: one folder per topic."""
    path = path or work_path(spark, "routed")
    routed.select("topic", "key", "value").write.mode("append").partitionBy("topic").parquet(path)
    return path
