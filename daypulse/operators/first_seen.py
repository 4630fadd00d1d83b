"""First day of every device (A5) as a table that each day is added to.

Parquet, one folder per ``first_dt`` with the devices (``mid``) that were first
seen then. The new devices of a day are the rows of its folder; nothing else is
read. A day is added by an anti join of its devices with those known, so that the
logs of other days are never read again."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.operators.dashboard import first_seen
from daypulse.session import delete_path, path_exists

SCHEMA = "mid string, first_dt date"


def write_table(rows: DataFrame, path: str) -> None:
    """Rewrites the folders of the days in ``rows``; a day of many devices is
    dealt to several tasks."""
    (rows.select("mid", "first_dt").hint("rebalance", "first_dt")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("first_dt").parquet(path))


def start_table(logs: DataFrame, path: str) -> None:
    """The table from history (``mid, dt`` of all logs so far): one aggregate
    that combines before its shuffle."""
    write_table(first_seen(logs), path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def add_day(spark: SparkSession, path: str, logs: DataFrame, day: _dt.date) -> None:
    """Adds ``day`` (``logs``: ``mid`` of its logs, repeats allowed). Days may come
    in any order and more than once: devices that were known from a later day
    move to this one, and only the folders they leave are rewritten."""
    devices = logs.select("mid").where(F.col("mid").isNotNull()).distinct()
    first_dt = F.lit(day).cast("date")
    if not path_exists(spark, path):
        write_table(devices.withColumn("first_dt", first_dt), path)
        return
    known = read_table(spark, path)
    new = devices.join(known.where(F.col("first_dt") < first_dt), "mid", "left_anti").withColumn("first_dt", first_dt)
    later = known.where(F.col("first_dt") > first_dt)
    left = [r.first_dt for r in later.join(devices, "mid", "left_semi").select("first_dt").distinct().collect()]
    if not left:
        write_table(new, path)
        return
    stay = known.where(F.col("first_dt").isin(left)).join(devices, "mid", "left_anti").select("mid", "first_dt")
    kept = {r.first_dt for r in stay.select("first_dt").distinct().collect()}
    write_table(new.unionByName(stay), path)
    for d in left:      # a folder that nobody is left in is not rewritten
        if d not in kept:
            delete_path(spark, f"{path}/first_dt={d.isoformat()}")


def new_devices(first: DataFrame) -> DataFrame:
    """``dt, n``: devices first seen on each day."""
    return first.groupBy(F.col("first_dt").alias("dt")).agg(F.count(F.lit(1)).alias("n"))
