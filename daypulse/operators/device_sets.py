"""Active devices as bitmaps (A1, A11, W2, W4): exact counts over any hours and
days without the devices.

A dictionary gives every device a number. Per day, hour and bucket of 32,768
numbers one bitmap holds the devices that were active: 4 KB, whatever the number
of logs. Unions of bitmaps answer what would need a distinct count over the logs:
a day, the hours so far, a week, the devices that came back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.functions.ranks import numbered


def add_devices(mids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``mid, id`` of the devices in ``mids`` that ``known`` does not have, numbered
    on from its highest: the rows that a day appends to the dictionary."""
    new = mids.select("mid").where(F.col("mid").isNotNull()).distinct()
    if known is None:
        return numbered(new, "mid", "id")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("n")).first()["n"]
    return numbered(new.join(known, "mid", "left_anti"), "mid", "id", after=top)


def hour_sets(start: DataFrame, ids: DataFrame) -> DataFrame:
    """``dt, hr, bucket, bits``: who was active in which hour. The logs are reduced
    to one row per device and hour before they meet the dictionary, so no device
    is hot there; bitmaps combine before their shuffle."""
    seen = start.select("dt", "hr", "mid").distinct().join(ids, "mid")
    return (seen.groupBy("dt", "hr", F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))


def write_sets(sets: DataFrame, path: str) -> None:
    """Sets by day; a day that is written again replaces itself."""
    (sets.repartition("dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(path))


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("hr string, bucket long, bits binary, dt date").parquet(path)


def _size(bits: str = "bits") -> F.Column:
    return F.sum(F.bitmap_count(bits))


def union_of(sets: DataFrame, *by: str) -> DataFrame:
    """The devices of several sets together, per ``by`` and bucket."""
    return sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def devices(sets: DataFrame, *by: str) -> DataFrame:
    """``by, n``: distinct devices over all sets of a group."""
    return union_of(sets, *by).groupBy(*by).agg(_size().alias("n"))


def through_the_day(sets: DataFrame) -> DataFrame:
    """``dt, hr, n, cum``: devices active in the hour, and in the day up to it. The
    window runs over the at most 24 bitmaps of a day and bucket; an hour that a
    bucket has no device in carries its last union on."""
    w = Window.partitionBy("dt", "bucket").orderBy("hr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = sets.withColumn("seen", F.bitmap_count(F.bitmap_or_agg("bits").over(w)))
    before = F.lag("seen", 1, 0).over(Window.partitionBy("dt", "bucket").orderBy("hr"))
    # what a bucket gains in an hour: gains add up over buckets and hours
    per_hour = (so_far.withColumn("gain", F.col("seen") - before)
                .groupBy("dt", "hr").agg(_size().alias("n"), F.sum("gain").alias("gain")))
    day = Window.partitionBy("dt").orderBy("hr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_hour.select("dt", "hr", "n", F.sum("gain").over(day).cast("bigint").alias("cum"))


def over_days(sets: DataFrame, days: int) -> DataFrame:
    """``dt, n``: distinct devices of each day with logs and the ``days - 1`` before
    it. A day's bitmap goes to each day it counts for."""
    per_day = union_of(sets, "dt")
    present = per_day.select("dt").distinct()
    spread = per_day.select(F.explode(F.sequence("dt", F.date_add("dt", days - 1))).alias("dt"), "bucket", "bits")
    return devices(spread.join(present, "dt", "left_semi"), "dt")


def day_figures(sets: DataFrame, week: int = 7) -> DataFrame:
    """``dt, value, week, back``: devices of the day, of the ``week`` days up to it,
    and of the day who were also active the day before (a + b - union)."""
    one = devices(sets, "dt").withColumnRenamed("n", "value")
    two = over_days(sets, 2).withColumnRenamed("n", "both")
    before = one.select(F.date_add("dt", 1).alias("dt"), F.col("value").alias("prev"))
    prev = F.coalesce("prev", F.lit(0))
    return (one.join(two, "dt").join(over_days(sets, week).withColumnRenamed("n", "week"), "dt")
            .join(before, "dt", "left")
            .select("dt", "value", "week", (F.col("value") + prev - F.col("both")).cast("bigint").alias("back")))
