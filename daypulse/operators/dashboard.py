"""Dashboard aggregates over the daily active-device table and the logs:
totals (A1), hours (A2), two-day comparison with a zero-filled 24-hour grid
(A3, J6), KPI list (A4), new devices (A5), starts per day (A6), hourly active
devices (W4), cumulative counts (W2) and day-over-day rate (W3)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.time import hour_grid


def _d(day) -> F.Column:
    return F.lit(day).cast("date")


def dau_total(dau: DataFrame, day: _dt.date) -> DataFrame:
    """Active devices of a day: one row even when the day is empty. The
    filter is on the partition column of the daily table, so it prunes."""
    return (dau.where(F.col("dt") == _d(day))
            .agg(F.count(F.lit(1)).alias("value"))
            .select(_d(day).alias("dt"), "value"))


def dau_total_from_logs(start: DataFrame, day: _dt.date, approx: bool = False) -> DataFrame:
    """Active devices of a day straight from start logs: exact
    ``count_distinct``, or HyperLogLog++ (``approx_count_distinct``, 5 %
    relative error by default) when a fast figure is enough."""
    mid = F.col("mid")
    agg = F.approx_count_distinct(mid) if approx else F.count_distinct(mid)
    return (start.where(F.col("dt") == _d(day)).agg(agg.cast("bigint").alias("value"))
            .select(_d(day).alias("dt"), "value"))


def dau_hour(dau: DataFrame, day: _dt.date) -> DataFrame:
    return (dau.where(F.col("dt") == _d(day))
            .groupBy("hr").agg(F.count(F.lit(1)).alias("n")))


def _two_day_counts(dau: DataFrame, day: _dt.date) -> DataFrame:
    """One scan of two partitions, conditional counts per hour (at most 24 rows)."""
    y = F.date_sub(_d(day), 1)
    return (dau.where(F.col("dt").isin(_d(day), y))
            .groupBy("hr")
            .agg(F.count_if(F.col("dt") == y).alias("yesterday"),
                 F.count_if(F.col("dt") == _d(day)).alias("today")))


def dau_hour_compare(spark: SparkSession, dau: DataFrame, day: _dt.date) -> DataFrame:
    """24 rows ``hr, yesterday, today`` with zeros for silent hours."""
    counts = _two_day_counts(dau, day)
    return (hour_grid(spark).join(counts, "hr", "left")
            .select("hr",
                    F.coalesce("yesterday", F.lit(0)).cast("bigint").alias("yesterday"),
                    F.coalesce("today", F.lit(0)).cast("bigint").alias("today")))


def hour_map_json(dau: DataFrame, day: _dt.date) -> DataFrame:
    """``{"yesterday":{hr:n},"today":{hr:n}}``, keys sorted, silent hours absent
    (the reply shape of the read API). Collects at most 2 x 24 entries."""
    counts = _two_day_counts(dau, day)

    def side(c):
        entries = F.collect_list(F.when(F.col(c) > 0, F.struct(F.col("hr"), F.col(c).alias("n"))))
        return F.map_from_entries(F.array_sort(entries))

    return (counts.agg(side("yesterday").alias("yesterday"), side("today").alias("today"))
            .select(F.to_json(F.struct("yesterday", "today")).alias("json")))


def start_count(start: DataFrame) -> DataFrame:
    """Start logs per day, no dedup."""
    return start.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def first_seen(logs: DataFrame) -> DataFrame:
    """First day of every device (partial aggregate per mid)."""
    return logs.groupBy("mid").agg(F.min("dt").alias("first_dt"))


def new_devices(logs: DataFrame) -> DataFrame:
    """Devices whose first-ever day is ``dt``."""
    return (first_seen(logs).groupBy(F.col("first_dt").alias("dt"))
            .agg(F.count(F.lit(1)).alias("n")))


def hourly_active(start: DataFrame) -> DataFrame:
    """A device counts in every hour it is seen."""
    return start.groupBy("dt", "hr").agg(F.count_distinct("mid").alias("n"))


def dau_cumulative(dau: DataFrame) -> DataFrame:
    """Running active devices through the day. The window runs over the
    per-hour aggregate (at most 24 rows per day), never over raw rows."""
    per_hour = dau.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("dt").orderBy("hr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_hour.select("dt", "hr", "n", F.sum("n").over(w).cast("bigint").alias("cum"))


def dau_per_day(dau: DataFrame) -> DataFrame:
    return dau.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def kpi_total(dau: DataFrame, first: DataFrame, day: _dt.date) -> DataFrame:
    """KPI list ``id, name, value``: active devices and new devices of a day, from
    the daily table and the first days of the devices (``mid, first_dt``)."""
    dau_row = dau_total(dau, day).select(
        F.lit(params.KPI_DAU[0]).alias("id"), F.lit(params.KPI_DAU[1]).alias("name"), "value")
    new_row = (first.where(F.col("first_dt") == _d(day))
               .agg(F.count(F.lit(1)).alias("value"))
               .select(F.lit(params.KPI_NEW_MID[0]).alias("id"),
                       F.lit(params.KPI_NEW_MID[1]).alias("name"), "value"))
    return dau_row.unionByName(new_row)


def kpi_dod_rate(dau: DataFrame) -> DataFrame:
    """Day-over-day change of active devices. The previous day is joined on
    ``dt - 1`` rather than taken with ``lag``: a missing day must give a null
    rate, not the rate against an older day."""
    d = dau_per_day(dau)
    prev = d.select((F.date_add("dt", 1)).alias("dt"), F.col("n").alias("yesterday"))
    j = d.select("dt", F.col("n").alias("today")).join(prev, "dt", "left")
    rate = F.when(F.col("yesterday") > 0,
                  F.round((F.col("today") - F.col("yesterday")) / F.col("yesterday"), 4))
    return j.select("dt", "today", "yesterday", rate.cast("double").alias("rate"))


def kpi_json(kpi: DataFrame) -> DataFrame:
    """The KPI reply ``[{"id":..,"name":..,"value":..}, ...]`` (a handful of
    rows, sorted by id)."""
    items = F.array_sort(F.collect_list(F.struct("id", "name", "value")))
    return kpi.agg(F.to_json(items).alias("json"))


def kpi_total_from_logs(logs: DataFrame, day: _dt.date) -> DataFrame:
    """The KPI list straight from the logs in one pass: one aggregate per
    device (first day ever, and whether it sent a start log on ``day``,
    combined map-side), then both counts from that, unpacked to two rows."""
    active = F.max(F.when((F.col("kind") == "start") & (F.col("dt") == _d(day)), 1).otherwise(0))
    per_mid = logs.groupBy("mid").agg(F.min("dt").alias("first_dt"), active.alias("active"))
    tot = per_mid.agg(F.sum("active").cast("bigint").alias("dau"),
                      F.count_if(F.col("first_dt") == _d(day)).alias("new_mid"))
    rows = F.array(
        F.struct(F.lit(params.KPI_DAU[0]).alias("id"), F.lit(params.KPI_DAU[1]).alias("name"),
                 F.coalesce(F.col("dau"), F.lit(0)).cast("bigint").alias("value")),
        F.struct(F.lit(params.KPI_NEW_MID[0]).alias("id"), F.lit(params.KPI_NEW_MID[1]).alias("name"),
                 F.col("new_mid").cast("bigint").alias("value")))
    return tot.select(F.inline(rows))
