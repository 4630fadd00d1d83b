"""Active devices per hour out of the stream itself (A2, §2.9 windows).

Two stateful operators in one query: the first start log of each device and day,
then the devices of each day by the hour of that log. In append mode a row comes
out once, when the watermark has passed the day: only then can no earlier log
move a device to another hour. The days that are still open lie in the engine's
state, from which their hours as of now are counted. Nothing is read back from a
table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.functions.time import epoch_ms_to_hour
from daypulse.operators.logs import parse_logs, start_logs
from daypulse.sinks.parts import read_parts, write_batch


def hours_of_closed_days(records: DataFrame, delay: str) -> DataFrame:
    """``dt, hr, n`` of every day that ended ``delay`` or more before the newest
    start log. Rows later than that are dropped by the engine. Both aggregates
    combine before their shuffle; the second sees one row per device and day."""
    starts = start_logs(parse_logs(records)).select("mid", "ts", F.timestamp_millis("ts").alias("at"))
    day = F.window("at", "1 day").alias("day")
    firsts = starts.withWatermark("at", delay).groupBy(day, "mid").agg(F.min("ts").alias("ts"))
    again = F.window(F.window_time("day"), "1 day").alias("day")
    per_hour = firsts.groupBy(again, epoch_ms_to_hour(F.col("ts")).alias("hr")).agg(F.count(F.lit(1)).alias("n"))
    return per_hour.select(F.to_date("day.start").alias("dt"), "hr", "n")


def hour_sink(table: str):
    """Each batch's closed hours as parts of their days."""
    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(df, table, "dt", batch_id)
    return sink


def hour_table(spark: SparkSession, table: str) -> DataFrame:
    return read_parts(spark, table, "dt").select("dt", "hr", "n")


def open_hours(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``dt, hr, n`` of the days that the watermark has not closed, as of the last
    batch: devices whose first log so far is in the state of the first operator,
    and hours that the second holds."""
    hours = []
    for operator in (0, 1):
        state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
        dt = F.to_date("key.window.start").alias("dt")
        if "mid" in state.schema["key"].dataType.names:
            hr = epoch_ms_to_hour(F.col("value.min")).alias("hr")
            hours.append(state.groupBy(dt, hr).agg(F.count(F.lit(1)).alias("n")))
        else:
            hr, n = state.schema["key"].dataType.names[1], state.schema["value"].dataType.names[0]
            hours.append(state.select(dt, F.col(f"key.{hr}").alias("hr"), F.col(f"value.{n}").alias("n")))
    return hours[0].unionByName(hours[1])


def all_hours(spark: SparkSession, table: str, checkpoint: str) -> DataFrame:
    """Hours of every day: those that the stream has emitted and those still open."""
    still = open_hours(spark, checkpoint)
    if read_parts(spark, table, "dt") is not None:
        still = still.unionByName(hour_table(spark, table))
    return still.groupBy("dt", "hr").agg(F.sum("n").alias("n"))
