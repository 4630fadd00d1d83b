"""Active-device streams (T1, T2, T3, T4, P8).

``start_state_dedup``: first arrival per (day, device) kept by the state
store of ``dropDuplicates`` under an event-time watermark on the day start
(the reference kept an external per-day key set with a 24 h expiry). A day's state
is dropped once the watermark passes it; rows for such a day are late and
dropped (counted in ``numRowsDroppedByWatermark``).

``starts_with_devices`` and ``device_sink``: the same keys, but the earliest row
of a key inside its first micro-batch is kept (``min`` per key), and the rows that
came too late for their day are written to a table of their own, which
``reconcile`` repairs from. Membership is the engine's state per device and day
(``streaming.keyed``), so a batch reads none of the daily table.

All write parts tables of ``sinks.parts`` by day: a replayed batch rewrites
exactly its own parts, so at-least-once delivery leaves no duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypulse import params
from daypulse.functions.time import MS_PER_DAY
from daypulse.operators.dedup import DAU_COLUMNS, daily_active, first_per_key
from daypulse.operators.logs import parse_logs, start_logs
from daypulse.sinks.parts import merge_parts, read_parts, write_batch
from daypulse.sources.files import stream_records
from daypulse.streaming.conf import stream_session
from daypulse.streaming.keyed import EVER, counted, rows_of, touched_keys, with_state

#: Tasks that share a device's rows before its state task sees one row of each.
SPREAD = 8


def day_start(ts_ms_col: str = "ts"):
    return F.timestamp_millis(F.floor(F.col(ts_ms_col) / F.lit(MS_PER_DAY)) * F.lit(MS_PER_DAY))


def days_of(df: DataFrame) -> list:
    """Days of a batch. Few: the parse bounds ``ts`` by the arrival time."""
    return sorted(r.dt for r in df.select("dt").distinct().collect())


def first_arrivals(start: DataFrame, delay: str, spread: int = SPREAD) -> DataFrame:
    """Start logs, one per (day, device) ever. A first stage keeps one row per
    device and part, so that a device with a third of all rows is deduplicated
    in ``spread`` tasks and its own state task gets that many rows."""
    part = F.pmod(F.xxhash64("partition", "offset"), F.lit(spread))
    return (start.withColumn("day_ts", day_start()).withColumn("_part", part)
            .withWatermark("day_ts", delay)
            .dropDuplicates(["day_ts", "mid", "_part"]).dropDuplicates(["day_ts", "mid"]))


def start_state_dedup(spark: SparkSession, landing: str, table: str, checkpoint: str, delay: str,
                      state_partitions: int, max_files: int | None = None) -> StreamingQuery:
    records = stream_records(stream_session(spark, state_partitions), landing, max_files)

    def sink(df: DataFrame, batch_id: int) -> None:
        rows = df.select(*DAU_COLUMNS).persist()
        try:
            write_batch(rows, table, "dt", batch_id)
            merge_parts(rows.sparkSession, table, "dt", days_of(rows), params.MERGE_EVERY)
        finally:
            rows.unpersist()

    return (first_arrivals(start_logs(parse_logs(records)), delay).writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint).queryName("dau_state_dedup")
            .trigger(availableNow=True).start())


def starts_with_devices(records: DataFrame, delay: str) -> DataFrame:
    """Start logs beside the state of their devices: per day and device the
    number of start logs, until the watermark passes the day."""
    starts = start_logs(parse_logs(records)).select(*DAU_COLUMNS, "partition", "offset")
    days = starts.select("mid", day_start().alias("day_ts")).withWatermark("day_ts", delay)
    seen = counted(days, ["day_ts", "mid"]).select(F.to_date("day_ts").alias("dt"), "mid", EVER)
    return with_state(starts, seen)


def device_sink(table: str, late: str, merge_every: int = params.MERGE_EVERY):
    """foreachBatch body over ``starts_with_devices``: the first row of each
    device that is new on its day goes to ``table``, that of each device whose
    day was closed to ``late``. Both come from the batch alone."""
    def sink(df: DataFrame, batch_id: int) -> None:
        batch = df.persist()
        firsts = (daily_active(rows_of(batch), count="n_now")
                  .join(touched_keys(batch), ["dt", "mid"], "left").persist())
        try:
            days = days_of(firsts)
            for path, wanted in ((table, F.col("n_now") == F.col(EVER)), (late, F.col(EVER).isNull())):
                write_batch(firsts.where(wanted).select(*DAU_COLUMNS), path, "dt", batch_id)
                merge_parts(df.sparkSession, path, "dt", days, merge_every)
        finally:
            firsts.unpersist()
            batch.unpersist()
    return sink


def late_rows(spark: SparkSession, late: str, days=None) -> DataFrame | None:
    """First row per (dt, mid) of those that came too late, None without any."""
    rows = read_parts(spark, late, "dt", days)
    return None if rows is None else first_per_key(rows, ["dt", "mid"], ["ts"], ["uid", "ar", "ch", "vc", "hr"]
                                                   ).select(*DAU_COLUMNS)


def daily_table(spark: SparkSession, table: str, days=None) -> DataFrame:
    """The active-device table as of now (of the given days)."""
    return read_parts(spark, table, "dt", days).select(*DAU_COLUMNS)


def stream_keys(spark: SparkSession, table: str, days=None) -> DataFrame | None:
    """(dt, mid) keys that the stream itself has written (of the given days),
    repairs left out; None if there are none."""
    rows = read_parts(spark, table, "dt", days, repaired=False)
    return None if rows is None else rows.select("dt", "mid")
