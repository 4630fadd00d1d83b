"""Deployable stream jobs (T7), left running with a processing-time trigger:
active devices, order enrichment, change fan-out and the collector split.

Source: a Kafka topic (``sources.kafka.read_records``) or the file twin; topic
sinks likewise (``sinks.topics``). The checkpoint's commit log is the resume
point (S2, S3); the offset ranges of a batch are in the query's progress."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypulse import params
from daypulse.operators import cdc
from daypulse.operators.cdc import offset_ranges
from daypulse.operators.logs import parse_logs, quarantine, route_topic
from daypulse.sinks.parts import groups, merge_parts, write_parts
from daypulse.sinks.topics import TopicSink
from daypulse.sources.files import stream_records
from daypulse.sources.kafka import read_records
from daypulse.streaming.conf import stream_session
from daypulse.streaming.dau import device_sink, starts_with_devices
from daypulse.streaming.first_order import Dimensions, order_sink, orders_with_users, typed_order_stream
from daypulse.streaming.hours import hour_sink, hours_of_closed_days

Body = Callable[[DataFrame, int], None]


def source(spark: SparkSession, state_partitions: int, *, bootstrap: str | None = None, topic: str | None = None,
           landing: str | None = None, max_offsets: int | None = None, max_files: int | None = None,
           group_id: str | None = None, starting_offsets: dict | str = "latest",
           min_partitions: int | None = None) -> DataFrame:
    """Kafka when ``bootstrap`` is given, else the landing folder, in a session
    of its own. ``max_offsets`` and ``max_files`` cap a micro-batch; ``group_id``,
    ``starting_offsets`` (a name, or the map of ``operators.offsets.rewind``) and
    ``min_partitions`` are the topic's."""
    own = stream_session(spark, state_partitions)
    if bootstrap:
        return read_records(own, bootstrap, topic or "", streaming=True, max_offsets=max_offsets, group_id=group_id,
                            starting_offsets=starting_offsets, min_partitions=min_partitions)
    return stream_records(own, landing, max_files)


def start_job(rows: DataFrame, body: Body, checkpoint: str, name: str, interval: str | None = "5 seconds",
              mode: str = "append") -> StreamingQuery:
    """Runs ``body`` on each micro-batch every ``interval``; without one, over
    all that is there, and ends."""
    writer = rows.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.outputMode(mode).start()


def once(body: Body) -> Body:
    """The batch is read and parsed once however many outputs it feeds."""
    def held(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            body(df, batch_id)
        finally:
            df.unpersist()
    return held


def write_audit(batch: DataFrame, batch_id: int, audit_path: str) -> None:
    rows = offset_ranges(batch, F.lit(batch_id).cast("bigint")).drop("batch_id")
    write_parts(rows, audit_path, "topic", f"b-{batch_id:012d}", batch_id)


def audit_job(records: DataFrame, audit: str, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """The offset ranges of every micro-batch, for ``operators.offsets``."""
    return start_job(records, lambda df, batch_id: write_audit(df, batch_id, audit), checkpoint, "audit_job", interval)


def dau_job(records: DataFrame, table: str, late: str, checkpoint: str, delay: str,
            interval: str | None = "5 seconds") -> StreamingQuery:
    """Active-device job: the first start log of each device and day; those that
    came after the watermark had closed their day go to ``late``."""
    return start_job(starts_with_devices(records, delay), device_sink(table, late), checkpoint, "dau_job", interval,
                     "update")


def hour_job(records: DataFrame, table: str, checkpoint: str, delay: str,
             interval: str | None = "5 seconds") -> StreamingQuery:
    """Active devices per hour of each day that the watermark has closed."""
    return start_job(hours_of_closed_days(records, delay), hour_sink(table), checkpoint, "hour_job", interval)


def order_job(records: DataFrame, table: str, dimensions: Dimensions | None, checkpoint: str,
              interval: str | None = "5 seconds") -> StreamingQuery:
    """Order job: typed orders, time parts, first-order flag against the user
    state, province and user merged as of the batch, saved."""
    return start_job(orders_with_users(typed_order_stream(records)), order_sink(table, dimensions), checkpoint,
                     "order_job", interval, "update")


def fan_out_job(records: DataFrame, sink: TopicSink, checkpoint: str, interval: str | None = "5 seconds",
                once_within: str | None = None) -> StreamingQuery:
    """Change fan-out: every changed row of every table as JSON to its topic.
    With ``once_within``, a change that the source delivers again within that
    time, in the same batch or a later one, is sent on once (T5)."""
    rows = cdc.explode_rows(cdc.parse_envelopes(records))
    return start_job(cdc.routed(cdc.once(rows, once_within) if once_within else rows), sink, checkpoint,
                     "fan_out_job", interval)


def console_preview(rows: DataFrame, n: int = 1000, interval: str | None = "5 seconds") -> StreamingQuery:
    """Print sink for inspection (S9, L4): the first ``n`` rows of each batch."""
    writer = rows.writeStream.format("console").option("numRows", n).option("truncate", False)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def compact(spark: SparkSession, table: str, by: str, values: Iterable | None = None,
            every: int = params.MERGE_EVERY) -> None:
    """Maintenance of tables that batches only append to (orders by month, topics,
    audit, quarantine), run beside their stream, daily say: each group (of
    ``values``) with ``every`` parts or more becomes one part. A reader lists few
    files again; what is merged is deleted by the next run, so frames built before
    it still run, and a batch that is delivered again changes nothing."""
    merge_parts(spark, table, by, groups(spark, table, by) if values is None else values, every)


def log_split_job(records: DataFrame, sink: TopicSink, quarantine_path: str, checkpoint: str,
                  interval: str | None = "5 seconds") -> StreamingQuery:
    """Collector split: start logs and event logs to their topics, bad lines to
    the quarantine with their reason."""
    def body(df: DataFrame, batch_id: int) -> None:
        sink(route_topic(df), batch_id)
        write_parts(quarantine(df), quarantine_path, "reason", f"b-{batch_id:012d}", batch_id)

    return start_job(parse_logs(records), once(body), checkpoint, "log_split_job", interval)
