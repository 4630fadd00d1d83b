"""Kafka source, configuration-driven (S1, S2); the sink is in ``sinks.topics``.

Not exercised here: the image has no Kafka connector and no network. The
file twin in ``sources.files`` yields the same columns."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, bootstrap: str, topic: str, *, streaming: bool = True,
                 starting_offsets: dict | str = "latest", group_id: str | None = None,
                 min_partitions: int | None = None, max_offsets: int | None = None) -> DataFrame:
    """Topic -> ``key, value, topic, partition, offset, timestamp`` with string
    key and value. ``starting_offsets`` is "latest", "earliest" or the
    per-partition map of a manual rewind, e.g. ``{"t": {"0": 42}}``; a
    restarted stream resumes from its checkpoint and ignores it."""
    r = spark.readStream if streaming else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
         .option("startingOffsets", starting_offsets if isinstance(starting_offsets, str)
                 else json.dumps(starting_offsets)))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    if max_offsets and streaming:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"),
                           "topic", "partition", "offset", "timestamp")

