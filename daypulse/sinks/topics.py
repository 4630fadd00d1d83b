"""Per-row topic sinks of a micro-batch: Kafka, or its file twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from daypulse.sinks.parts import write_batch

TopicSink = Callable[[DataFrame, int], None]


def kafka_topics(bootstrap: str) -> TopicSink:
    """Each row to its own ``topic``, keyed, so that a batch that is sent twice
    puts the same keys to the same place."""
    def sink(rows: DataFrame, batch_id: int) -> None:
        (rows.select("topic", "key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).save())
    return sink


def file_topics(path: str) -> TopicSink:
    """One folder per topic and batch; a batch sent twice rewrites its own."""
    def sink(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows.select("topic", "key", "value"), path, "topic", batch_id)
    return sink
