"""Audit of offset ranges (S2, S4): continuity per partition, and the way back
to the start of a batch.

An audit table has a row per micro-batch, topic and partition: ``batch_id, topic,
partition, from_offset, until_offset`` (the first offset read and the one after
the last)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def continuity(audit: DataFrame, max_gap: int = 0) -> DataFrame:
    """``topic, partition, batch_id, kind, from_offset, until_offset``: where a
    batch does not begin where those before it ended. ``hole``: offsets that no
    batch up to then has read, beyond ``max_gap`` (a compacted topic has gaps);
    ``overlap``: offsets read twice; ``reset``: the batch lies wholly before the
    first offset ever read, as after a topic was made anew.

    The window runs over one row per batch of a partition; it compares with the
    furthest offset so far, so a hole is reported once however batches overlap."""
    w = (Window.partitionBy("topic", "partition").orderBy("batch_id")
         .rowsBetween(Window.unboundedPreceding, -1))
    a = (audit.withColumn("reached", F.max("until_offset").over(w))
         .withColumn("began", F.min("from_offset").over(w)))
    reset = F.col("until_offset") <= F.col("began")
    kind = (F.when(F.col("reached").isNull(), None)
            .when(reset, F.lit("reset"))
            .when(F.col("from_offset") < F.col("reached"), F.lit("overlap"))
            .when(F.col("from_offset") > F.col("reached") + F.lit(max_gap), F.lit("hole")))
    found = a.withColumn("kind", kind).where(F.col("kind").isNotNull())
    first = F.when(F.col("kind") == "hole", F.col("reached")).otherwise(F.col("from_offset"))
    last = (F.when(F.col("kind") == "hole", F.col("from_offset"))
            .when(F.col("kind") == "overlap", F.least("reached", "until_offset")).otherwise(F.col("until_offset")))
    return found.select("topic", "partition", "batch_id", "kind", first.alias("from_offset"), last.alias("until_offset"))


def runs(audit: DataFrame) -> DataFrame:
    """``topic, partition, first_batch, last_batch, from_offset, until_offset``:
    the unbroken stretches of offsets that were read, whatever the order of the
    batches (gaps and islands over ranges)."""
    by = Window.partitionBy("topic", "partition").orderBy("from_offset", "until_offset", "batch_id")
    before = F.max("until_offset").over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = (before.isNull() | (F.col("from_offset") > before)).cast("int")
    island = F.sum("begins").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (audit.withColumn("begins", begins).withColumn("island", island)
            .groupBy("topic", "partition", "island")
            .agg(F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"),
                 F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"))
            .drop("island"))


def offsets_at(audit: DataFrame, batch_id: int) -> DataFrame:
    """``topic, partition, offset``: where each partition stood when batch
    ``batch_id`` began. A partition that the batch did not touch stands where
    the last batch before it ended, or where its first later one begins."""
    started = F.min(F.when(F.col("batch_id") >= batch_id, F.struct("batch_id", "from_offset")))
    ended = F.max(F.when(F.col("batch_id") < batch_id, F.struct("batch_id", "until_offset")))
    per = audit.groupBy("topic", "partition").agg(started.alias("s"), ended.alias("e"))
    at = (F.when(F.col("s.batch_id") == batch_id, F.col("s.from_offset"))
          .otherwise(F.coalesce("e.until_offset", "s.from_offset")))
    return per.select("topic", "partition", at.alias("offset"))


def rewind(audit: DataFrame, batch_id: int) -> dict[str, dict[str, int]]:
    """``startingOffsets`` of a new stream that begins with batch ``batch_id``
    again. One entry per partition of the topics."""
    out: dict[str, dict[str, int]] = {}
    for r in offsets_at(audit, batch_id).collect():
        out.setdefault(r.topic, {})[str(r.partition)] = r.offset
    return out
