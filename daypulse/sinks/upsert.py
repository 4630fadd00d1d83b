"""Keyed upsert into a Parquet table (the daily index / keyed store of the
reference, without MERGE).

A batch appends only its own latest rows per key; the highest version is
resolved when the table is read, and merges keep the number of parts per bucket
bounded. Nothing that a batch does not change is read, moved or rewritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.operators.dedup import last_per_key
from daypulse.sinks.parts import merge_parts, read_parts, write_batch


def bucket_of(key_col: str, buckets: int):
    """Stable hash bucket of a key (partition column of a keyed table)."""
    return F.pmod(F.xxhash64(F.col(key_col)), F.lit(buckets)).cast("int")


def upsert(spark: SparkSession, changes: DataFrame, path: str, batch_id: int, key: str,
           version: Sequence[str], carry: Sequence[str], buckets: int, merge_every: int) -> None:
    """Apply ``changes`` as batch ``batch_id``: per ``key`` the row with the
    highest ``version`` wins, whatever the order of arrival and however often a
    batch is delivered. ``buckets`` bounds the folders of the table; choose it
    for its size, as a bucket is merged as a whole. Buckets that the batch does not
    touch are neither listed nor merged."""
    latest = last_per_key(changes, [key], version, carry).withColumn("bucket", bucket_of(key, buckets)).persist()
    try:
        write_batch(latest.repartition("bucket"), path, "bucket", batch_id)
        touched = sorted(r.bucket for r in latest.select("bucket").distinct().collect())
    finally:
        latest.unpersist()
    merge_parts(spark, path, "bucket", touched, merge_every,
                lambda rows: last_per_key(rows, [key], version, [*carry, "batch_id"]))


def current(spark: SparkSession, path: str, key: str, version: Sequence[str],
            carry: Sequence[str]) -> DataFrame | None:
    """The table as of now: one row per key."""
    rows = read_parts(spark, path, "bucket")
    return None if rows is None else last_per_key(rows, [key], version, carry)
