"""Join of many rows with a keyed table when a few keys hold many of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most frequent keys are split, this many of them, into so many parts each.
HOT_KEYS, PARTS = 256, 32


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """``key, _n``: rows per key, combined before the shuffle."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def split_join(rows: DataFrame, keyed: DataFrame, key: str, spread_by: Sequence[str], how: str = "inner",
               keys_from: DataFrame | None = None, hot_keys: int = HOT_KEYS, parts: int = PARTS,
               counts: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``keyed`` (one row per ``key``) without a key meeting
    in one task.

    The ``hot_keys`` most frequent keys come from an aggregate with map-side
    combine and a top-k, so that list is bounded and safe to broadcast. It is
    taken from ``counts`` (``key, _n``, as a kept table has them), or counted on
    ``keys_from``, a cheap frame with the same keys (a scan or a written table),
    or on ``rows`` if those are cheap to read twice. Which keys are in the list
    never changes the result. Rows of those keys are dealt to ``parts`` by a hash of ``spread_by``, and their
    keyed rows are repeated once per part. Any other key stays whole; the result
    is that of a plain join at every size."""
    if counts is None:
        counts = key_counts(rows if keys_from is None else keys_from, key)
    hot = counts.orderBy(F.col("_n").desc(), key).limit(hot_keys).select(key, F.lit(True).alias("_hot"))
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(parts)).cast("int")).otherwise(F.lit(0))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("_part", part).drop("_hot")
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    one = F.array(F.lit(0))
    repeated = (keyed.join(F.broadcast(hot), key, "left")
                .withColumn("_part", F.explode(F.when(F.col("_hot"), every).otherwise(one))).drop("_hot"))
    return dealt.join(repeated, [key, "_part"], how).drop("_part")
