"""Gapless numbers for distinct keys without a window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts that the keys are ranked in.
PARTS = 256


def numbered(keys: DataFrame, key: str, out: str, after: int = 0, parts: int = PARTS) -> DataFrame:
    """``key, out``: each distinct key with a number from ``after + 1`` on. Keys
    are dealt to parts by hash, ranked inside their part and moved up by the sizes
    of the parts before, so the numbers depend on the keys alone."""
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    dealt = keys.select(key, part.alias("_part"))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))       # at most ``parts`` rows
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return (dealt.withColumn("_rank", rank).join(starts, "_part")
            .select(key, (F.col("_rank") + F.col("_before") + F.lit(after)).cast("long").alias(out)))
