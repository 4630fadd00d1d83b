"""Keyed first-arrival and last-writer-wins operators.

Both are expressed as an aggregate of ``min``/``max`` over a struct whose
leading fields are the order key. Unlike ``row_number`` over a window this
combines map-side before the shuffle, so a key holding a third of all rows
collapses to one row per task before it moves."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(name: str | None) -> list:
    """Rows per key as one more aggregate, if a name is given."""
    return [F.count(F.lit(1)).alias(name)] if name else []


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  carry: Sequence[str], count: str | None = None) -> DataFrame:
    """Earliest row per key by ``order`` (ties broken by later order fields).
    ``count`` names a column for the number of its rows."""
    packed = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in carry])).alias("_first")
    out = df.groupBy(*keys).agg(packed, *counts(count))
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in (*order, *carry)], *([count] if count else []))


def last_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str],
                 carry: Sequence[str]) -> DataFrame:
    """Latest row per key by ``version`` (an upsert where the last writer wins,
    whatever the arrival order)."""
    packed = F.max(F.struct(*[F.col(c) for c in version], *[F.col(c) for c in carry])).alias("_last")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in (*version, *carry)])


DAU_COLUMNS = ("mid", "uid", "ar", "ch", "vc", "dt", "hr", "ts")


def daily_active(start: DataFrame, count: str | None = None) -> DataFrame:
    """One row per (dt, mid): the first start log of that device that day
    (smallest ts, then Kafka partition and offset). The batch form of the
    reference's per-day membership set. ``count`` names a column for the number
    of its start logs."""
    first = first_per_key(start, ["dt", "mid"], ["ts", "partition", "offset"],
                          ["uid", "ar", "ch", "vc", "hr"], count)
    return first.select(*DAU_COLUMNS, *([count] if count else []))


def daily_active_keys(start: DataFrame, offset_ms: int = 0) -> DataFrame:
    """``dt, mid, hr, ts`` of the first start log per (dt, mid), for figures
    that need no other attribute of the row. The hour is a function of the
    first ``ts`` (equal times give equal hours), so ``min(ts)`` -- a
    fixed-width hash aggregate with map-side combine -- replaces the
    sort-based ``min(struct)`` that string attributes require."""
    from daypulse.functions.time import epoch_ms_to_hour
    first = start.groupBy("dt", "mid").agg(F.min("ts").alias("ts"))
    return first.select("dt", "mid", epoch_ms_to_hour(F.col("ts"), offset_ms).alias("hr"), "ts")


_SPAN = Decimal(2 ** 64)             # BIGINT ids, moved up by half of it, are below
_HALF = Decimal(2 ** 63)
_TIME_SHIFT = Decimal(10 ** 12)      # beyond any second of years -9999 to 9999
_NO_TIME = Decimal(3 * 10 ** 12)     # sorts after every time


def first_id_per_key(df: DataFrame, keys: Sequence[str], time_s: str, id_col: str,
                     count: str | None = None) -> DataFrame:
    """Per key, the id of the earliest row by (time, id), as ``first_id``. Rows
    without a time come after those with one; rows without an id cannot be
    first, and a key with none but such rows gets null.

    (time seconds, id) is packed into one DECIMAL(38,0), both moved to be
    non-negative, so that ``min`` runs as a fixed-width hash aggregate with
    map-side combine (a struct ordering would need the sort-based one)."""
    def dec(x):
        return F.lit(x).cast("decimal(38,0)")

    time = F.coalesce(F.col(time_s).cast("decimal(38,0)") + dec(_TIME_SHIFT), dec(_NO_TIME)).cast("decimal(18,0)")
    key = (time * F.lit(_SPAN).cast("decimal(20,0)")).cast("decimal(38,0)") + (
        F.col(id_col).cast("decimal(38,0)") + dec(_HALF))
    m = df.groupBy(*keys).agg(F.min(key.cast("decimal(38,0)")).alias("_k"), *counts(count))
    first = (F.pmod(F.col("_k"), dec(_SPAN)) - dec(_HALF)).cast("long")
    return m.select(*keys, first.alias("first_id"), *([count] if count else []))
