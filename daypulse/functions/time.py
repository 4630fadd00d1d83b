"""Time keys. All arithmetic on epoch milliseconds, so results do not depend
on the JVM or session zone; a business zone is an offset parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000


def ntz_to_epoch_ms(ts: Column) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC -> epoch milliseconds (truncated)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def epoch_ms_to_date(ms: Column, offset_ms: int = 0) -> Column:
    """Calendar day of an epoch-ms instant (DATE); null beyond the range of days."""
    return F.date_from_unix_date(F.floor((ms + F.lit(offset_ms)) / F.lit(MS_PER_DAY)).try_cast("int"))


def epoch_ms_to_hour(ms: Column, offset_ms: int = 0) -> Column:
    """Two-digit hour '00'..'23' of an epoch-ms instant."""
    h = F.floor(F.pmod(ms + F.lit(offset_ms), F.lit(MS_PER_DAY)) / F.lit(MS_PER_HOUR))
    return F.lpad(h.cast("string"), 2, "0")


def time_string_parts(s: Column) -> tuple[Column, Column]:
    """'yyyy-MM-dd HH:mm:ss' text -> (create_date, create_hour) text parts.

    A null string or a date-only string gives null parts instead of the
    reference's crash; the hour part is null when there is no time part."""
    parts = F.split(s, " ")
    date_part = F.try_element_at(parts, F.lit(1))
    time_part = F.try_element_at(parts, F.lit(2))
    hour_part = F.try_element_at(F.split(time_part, ":"), F.lit(1))
    return date_part, hour_part


def time_string_seconds(s: Column) -> Column:
    """Seconds of 'yyyy-MM-dd HH:mm:ss' or date-only text; null for any other text."""
    whole = F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.unix_timestamp(F.coalesce(whole, F.try_to_timestamp(s, F.lit("yyyy-MM-dd"))))


def hour_grid(spark: SparkSession) -> DataFrame:
    """The 24 hour keys '00'..'23' (a fixed, 24-row table)."""
    return spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))
