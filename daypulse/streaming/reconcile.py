"""Late-row repair (T2).

The device stream writes the rows it had to drop to a table of their own
(``dau.device_sink``), so a repair reads those and the keys of their days,
nothing else. ``recompute`` makes any days anew from the raw archive, for when a
table is lost or its rule has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.functions.time import MS_PER_DAY
from daypulse.operators.dedup import daily_active
from daypulse.operators.logs import parse_logs, start_logs
from daypulse.sinks.parts import groups, write_parts
from daypulse.streaming.dau import late_rows, stream_keys


def late_days(archive: DataFrame, delay_ms: int) -> list:
    """Days that can have lost rows: a row is late only if it arrived more than
    ``delay_ms`` after the start of its day, so other days need no recompute.
    Few: the parse bounds ``ts`` by the arrival time."""
    rows = start_logs(parse_logs(archive))
    start = F.floor(F.col("ts") / F.lit(MS_PER_DAY)) * F.lit(MS_PER_DAY)
    late = rows.where(F.unix_millis("arrival") - start > F.lit(delay_ms)).select("dt").distinct()
    return sorted(r.dt for r in late.collect())


def recompute(archive: DataFrame, days: list, max_ahead_days: int = 1, max_behind_days: int = 30) -> DataFrame:
    """Active devices of ``days`` from the archive, read only for the arrival
    days on which a log of those days can have come in."""
    days_lit = [F.lit(d) for d in days]
    first, last = min(days), max(days)
    seen = archive.where(F.col("arrival_dt").between(F.date_sub(F.lit(first), max_ahead_days),
                                                     F.date_add(F.lit(last), max_behind_days + 1)))
    return daily_active(start_logs(parse_logs(seen)).where(F.col("dt").isin(*days_lit)))


def reconcile(stream_keys: DataFrame, batch_keys: DataFrame) -> DataFrame:
    """``kept`` = the stream has the key; ``repaired`` = only the recompute
    has it (its rows came after the watermark); ``extra`` = only the stream
    (must not happen). One full outer join on (dt, mid), both sides unique."""
    s = stream_keys.select("dt", "mid", F.lit(True).alias("_s"))
    b = batch_keys.select("dt", "mid", F.lit(True).alias("_b"))
    j = s.join(b, ["dt", "mid"], "full_outer")
    status = (F.when(F.col("_s") & F.col("_b"), F.lit("kept"))
              .when(F.col("_b"), F.lit("repaired")).otherwise(F.lit("extra")))
    return j.select("dt", "mid", status.alias("status"))


REPAIR, REPAIR_BATCH = "r", -1


def repair(table: str, batch_rows: DataFrame, stream_keys: DataFrame) -> None:
    """Write the rows the stream missed into the daily table, each day's part
    ``r``. ``stream_keys`` are the stream's own (``dau.stream_keys``), without
    earlier repairs: a later repair of a day therefore writes the earlier rows
    again with the new ones, and any number of runs leave the same table. Later
    micro-batches treat repaired rows as prior keys."""
    missing = batch_rows.join(stream_keys.select("dt", "mid"), ["dt", "mid"], "left_anti")
    write_parts(missing, table, "dt", REPAIR, REPAIR_BATCH)


def repair_late(spark: SparkSession, table: str, late: str, days: list | None = None) -> DataFrame | None:
    """Writes the devices of the late table (of ``days``, or of all its days) that
    the stream does not have into the daily table, and returns their keys; None
    if nothing came late. Reads the late rows and the keys of their days. Any
    number of runs leave the same table."""
    found = groups(spark, late, "dt") if days is None else [str(d) for d in days]
    rows = late_rows(spark, late, found) if found else None
    if rows is None:
        return None
    known = stream_keys(spark, table, found)
    missing = rows if known is None else rows.join(known, ["dt", "mid"], "left_anti")
    write_parts(missing, table, "dt", REPAIR, REPAIR_BATCH)
    return missing.select("dt", "mid")
