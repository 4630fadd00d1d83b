"""App-log operators: parse (P1), quarantine, content split (P7), flatten with
nested access (P3, P4) and day/hour keys (P5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.time import epoch_ms_to_date, epoch_ms_to_hour
from daypulse.schemas import APP_LOG

_PARSE_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def parsed_once(parsed: Column, name: str) -> Column:
    """Evaluate a parse once per row. Filters on parsed fields are pushed
    below the projection by Catalyst, which substitutes the alias and would
    run the parse once per referenced field (six times for the log filter).
    A one-element generator is a boundary filters cannot cross, so the parse
    runs exactly once and downstream filters read its output."""
    return F.inline(F.array(F.struct(parsed.alias(name))))


def plausible(ms: Column, arrival_ms: Column, ahead_ms: int, behind_ms: int) -> Column:
    known = ms.between(arrival_ms - F.lit(behind_ms), arrival_ms + F.lit(ahead_ms))
    return F.coalesce(known, ms.between(F.lit(0), F.lit(params.LATEST_TS_MS)))


def parse_logs(records: DataFrame, offset_ms: int = 0, max_ahead_ms: int = params.LOG_MAX_AHEAD_MS,
               max_behind_ms: int = params.LOG_MAX_BEHIND_MS) -> DataFrame:
    """Kafka-shaped log records -> one row per record with the parsed fields,
    a quarantine ``reason`` (null for good rows) and the content ``kind``.

    Bad JSON does not fail the batch (it did in the reference): it gets
    ``reason='malformed_json'``; a line without ``common.mid`` gets
    ``'missing_mid'``; without ``ts``, ``'missing_ts'``. A device clock is not
    trusted: ``ts`` more than ``max_ahead_ms`` after the record's arrival or
    ``max_behind_ms`` before it (from 1970 to 2100 where no arrival is known)
    gives ``'bad_ts'``, so that no line can move a watermark, open a far-off
    day or overflow."""
    p = records.select("partition", "offset", "value", "timestamp",
                       parsed_once(F.from_json(F.col("value"), APP_LOG, _PARSE_OPTS), "j"))
    reason = (F.when(F.col("j").isNull() | F.col("j._corrupt_record").isNotNull(), F.lit("malformed_json"))
              .when(F.col("j.common.mid").isNull(), F.lit("missing_mid"))
              .when(F.col("j.ts").isNull(), F.lit("missing_ts"))
              .when(~plausible(F.col("j.ts"), F.unix_millis("timestamp"), max_ahead_ms, max_behind_ms),
                    F.lit("bad_ts")))
    start = F.col("j.start")
    kind = F.when(start.isNotNull() & (F.length(start) > 0), F.lit("start")).otherwise(F.lit("event"))
    ms = F.col("j.ts")
    return p.select(
        "partition", "offset", "value",
        reason.alias("reason"),
        kind.alias("kind"),
        F.col("j.common.mid").alias("mid"),
        F.col("j.common.uid").alias("uid"),
        F.col("j.common.ar").alias("ar"),
        F.col("j.common.ch").alias("ch"),
        F.col("j.common.vc").alias("vc"),
        ms.alias("ts"),
        F.when(reason.isNull(), epoch_ms_to_date(ms, offset_ms)).alias("dt"),
        F.when(reason.isNull(), epoch_ms_to_hour(ms, offset_ms)).alias("hr"),
        F.col("timestamp").alias("arrival"),
    )


def good_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def start_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull() & (F.col("kind") == "start"))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows that failed parsing, with the raw line kept for repair."""
    return parsed.where(F.col("reason").isNotNull()).select("partition", "offset", "reason", "value")


def route_topic(parsed: DataFrame) -> DataFrame:
    """Content split of the collector: start logs and event logs go to two
    topics, keyed by device so that a replay keeps the same key (the
    reference used a random UUID)."""
    topic = F.when(F.col("kind") == "start", F.lit(params.START_TOPIC)).otherwise(F.lit(params.EVENT_TOPIC))
    return good_logs(parsed).select(topic.alias("topic"), F.col("mid").alias("key"), "value", "dt")


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    return quarantine(parsed).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def split_counts(parsed: DataFrame) -> DataFrame:
    return route_topic(parsed).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
