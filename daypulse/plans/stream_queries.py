"""Stream group: the streaming jobs replayed window by window over the
supplied tables, each compared with its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypulse import params
from daypulse.plans.cdc_queries import ROUTED_SQL, two_table_records
from daypulse.plans.oracle_common import DAU_CTE, FIRST_CTE, LOGS_CTE
from daypulse.plans.order_queries import WIDE_ORDER_SQL, dimensions, wide_columns
from daypulse.plans.registry import query
from daypulse.session import work_path
from daypulse.sinks.parts import read_parts
from daypulse.sinks.topics import file_topics
from daypulse.sources.replay import app_log_records, cdc_records
from daypulse.streaming import dau as dau_stream
from daypulse.streaming import jobs
from daypulse.streaming.first_order import order_table
from daypulse.streaming.hours import all_hours
from daypulse.streaming.reconcile import repair_late
from daypulse.streaming.runner import replay_windows

STATE = params.STATE_PARTITIONS


def state_tasks(spark) -> int:
    """State partitions of a stream whose state grows with the orders: the cores
    that are there, so that a state task's share of a window shrinks with them."""
    return max(STATE, spark.sparkContext.defaultParallelism)


def delayed(records, hit, delay_ms: int):
    """Records where ``hit`` holds are delivered ``delay_ms`` late (their arrival
    ``timestamp`` moves)."""
    shifted = F.timestamp_millis(F.unix_millis("timestamp") + F.lit(delay_ms))
    return records.withColumn("timestamp", F.when(hit, shifted).otherwise(F.col("timestamp")))


def stalled(records, partition: int, day_from, day_to, delay_ms: int):
    """A collector partition that stalled on the given event days."""
    day = F.to_date(F.col("timestamp"))
    return delayed(records, (F.col("partition") == partition) & day.between(F.lit(day_from), F.lit(day_to)), delay_ms)


def run_state_dedup(spark, records):
    table, ckpt = work_path(spark, "dau_table"), work_path(spark, "ckpt_dau")
    progress = replay_windows(
        spark, records, params.LOG_WINDOW_MS,
        lambda landing, files: dau_stream.start_state_dedup(spark, landing, table, ckpt, params.STREAM_DELAY, STATE, files))
    return table, progress


def run_dau_job(spark, records):
    """The device job over all windows: its table, its late rows, its progress."""
    table, late, ckpt = (work_path(spark, x) for x in ("dau_table", "dau_late", "ckpt_dau"))

    def start(landing, files):
        own = jobs.source(spark, STATE, landing=landing, max_files=files)
        return jobs.dau_job(own, table, late, ckpt, params.STREAM_DELAY, interval=None)

    return table, late, replay_windows(spark, records, params.LOG_WINDOW_MS, start)


def disordered(spark, sf_dir):
    """Log records of which one collector partition is always a day late, so that
    rows come out of order within the watermark's delay."""
    return delayed(app_log_records(spark, sf_dir), F.col("partition") == params.DISORDER_PARTITION,
                   params.DISORDER_DELAY_MS)


@query("stream_dau", f"""
WITH {LOGS_CTE}
SELECT DISTINCT dt, mid FROM logs WHERE kind = 'start'
""")
def stream_dau(spark, sf_dir):
    """(dt, mid) keys kept by the watermarked state-store dedup stream, rows out
    of order."""
    table, _ = run_state_dedup(spark, disordered(spark, sf_dir))
    return dau_stream.stream_keys(spark, table)


@query("stream_device_rows", f"""
WITH {DAU_CTE}
SELECT mid, uid, ar, ch, vc, dt, hr, ts FROM dau
""")
def stream_device_rows(spark, sf_dir):
    """Device job: the whole first row of each device and day, chosen inside its
    first micro-batch against the engine's state, read back from the daily table."""
    table, _, _ = run_dau_job(spark, app_log_records(spark, sf_dir))
    return dau_stream.daily_table(spark, table)


@query("stream_hour_counts", f"""
WITH {DAU_CTE}
SELECT dt, hr, count(*) AS n FROM dau GROUP BY dt, hr
""")
def stream_hour_counts(spark, sf_dir):
    """Active devices per hour of every day, by the stream: the first log per
    device and day and the count per hour are two stateful operators of one query.
    Closed days are emitted, the last ones are read from its state. One collector
    partition is always a day late."""
    table, ckpt = work_path(spark, "hours"), work_path(spark, "ckpt_hours")

    def start(landing, files):
        records = jobs.source(spark, STATE, landing=landing, max_files=files)
        return jobs.hour_job(records, table, ckpt, params.STREAM_DELAY, interval=None)

    replay_windows(spark, disordered(spark, sf_dir), params.LOG_WINDOW_MS, start)
    return all_hours(spark, table, ckpt)


def run_order_job(spark, sf_dir, dims=None):
    table, ckpt = work_path(spark, "orders"), work_path(spark, "ckpt_orders")

    def start(landing, files):
        records = jobs.source(spark, state_tasks(spark), landing=landing, max_files=files)
        return jobs.order_job(records, table, dims, ckpt, interval=None)

    replay_windows(spark, cdc_records(spark, sf_dir, rows_per_message=1), params.ORDER_WINDOW_MS, start)
    return order_table(spark, table)


@query("stream_first_order", f"""
WITH {FIRST_CTE}
SELECT id, user_id, if_first_order FROM firsts
""")
def stream_first_order(spark, sf_dir):
    """First-order flag from the engine's state per user across micro-batches
    (orders replayed in create-time order, one window per year)."""
    return run_order_job(spark, sf_dir).select("id", "user_id", "if_first_order")


@query("stream_order_wide", WIDE_ORDER_SQL)
def stream_order_wide(spark, sf_dir):
    """Order job: typed, flagged against the user state, province and user of
    that moment merged, saved; read back as wide rows."""
    return wide_columns(run_order_job(spark, sf_dir, lambda batch_spark: dimensions(batch_spark, sf_dir)))


@query("stream_fan_out", ROUTED_SQL)
def stream_fan_out(spark, sf_dir):
    """Change fan-out job over a feed of two tables: topic, key and value of
    every row, read back from the topics."""
    out, ckpt = work_path(spark, "topics"), work_path(spark, "ckpt_fan_out")

    def start(landing, files):
        records = jobs.source(spark, state_tasks(spark), landing=landing, max_files=files)
        return jobs.fan_out_job(records, file_topics(out), ckpt, interval=None)

    replay_windows(spark, two_table_records(spark, sf_dir), params.ORDER_WINDOW_MS, start)
    return read_parts(spark, out, "topic").select("topic", "key", "value")


@query("stream_fan_out_once", ROUTED_SQL)
def stream_fan_out_once(spark, sf_dir):
    """Fan-out of a feed of which every tenth record is delivered twice, half of
    those a window later: each change reaches its topic once."""
    records = two_table_records(spark, sf_dir)
    again = records.where(F.pmod("offset", F.lit(params.REDELIVER_EVERY)) == 0)
    later = F.pmod("offset", F.lit(2 * params.REDELIVER_EVERY)) == 0
    feed = records.unionByName(delayed(again, later, params.ORDER_WINDOW_MS))
    out, ckpt = work_path(spark, "topics"), work_path(spark, "ckpt_fan_out")

    def start(landing, files):
        own = jobs.source(spark, state_tasks(spark), landing=landing, max_files=files)
        return jobs.fan_out_job(own, file_topics(out), ckpt, interval=None, once_within=params.REDELIVER_WITHIN)

    replay_windows(spark, feed, params.ORDER_WINDOW_MS, start)
    return read_parts(spark, out, "topic").select("topic", "key", "value")


@query("stream_log_split", """
SELECT CASE WHEN e.event_type IN ('view', 'signup') THEN '{start}' ELSE '{event}' END AS topic,
  CAST(e.user_id AS VARCHAR) AS key,
  '{{"common":{{"mid":"' || e.user_id || '","uid":"' || e.user_id || '","ar":'
  || coalesce('"' || CAST(c.c_nationkey AS VARCHAR) || '"', 'null')
  || ',"ch":"' || e.event_type || '","vc":"v' || json_extract_string(e.props, '$.k') || '"}},'
  || CASE e.event_type WHEN 'view' THEN '"start":{{"entry":"icon"}},'
                       WHEN 'signup' THEN '"start":{{"entry":"notice"}},'
                       WHEN 'click' THEN '"start":"",'
                       WHEN 'error' THEN '"start":null,' ELSE '' END
  || '"ts":' || (epoch_us(e.ts) // 1000) || '}}' AS value
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
WHERE e.event_id % {a} <> 0 AND e.event_id % {b} <> 0 AND e.event_id % {c} <> 0 AND e.event_id % {d} <> 0
""".format(start=params.START_TOPIC, event=params.EVENT_TOPIC, a=params.CORRUPT_EVERY, b=params.NO_COMMON_EVERY,
           c=params.BAD_CLOCK_EVERY, d=params.HUGE_TS_EVERY))
def stream_log_split(spark, sf_dir):
    """Collector split as a stream to two topics; damaged lines go to the
    quarantine."""
    out, bad, ckpt = (work_path(spark, x) for x in ("topics", "quarantine", "ckpt_split"))

    def start(landing, files):
        records = jobs.source(spark, STATE, landing=landing, max_files=files)
        return jobs.log_split_job(records, file_topics(out), bad, ckpt, interval=None)

    replay_windows(spark, app_log_records(spark, sf_dir, corrupt=True), params.LOG_WINDOW_MS, start)
    return read_parts(spark, out, "topic").select("topic", "key", "value")


_STALL = (f"CASE WHEN \"partition\" = {params.STALL_PARTITION} AND dt BETWEEN DATE '{params.STALL_FROM}' "
          f"AND DATE '{params.STALL_TO}' THEN {params.STALL_DELAY_MS} ELSE 0 END")


@query("dau_reconcile", f"""
WITH {LOGS_CTE},
s AS (SELECT dt, mid, ts + {_STALL} AS arr_ms, (ts // 86400000) * 86400000 AS day_ms
      FROM logs WHERE kind = 'start'),
w AS (SELECT *, arr_ms // {params.LOG_WINDOW_MS} AS win FROM s),
wmax AS (SELECT win, max(day_ms) AS m FROM w GROUP BY win),
-- a batch drops rows by the watermark that held before the last batch ended
wm AS (SELECT win, max(m) OVER (ORDER BY win ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
                   - {params.STREAM_DELAY_MS} AS wm FROM wmax),
kept AS (SELECT DISTINCT dt, mid FROM w JOIN wm USING (win) WHERE wm.wm IS NULL OR w.day_ms > wm.wm),
allk AS (SELECT DISTINCT dt, mid FROM s)
SELECT a.dt, a.mid, CASE WHEN k.mid IS NOT NULL THEN 'kept' ELSE 'repaired' END AS status
FROM allk a LEFT JOIN kept k ON k.dt = a.dt AND k.mid = a.mid
""")
def dau_reconcile(spark, sf_dir):
    """Device job with a stalled partition (its rows for two days arrive ten days
    late): keys whose rows all came after the watermark had closed their day are
    missing from the stream's table and lie in its late table, from which they
    are repaired."""
    recs = stalled(app_log_records(spark, sf_dir), params.STALL_PARTITION, params.STALL_FROM,
                   params.STALL_TO, params.STALL_DELAY_MS)
    table, late, _ = run_dau_job(spark, recs)
    kept = dau_stream.stream_keys(spark, table).select("dt", "mid", F.lit("kept").alias("status"))
    repaired = repair_late(spark, table, late)
    return kept if repaired is None else kept.unionByName(repaired.withColumn("status", F.lit("repaired")))
