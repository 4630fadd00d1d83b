"""Log group: collector split, quarantine, archive, daily active devices and
the dashboard figures built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypulse import params
from daypulse.operators import dashboard as dash
from daypulse.operators import device_sets, dynamic, first_seen
from daypulse.operators import logs as L
from daypulse.operators.dedup import daily_active, daily_active_keys
from daypulse.plans.derived import derived
from daypulse.plans.oracle_common import DAU_CTE, LOG_DAY, LOGS_CTE
from daypulse.plans.registry import query
from daypulse.schemas import APP_LOG
from daypulse.session import work_path
from daypulse.sinks.files import archive_raw
from daypulse.sources.replay import app_log_records

D = params.LOG_DAY


def parsed_logs(spark, sf_dir, corrupt=False):
    return L.parse_logs(app_log_records(spark, sf_dir, corrupt=corrupt))


def dau_table(spark, sf_dir):
    """Full active-device rows (what the stream writes to the daily table)."""
    return daily_active(L.start_logs(parsed_logs(spark, sf_dir)))


def dau_keys(spark, sf_dir):
    """``dt, mid, hr`` of the active devices, enough for every dashboard figure."""
    return daily_active_keys(L.start_logs(parsed_logs(spark, sf_dir)))


LOG_INPUTS = ("events", "customer")


def daily_table(spark, sf_dir):
    """The daily active-device table, partitioned by day, as the daily job
    leaves it for the dashboards, read with partition pruning."""
    def build(path):
        dau_table(spark, sf_dir).repartition("dt").write.partitionBy("dt").parquet(path)

    return spark.read.parquet(derived(spark, sf_dir, "daily_table", LOG_INPUTS, build))


def first_seen_table(spark, sf_dir):
    """First day of every device, one folder per day, as the daily job leaves it."""
    def build(path):
        first_seen.start_table(L.good_logs(parsed_logs(spark, sf_dir)).select("mid", "dt"), path)

    return first_seen.read_table(spark, derived(spark, sf_dir, "first_seen", LOG_INPUTS, build))


def device_set_table(spark, sf_dir):
    """Bitmaps of the active devices per day and hour, by day, as the daily job
    leaves them."""
    def build(path):
        start = L.start_logs(parsed_logs(spark, sf_dir)).select("dt", "hr", "mid").distinct()
        device_sets.write_sets(device_sets.hour_sets(start, device_sets.add_devices(start)), path)

    return device_sets.read_sets(spark, derived(spark, sf_dir, "device_sets", LOG_INPUTS, build))


@query("log_source_replay", """
WITH {logs}
SELECT CAST(e.user_id AS VARCHAR) AS key,
  '{{"common":{{"mid":"' || e.user_id || '","uid":"' || e.user_id || '","ar":'
  || coalesce('"' || CAST(c.c_nationkey AS VARCHAR) || '"', 'null')
  || ',"ch":"' || e.event_type || '","vc":"v' || json_extract_string(e.props, '$.k') || '"}},'
  || CASE e.event_type WHEN 'view' THEN '"start":{{"entry":"icon"}},'
                       WHEN 'signup' THEN '"start":{{"entry":"notice"}},'
                       WHEN 'click' THEN '"start":"",'
                       WHEN 'error' THEN '"start":null,' ELSE '' END
  || '"ts":' || (epoch_us(e.ts) // 1000) || '}}' AS value,
  '{topic}' AS topic,
  CAST(e.user_id % {parts} AS INTEGER) AS "partition",
  e.event_id AS "offset"
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
""".format(logs=LOGS_CTE, topic=params.RAW_LOG_TOPIC, parts=params.LOG_PARTITIONS))
def log_source_replay(spark, sf_dir):
    """App logs as Kafka-shaped records (the stand-in for the topic source)."""
    return app_log_records(spark, sf_dir).select("key", "value", "topic", "partition", "offset")


@query("log_split", f"""
WITH {LOGS_CTE}
SELECT CASE WHEN kind = 'start' THEN '{params.START_TOPIC}' ELSE '{params.EVENT_TOPIC}' END AS topic,
       count(*) AS n
FROM logs GROUP BY 1
""")
def log_split(spark, sf_dir):
    """Collector split: start logs (non-empty ``start``) vs event logs."""
    return L.split_counts(parsed_logs(spark, sf_dir))


@query("log_quarantine", f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN event_id % {params.CORRUPT_EVERY} = 0 THEN 'malformed_json'
              WHEN event_id % {params.NO_COMMON_EVERY} = 0 THEN 'missing_mid'
              WHEN event_id % {params.BAD_CLOCK_EVERY} = 0 OR event_id % {params.HUGE_TS_EVERY} = 0
              THEN 'bad_ts' END AS reason
  FROM events) WHERE reason IS NOT NULL GROUP BY reason
""")
def log_quarantine(spark, sf_dir):
    """Bad lines by reason, out of a feed with injected damage."""
    return L.quarantine_counts(parsed_logs(spark, sf_dir, corrupt=True))


@query("raw_archive_daily", """
SELECT CAST(ts AS DATE) AS arrival_dt, count(*) AS n FROM events GROUP BY 1
""")
def raw_archive_daily(spark, sf_dir):
    """Raw lines archived per arrival day (written, then read back)."""
    recs = app_log_records(spark, sf_dir)
    path = archive_raw(spark, recs)
    back = spark.read.parquet(path)
    return back.groupBy("arrival_dt").agg(F.count(F.lit(1)).alias("n"))


@query("raw_archive_rows", """
SELECT CAST(e.ts AS DATE) AS arrival_dt, CAST(e.user_id AS VARCHAR) AS key,
  CAST(e.user_id % {parts} AS INTEGER) AS "partition", e.event_id AS "offset", epoch_us(e.ts) AS arrival_us,
  '{{"common":{{"mid":"' || e.user_id || '","uid":"' || e.user_id || '","ar":'
  || coalesce('"' || CAST(c.c_nationkey AS VARCHAR) || '"', 'null')
  || ',"ch":"' || e.event_type || '","vc":"v' || json_extract_string(e.props, '$.k') || '"}},'
  || CASE e.event_type WHEN 'view' THEN '"start":{{"entry":"icon"}},'
                       WHEN 'signup' THEN '"start":{{"entry":"notice"}},'
                       WHEN 'click' THEN '"start":"",'
                       WHEN 'error' THEN '"start":null,' ELSE '' END
  || '"ts":' || (epoch_us(e.ts) // 1000) || '}}' AS value
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
""".format(parts=params.LOG_PARTITIONS))
def raw_archive_rows(spark, sf_dir):
    """Every raw record read back from the archive, key and arrival included."""
    back = spark.read.parquet(archive_raw(spark, app_log_records(spark, sf_dir)))
    return back.select("arrival_dt", "key", "partition", "offset",
                       F.unix_micros("timestamp").alias("arrival_us"), "value")


@query("dau_info", f"""
WITH {DAU_CTE}
SELECT mid, uid, ar, ch, vc, dt, hr, ts FROM dau
""")
def dau_info(spark, sf_dir):
    """One row per device and day: its first start log."""
    return dau_table(spark, sf_dir)


@query("dau_total", f"""
WITH {DAU_CTE}
SELECT DATE '{LOG_DAY}' AS dt, count(*) AS value FROM dau WHERE dt = DATE '{LOG_DAY}'
""")
def dau_total(spark, sf_dir):
    return dash.dau_total(daily_table(spark, sf_dir), D)


@query("dau_hour", f"""
WITH {DAU_CTE}
SELECT hr, count(*) AS n FROM dau WHERE dt = DATE '{LOG_DAY}' GROUP BY hr
""")
def dau_hour(spark, sf_dir):
    return dash.dau_hour(daily_table(spark, sf_dir), D)


DAU_HOUR_COMPARE_SQL = f"""
WITH {DAU_CTE},
grid AS (SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hr FROM range(24) t(h)),
c AS (SELECT hr,
             count(*) FILTER (WHERE dt = DATE '{LOG_DAY}' - INTERVAL 1 DAY) AS yesterday,
             count(*) FILTER (WHERE dt = DATE '{LOG_DAY}') AS today
      FROM dau GROUP BY hr)
SELECT g.hr, coalesce(c.yesterday, 0) AS yesterday, coalesce(c.today, 0) AS today
FROM grid g LEFT JOIN c USING (hr)
"""


@query("dau_hour_compare", DAU_HOUR_COMPARE_SQL)
def dau_hour_compare(spark, sf_dir):
    """Yesterday and today per hour, 24 rows, zero filled (flagship)."""
    return dash.dau_hour_compare(spark, daily_table(spark, sf_dir), D)


@query("hour_map_json", f"""
WITH {DAU_CTE},
c AS (SELECT hr,
             count(*) FILTER (WHERE dt = DATE '{LOG_DAY}' - INTERVAL 1 DAY) AS y,
             count(*) FILTER (WHERE dt = DATE '{LOG_DAY}') AS t
      FROM dau GROUP BY hr)
SELECT '{{"yesterday":{{' || coalesce(string_agg(CASE WHEN y > 0 THEN '"' || hr || '":' || y END, ',' ORDER BY hr), '')
       || '}},"today":{{' || coalesce(string_agg(CASE WHEN t > 0 THEN '"' || hr || '":' || t END, ',' ORDER BY hr), '')
       || '}}}}' AS json
FROM c
""")
def hour_map_json(spark, sf_dir):
    """The two-day hourly reply as JSON text."""
    return dash.hour_map_json(daily_table(spark, sf_dir), D)


@query("start_count", f"""
WITH {LOGS_CTE}
SELECT dt, count(*) AS n FROM logs WHERE kind = 'start' GROUP BY dt
""")
def start_count(spark, sf_dir):
    return dash.start_count(L.start_logs(parsed_logs(spark, sf_dir)))


@query("new_devices", f"""
WITH {LOGS_CTE}
SELECT first_dt AS dt, count(*) AS n FROM (SELECT mid, min(dt) AS first_dt FROM logs GROUP BY mid)
GROUP BY first_dt
""")
def new_devices(spark, sf_dir):
    """Devices first seen per day, from the first-seen table."""
    return first_seen.new_devices(first_seen_table(spark, sf_dir))


@query("first_seen_devices", f"""
WITH {LOGS_CTE}
SELECT mid, min(dt) AS first_dt FROM logs GROUP BY mid
""")
def first_seen_devices(spark, sf_dir):
    """First day of every device out of a table that history starts and later days
    are added to one by one, every second pair of days in the wrong order."""
    path = work_path(spark, "first_seen_days")
    logs = spark.read.parquet(derived(
        spark, sf_dir, "log_devices", LOG_INPUTS,
        lambda p: L.good_logs(parsed_logs(spark, sf_dir)).select("mid", "dt").distinct()
        .repartition("dt").write.partitionBy("dt").parquet(p)))
    first_seen.start_table(logs.where(F.col("dt") < F.lit(params.FIRST_SEEN_CUTOFF)), path)
    days = sorted(r.dt for r in logs.where(F.col("dt") >= F.lit(params.FIRST_SEEN_CUTOFF)).select("dt").distinct().collect())
    for k in range(1, len(days), 4):
        days[k - 1:k + 1] = days[k - 1:k + 1][::-1]
    for day in days:
        first_seen.add_day(spark, path, logs.where(F.col("dt") == F.lit(day)), day)
    return first_seen.read_table(spark, path)


@query("device_set_hours", f"""
WITH {LOGS_CTE},
s AS (SELECT DISTINCT dt, hr, mid FROM logs WHERE kind = 'start'),
h AS (SELECT dt, hr, count(*) AS n FROM s GROUP BY dt, hr)
SELECT h.dt, h.hr, h.n, (SELECT count(DISTINCT mid) FROM s WHERE s.dt = h.dt AND s.hr <= h.hr) AS cum
FROM h
""")
def device_set_hours(spark, sf_dir):
    """Devices active in each hour and in the day so far, from bitmaps alone."""
    return device_sets.through_the_day(device_set_table(spark, sf_dir))


@query("device_set_days", f"""
WITH {LOGS_CTE},
s AS (SELECT DISTINCT dt, mid FROM logs WHERE kind = 'start'),
d AS (SELECT dt, count(*) AS value FROM s GROUP BY dt)
SELECT d.dt, d.value,
  (SELECT count(DISTINCT mid) FROM s WHERE s.dt BETWEEN d.dt - INTERVAL {params.WEEK_DAYS - 1} DAY AND d.dt) AS week,
  (SELECT count(*) FROM s JOIN s y ON y.mid = s.mid AND y.dt = s.dt - INTERVAL 1 DAY WHERE s.dt = d.dt) AS back
FROM d
""")
def device_set_days(spark, sf_dir):
    """Devices of each day, of the week up to it, and those back from the day
    before, from bitmaps alone."""
    return device_sets.day_figures(device_set_table(spark, sf_dir), params.WEEK_DAYS)


@query("log_fields", """
WITH e AS (SELECT event_type AS t, c.c_nationkey AS ar, json_extract_string(e.props, '$.k') AS k
           FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id),
f AS (
  SELECT 'common' AS path, 'OBJECT' AS kind FROM e
  UNION ALL SELECT unnest(['common.mid', 'common.uid', 'common.ch']), 'STRING' FROM e
  UNION ALL SELECT 'common.ar', CASE WHEN ar IS NULL THEN 'VOID' ELSE 'STRING' END FROM e
  UNION ALL SELECT 'common.vc', CASE WHEN k IS NULL THEN 'VOID' ELSE 'STRING' END FROM e
  UNION ALL SELECT 'ts', 'BIGINT' FROM e
  UNION ALL SELECT 'start', CASE WHEN t IN ('view', 'signup') THEN 'OBJECT' WHEN t = 'click' THEN 'STRING' ELSE 'VOID' END
            FROM e WHERE t IN ('view', 'signup', 'click', 'error')
  UNION ALL SELECT 'start.entry', 'STRING' FROM e WHERE t IN ('view', 'signup'))
SELECT path, kind, path <> 'start.entry' AS declared, count(*) AS n FROM f GROUP BY path, kind
""")
def log_fields(spark, sf_dir):
    """Every field that occurs in the logs with the kinds it occurs in, whether a
    schema declares it or not."""
    return dynamic.census(dynamic.with_document(app_log_records(spark, sf_dir)), APP_LOG)


@query("log_entries", """
SELECT CAST(ts AS DATE) AS dt, CASE event_type WHEN 'view' THEN 'icon' ELSE 'notice' END AS entry, count(*) AS n
FROM events
WHERE event_type IN ('view', 'signup') AND event_id % {a} <> 0 AND event_id % {b} <> 0
  AND event_id % {c} <> 0 AND event_id % {d} <> 0
GROUP BY 1, 2
""".format(a=params.CORRUPT_EVERY, b=params.NO_COMMON_EVERY, c=params.BAD_CLOCK_EVERY, d=params.HUGE_TS_EVERY))
def log_entries(spark, sf_dir):
    """Starts per day by ``start.entry``, a field that no schema declares, out of a
    feed with damaged lines."""
    good = L.start_logs(parsed_logs(spark, sf_dir, corrupt=True))
    return (dynamic.with_document(good.select("dt", "value")).groupBy("dt", dynamic.field("$.start.entry").alias("entry"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("hourly_active", f"""
WITH {LOGS_CTE}
SELECT dt, hr, count(DISTINCT mid) AS n FROM logs WHERE kind = 'start' GROUP BY dt, hr
""")
def hourly_active(spark, sf_dir):
    return dash.hourly_active(L.start_logs(parsed_logs(spark, sf_dir)))


@query("dau_cumulative", f"""
WITH {DAU_CTE},
h AS (SELECT dt, hr, count(*) AS n FROM dau GROUP BY dt, hr)
SELECT dt, hr, n, CAST(sum(n) OVER (PARTITION BY dt ORDER BY hr
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum
FROM h
""")
def dau_cumulative(spark, sf_dir):
    return dash.dau_cumulative(dau_keys(spark, sf_dir))


@query("kpi_total", f"""
WITH {DAU_CTE}
SELECT '{params.KPI_DAU[0]}' AS id, '{params.KPI_DAU[1]}' AS name, count(*) AS value
FROM dau WHERE dt = DATE '{LOG_DAY}'
UNION ALL
SELECT '{params.KPI_NEW_MID[0]}', '{params.KPI_NEW_MID[1]}', count(*)
FROM (SELECT mid, min(dt) AS f FROM logs GROUP BY mid) WHERE f = DATE '{LOG_DAY}'
""")
def kpi_total(spark, sf_dir):
    """Active and new devices of the day: that day of the daily table and of the
    first-seen table."""
    return dash.kpi_total(daily_table(spark, sf_dir), first_seen_table(spark, sf_dir), D)


@query("kpi_dod_rate", f"""
WITH {DAU_CTE},
d AS (SELECT dt, count(*) AS n FROM dau GROUP BY dt)
SELECT t.dt, t.n AS today, y.n AS yesterday,
       CASE WHEN y.n > 0 THEN round((t.n - y.n) / y.n, 4) END AS rate
FROM d t LEFT JOIN d y ON y.dt = t.dt - INTERVAL 1 DAY
""")
def kpi_dod_rate(spark, sf_dir):
    return dash.kpi_dod_rate(daily_table(spark, sf_dir))
