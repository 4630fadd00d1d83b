"""Change-feed group: explode, route, typed rows, time parts, keyed upsert,
offset audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.time import MS_PER_DAY
from daypulse.operators import cdc, offsets
from daypulse.plans.oracle_common import ORDERS_CTE
from daypulse.plans.registry import query
from daypulse.session import work_path
from daypulse.sinks.files import write_routed
from daypulse.sinks.upsert import current, upsert
from daypulse.sources.replay import app_log_records, cdc_records, user_records
from daypulse.sources.tables import read_table


def change_rows(spark, sf_dir):
    return cdc.explode_rows(cdc.parse_envelopes(cdc_records(spark, sf_dir)))


def typed_orders(spark, sf_dir):
    return cdc.with_time_parts(cdc.typed_orders(change_rows(spark, sf_dir)))


@query("cdc_rows", """
SELECT 'order_info' AS "table", o_orderkey AS id, o_custkey AS user_id,
       strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS create_time
FROM orders
""")
def cdc_rows(spark, sf_dir):
    """One row per changed record out of packed envelopes (DDL and empty
    messages give no rows)."""
    r = change_rows(spark, sf_dir)
    return r.select("table", F.expr("try_cast(row['id'] AS BIGINT)").alias("id"),
                    F.expr("try_cast(row['user_id'] AS BIGINT)").alias("user_id"),
                    F.col("row")["create_time"].alias("create_time"))


def two_table_records(spark, sf_dir, rows_per_message=params.CDC_ROWS_PER_MESSAGE):
    """A change feed of two tables, as one topic carries it."""
    return cdc_records(spark, sf_dir, rows_per_message=rows_per_message).unionByName(user_records(spark, sf_dir))


@query("cdc_routed_counts", f"""
SELECT '{params.ROUTE_PREFIX}ORDER_INFO' AS topic, count(*) AS n FROM orders
UNION ALL
SELECT '{params.ROUTE_PREFIX}USER_INFO', count(*) FROM customer
""")
def cdc_routed_counts(spark, sf_dir):
    """Rows written to their routed topics (file twin), counted after read-back."""
    rows = cdc.explode_rows(cdc.parse_envelopes(two_table_records(spark, sf_dir)))
    path = write_routed(spark, cdc.routed(rows))
    return spark.read.parquet(path).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


ROUTED_SQL = f"""
WITH {ORDERS_CTE}
SELECT '{params.ROUTE_PREFIX}ORDER_INFO' AS topic, 'order_info:' || id AS key,
  '{{"id":"' || id || '","user_id":"' || user_id || '"'
  || CASE WHEN province_id IS NULL THEN '' ELSE ',"province_id":"' || province_id || '"' END
  || ',"order_status":"' || order_status
  || '","final_total_amount":"' || CAST(CAST(final_total_amount AS DECIMAL(16,2)) AS VARCHAR)
  || CASE WHEN benefit_reduce_amount IS NULL THEN '"' ELSE
       '","benefit_reduce_amount":"' || CAST(CAST(benefit_reduce_amount AS DECIMAL(16,2)) AS VARCHAR)
       || '","original_total_amount":"' || CAST(CAST(original_total_amount AS DECIMAL(16,2)) AS VARCHAR) || '"' END
  || ',"feight_fee":"0.00","create_time":"' || create_time || '"}}' AS value
FROM ord
UNION ALL
SELECT '{params.ROUTE_PREFIX}USER_INFO', 'user_info:' || c_custkey,
  '{{"id":"' || c_custkey || '","name":"' || c_name || '","user_level":"' || c_mktsegment
  || '","province_id":"' || c_nationkey || '"}}'
FROM customer
"""


@query("cdc_routed", ROUTED_SQL)
def cdc_routed(spark, sf_dir):
    """Topic, key and JSON of every changed row, routed by its table."""
    return cdc.routed(cdc.explode_rows(cdc.parse_envelopes(two_table_records(spark, sf_dir))))


@query("order_typed", f"""
WITH {ORDERS_CTE}
SELECT id, province_id, order_status, user_id, final_total_amount FROM ord
""")
def order_typed(spark, sf_dir):
    """Quoted values coerced to typed columns (money DECIMAL(16,2) inside)."""
    o = typed_orders(spark, sf_dir)
    return o.select("id", "province_id", "order_status", "user_id",
                    F.col("final_total_amount").cast("double").alias("final_total_amount"))


@query("order_time_parts", """
SELECT o_orderkey AS id,
       strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d') AS create_date,
       strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H') AS create_hour
FROM orders
""")
def order_time_parts(spark, sf_dir):
    return typed_orders(spark, sf_dir).select("id", "create_date", "create_hour")


def versioned_change_records(spark, sf_dir):
    """Each order sent as single-row messages with versions 1..k,
    k = id % 3 + 1; earlier versions carry an interim status. Offsets run in
    reverse version order, so arrival order contradicts version order."""
    rows = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("order_status"))
    k = (F.col("id").cast("long") % 3 + 1)
    v = rows.withColumn("k", k).withColumn("version", F.explode(F.sequence(F.lit(1), F.col("k").cast("int"))))
    status = F.when(F.col("version") == F.col("k"), F.col("order_status")).otherwise(
        F.concat(F.lit("interim-"), F.col("version").cast("string")))
    m = F.create_map(F.lit("id"), F.col("id"), F.lit("order_status"), status,
                     F.lit("version"), F.col("version").cast("string"))
    value = F.to_json(F.struct(F.lit("order_info").alias("table"), F.lit("UPDATE").alias("type"),
                               F.array(m).alias("data")))
    return v.select(F.col("id").alias("key"), value.alias("value"),
                    F.lit(params.CDC_TOPIC).alias("topic"), F.lit(0).alias("partition"),
                    (F.col("id").cast("long") * 3 + (F.col("k") - F.col("version"))).alias("offset"),
                    F.col("version"))


@query("upsert_last_wins", """
SELECT o_orderkey AS id, o_orderstatus AS order_status, CAST(o_orderkey % 3 + 1 AS BIGINT) AS version
FROM orders
""")
def upsert_last_wins(spark, sf_dir):
    """Two micro-batches applied to a keyed table: first the inserts, then all
    updates in reverse version order. The highest version wins per key."""
    recs = versioned_change_records(spark, sf_dir)
    path = work_path(spark, "order_state_table")

    def typed(batch):
        rows = cdc.explode_rows(cdc.parse_envelopes(batch.drop("version")))
        return rows.select(F.expr("try_cast(row['id'] AS BIGINT)").alias("id"),
                           F.col("row")["order_status"].alias("order_status"),
                           F.expr("try_cast(row['version'] AS BIGINT)").alias("version"))

    for batch_id, batch in enumerate((recs.where(F.col("version") == 1), recs.where(F.col("version") > 1))):
        upsert(spark, typed(batch), path, batch_id, "id", ["version"], ["order_status"],
               params.UPSERT_BUCKETS, params.MERGE_EVERY)
    return current(spark, path, "id", ["version"], ["order_status"])


@query("batch_offset_audit", f"""
SELECT (epoch_us(ts) // 1000) // {MS_PER_DAY} AS batch_id, '{params.RAW_LOG_TOPIC}' AS topic,
       CAST(user_id % {params.LOG_PARTITIONS} AS INTEGER) AS "partition",
       min(event_id) AS from_offset, max(event_id) + 1 AS until_offset, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def batch_offset_audit(spark, sf_dir):
    """Offset range per (micro-batch, topic, partition); micro-batches are
    fixed one-day arrival windows here, ``batch_id`` in a running stream."""
    recs = app_log_records(spark, sf_dir)
    # the arrival, from the broker; no part of the log line
    batch = F.floor(F.unix_millis("timestamp") / F.lit(MS_PER_DAY)).cast("bigint")
    return cdc.offset_ranges(recs, batch).select(
        "batch_id", "topic", "partition", "from_offset", "until_offset", "n")


def audited_batches(spark, sf_dir):
    """Offset audit of a log topic of which some micro-batches lost their first
    records and some read the end of the one before again."""
    n = params.AUDIT_BATCH
    r = read_table(spark, sf_dir, "events").select(
        F.lit(params.RAW_LOG_TOPIC).alias("topic"),
        F.pmod("event_id", F.lit(params.LOG_PARTITIONS)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / F.lit(params.LOG_PARTITIONS)).alias("offset"))
    r = r.withColumn("batch", F.floor(F.col("offset") / F.lit(n))).withColumn("nth", F.col("offset") % n)
    got = r.where(~((F.col("batch") % params.HOLE_EVERY == 3) & (F.col("nth") < params.HOLE_SIZE)))
    again = r.where((F.col("batch") % params.OVERLAP_EVERY == 4) & (F.col("nth") >= n - params.OVERLAP_SIZE))
    feed = got.unionByName(again.withColumn("batch", F.col("batch") + 1))
    return cdc.offset_ranges(feed, F.col("batch"))


AUDIT_CTE = f"""
e AS (SELECT CAST(event_id % {params.LOG_PARTITIONS} AS INTEGER) AS part, event_id // {params.LOG_PARTITIONS} AS o FROM events),
r AS (SELECT part, o, o // {params.AUDIT_BATCH} AS batch, o % {params.AUDIT_BATCH} AS nth FROM e),
feed AS (
  SELECT part, o, batch FROM r WHERE NOT (batch % {params.HOLE_EVERY} = 3 AND nth < {params.HOLE_SIZE})
  UNION ALL
  SELECT part, o, batch + 1 FROM r WHERE batch % {params.OVERLAP_EVERY} = 4 AND nth >= {params.AUDIT_BATCH - params.OVERLAP_SIZE}),
a AS (SELECT part, batch, min(o) AS f, max(o) + 1 AS u FROM feed GROUP BY part, batch)"""


@query("offset_continuity", f"""
WITH {AUDIT_CTE},
m AS (SELECT a.*, (SELECT max(b.u) FROM a b WHERE b.part = a.part AND b.batch < a.batch) AS reached FROM a)
SELECT '{params.RAW_LOG_TOPIC}' AS topic, part AS "partition", batch AS batch_id, 'hole' AS kind,
       reached AS from_offset, f AS until_offset FROM m WHERE f > reached
UNION ALL
SELECT '{params.RAW_LOG_TOPIC}', part, batch, 'overlap', f, least(reached, u) FROM m WHERE f < reached
""")
def offset_continuity(spark, sf_dir):
    """Where a micro-batch does not begin where those before it ended: offsets
    never read and offsets read twice, per partition."""
    return offsets.continuity(audited_batches(spark, sf_dir))


@query("offset_runs", f"""
WITH {AUDIT_CTE},
n AS (SELECT part, o, o - row_number() OVER (PARTITION BY part ORDER BY o) AS island
      FROM (SELECT DISTINCT a.part, x.o FROM a, LATERAL (SELECT unnest(range(a.f, a.u)) AS o) x)),
i AS (SELECT part, min(o) AS f, max(o) + 1 AS u FROM n GROUP BY part, island)
SELECT '{params.RAW_LOG_TOPIC}' AS topic, i.part AS "partition", min(a.batch) AS first_batch, max(a.batch) AS last_batch,
       i.f AS from_offset, i.u AS until_offset
FROM i JOIN a ON a.part = i.part AND a.f >= i.f AND a.u <= i.u GROUP BY i.part, i.f, i.u
""")
def offset_runs(spark, sf_dir):
    """The unbroken stretches of offsets that were read, per partition."""
    return offsets.runs(audited_batches(spark, sf_dir))
