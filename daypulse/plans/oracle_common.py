"""SQL fragments shared by the DuckDB oracles: the same adapter rules as
``sources.replay``, written independently in SQL over the raw tables."""

from daypulse import params

LOG_DAY = params.LOG_DAY.isoformat()

# Good log rows (no corruption injected), one per events row.
LOGS_CTE = """
logs AS (
  SELECT e.event_id AS "offset",
         CAST(e.user_id % {parts} AS INTEGER) AS "partition",
         CAST(e.user_id AS VARCHAR) AS mid,
         CAST(e.user_id AS VARCHAR) AS uid,
         CAST(c.c_nationkey AS VARCHAR) AS ar,
         e.event_type AS ch,
         'v' || json_extract_string(e.props, '$.k') AS vc,
         (epoch_us(e.ts) // 1000) AS ts,
         CAST(e.ts AS DATE) AS dt,
         strftime(e.ts, '%H') AS hr,
         CASE WHEN e.event_type IN ('view', 'signup') THEN 'start' ELSE 'event' END AS kind
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
)""".format(parts=params.LOG_PARTITIONS)

DAU_CTE = LOGS_CTE + """,
dau AS (
  SELECT mid, uid, ar, ch, vc, dt, hr, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, "partition", "offset") AS rn
    FROM logs WHERE kind = 'start') WHERE rn = 1
)"""

# Orders as the change feed carries them, typed back.
ORDERS_CTE = """
li AS (
  SELECT l_orderkey,
         sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS orig,
         round(sum(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2))), 2) AS benefit
  FROM lineitem GROUP BY l_orderkey
),
ord AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS user_id, CAST(c.c_nationkey AS BIGINT) AS province_id,
         o.o_orderstatus AS order_status,
         CAST(CAST(o.o_totalprice AS DECIMAL(16,2)) AS DOUBLE) AS final_total_amount,
         CAST(li.benefit AS DOUBLE) AS benefit_reduce_amount,
         CAST(li.orig AS DOUBLE) AS original_total_amount,
         CAST(0 AS DOUBLE) AS feight_fee,
         strftime(o.o_orderdate + to_seconds(o.o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS create_time
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
                LEFT JOIN li ON li.l_orderkey = o.o_orderkey
)"""

BATCH_FROM = params.ORDER_STATE_CUTOFF.isoformat()

FLAGS_CTE = ORDERS_CTE + f""",
st AS (SELECT DISTINCT user_id FROM ord WHERE create_time < '{BATCH_FROM}'),
b AS (SELECT * FROM ord WHERE create_time >= '{BATCH_FROM}'),
flags AS (
  SELECT b.*, CASE WHEN row_number() OVER (PARTITION BY b.user_id ORDER BY b.create_time, b.id) = 1
                    AND b.user_id NOT IN (SELECT user_id FROM st) THEN '1' ELSE '0' END AS if_first_order
  FROM b
)"""

# Every order; the first one ever of its user is flagged.
FIRST_CTE = ORDERS_CTE + """,
firsts AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1 THEN '1' ELSE '0' END
         AS if_first_order
  FROM ord
)"""

USER_DIM_SQL = f"""
SELECT c_custkey AS user_id,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender,
       CAST(15 + c_custkey % 50 AS BIGINT) AS user_age,
       CASE WHEN 15 + c_custkey % 50 < 20 THEN '{params.AGE_BAND_UNDER_20}'
            WHEN 15 + c_custkey % 50 <= 30 THEN '{params.AGE_BAND_20_30}'
            ELSE '{params.AGE_BAND_OVER_30}' END AS user_age_group,
       c_mktsegment AS user_level
FROM customer"""
