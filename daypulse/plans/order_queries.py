"""Order group: first-order flag and the wide order row."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypulse import params
from daypulse.operators import orders as O
from daypulse.plans.cdc_queries import typed_orders
from daypulse.plans.derived import derived
from daypulse.plans.oracle_common import FIRST_CTE, FLAGS_CTE, USER_DIM_SQL
from daypulse.plans.registry import query
from daypulse.session import work_path
from daypulse.sources.lookup import read_lookup
from daypulse.sources.tables import read_table

FROM = params.ORDER_STATE_CUTOFF.isoformat()


def order_table(spark, sf_dir):
    """The typed orders between the change-feed job and the order job: a kept
    table, of which each reader scans only its columns and times."""
    path = derived(spark, sf_dir, "typed_orders", ("orders", "customer", "lineitem"),
                   lambda p: typed_orders(spark, sf_dir).write.parquet(p))
    return spark.read.parquet(path)


@query("order_first_flag", f"""
WITH {FLAGS_CTE}
SELECT id, user_id, if_first_order FROM flags
""")
def order_first_flag(spark, sf_dir):
    """Flag of every order from the cutoff on, against the state table of the
    users with an order before it."""
    o = order_table(spark, sf_dir)
    path = work_path(spark, "user_state")
    O.user_state_from_orders(o.where(F.col("create_time") < F.lit(FROM))).write.parquet(path)
    flagged = O.first_order_flags(o.where(F.col("create_time") >= F.lit(FROM)), read_lookup(spark, path=path))
    return flagged.select("id", "user_id", "if_first_order")


WIDE_ORDER_COLUMNS = ("id", "province_id", "order_status", "user_id", "final_total_amount",
                      "benefit_reduce_amount", "original_total_amount", "feight_fee",
                      "create_date", "create_hour", "if_first_order", "province_name",
                      "province_area_code", "province_iso_code", "user_age_group", "user_gender")

WIDE_ORDER_SQL = f"""
WITH {FIRST_CTE},
u AS ({USER_DIM_SQL})
SELECT f.id, f.province_id, f.order_status, f.user_id, f.final_total_amount, f.benefit_reduce_amount,
       f.original_total_amount, f.feight_fee,
       substr(f.create_time, 1, 10) AS create_date, substr(f.create_time, 12, 2) AS create_hour,
       f.if_first_order, n.n_name AS province_name, CAST(n.n_regionkey AS VARCHAR) AS province_area_code,
       'N' || CAST(n.n_nationkey AS VARCHAR) AS province_iso_code, u.user_age_group, u.user_gender
FROM firsts f LEFT JOIN nation n ON n.n_nationkey = f.province_id
              LEFT JOIN u ON u.user_id = f.user_id
"""


def wide_columns(wide):
    """The wide row, money as double."""
    money = ("final_total_amount", "benefit_reduce_amount", "original_total_amount", "feight_fee")
    return wide.select(*[F.col(c).cast("double").alias(c) if c in money else F.col(c)
                         for c in WIDE_ORDER_COLUMNS])


def dimensions(spark, sf_dir):
    return (O.province_dim(read_table(spark, sf_dir, "nation")), O.user_dim(read_table(spark, sf_dir, "customer")))


@query("order_wide", WIDE_ORDER_SQL)
def order_wide(spark, sf_dir):
    """Every order, flagged, with province and user dimensions."""
    orders = order_table(spark, sf_dir)
    return wide_columns(O.enrich(O.first_order_flags(orders, None), *dimensions(spark, sf_dir), orders))
