"""Keyed user state across micro-batches (T6): the first order of a user
ever seen gets ``if_first_order='1'``. Inside a batch the earliest order by
(create_time, id) is the first.

The state is in the engine (``streaming.keyed``): per user, the number of orders
ever counted. A batch reads the state of its own users, however many are known,
and a user with a third of the batch costs no single task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.operators import cdc
from daypulse.operators.orders import enrich, first_orders, known_orders
from daypulse.sinks.parts import read_parts, write_batch
from daypulse.streaming.conf import batch_settings
from daypulse.streaming.keyed import EVER, counted, rows_of, touched_keys, with_state

#: Provinces and users as of now; asked for every batch, so that a change in the
#: dimension tables reaches the next batch.
Dimensions = Callable[[SparkSession], tuple[DataFrame, DataFrame]]


def typed_order_stream(records: DataFrame) -> DataFrame:
    rows = cdc.explode_rows(cdc.parse_envelopes(records))
    return cdc.with_time_parts(cdc.typed_orders(rows))


def orders_with_users(orders: DataFrame) -> DataFrame:
    """Typed orders beside the state of their users. Only a user with an order
    that can be first is counted, so one whose orders had no usable id can still
    get a flag later."""
    return with_state(orders, counted(known_orders(orders), ["user_id"]))


def flag_batch(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Flags of one batch: the first order of each user whose orders, as counted
    by the state, are all in this batch."""
    firsts = first_orders(orders, count="n_now").join(users, "user_id")
    mine = firsts.where(F.col("n_now") == F.col(EVER)).select(F.col("first_id").alias("id"), F.lit("1").alias("_f"))
    return orders.join(mine, "id", "left").withColumn("if_first_order", F.coalesce("_f", F.lit("0"))).drop("_f")


def order_month():
    """Folder of an order in the order table; orders without a date share one."""
    return F.coalesce(F.substring("create_date", 1, 7), F.lit("none"))


def order_sink(table: str, dimensions: Dimensions | None = None):
    """foreachBatch body over ``orders_with_users``: flag, join province and user
    where they are given, save. The batch is parsed once."""
    def sink(df: DataFrame, batch_id: int) -> None:
        batch = df.persist()
        try:
            with batch_settings(df.sparkSession):
                orders = rows_of(batch)
                flagged = flag_batch(orders, touched_keys(batch))
                if dimensions is not None:
                    flagged = enrich(flagged, *dimensions(df.sparkSession), orders)
                # a file per month, unless a month has much
                by_month = flagged.withColumn("month", order_month()).hint("rebalance", "month")
                write_batch(by_month, table, "month", batch_id)
        finally:
            batch.unpersist()
    return sink


def order_table(spark: SparkSession, table: str) -> DataFrame:
    return read_parts(spark, table, "month")
