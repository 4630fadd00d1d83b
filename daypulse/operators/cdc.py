"""Change-feed operators: parse envelopes, explode rows (P9), route (P10),
row to JSON (P11), typed order rows from quoted values (P2), create-time
parts (P6), redelivered changes (T5) and offset ranges (S4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.time import time_string_parts
from daypulse.operators.logs import parsed_once
from daypulse.schemas import CDC_ENVELOPE, MONEY

_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def parse_envelopes(records: DataFrame) -> DataFrame:
    env = parsed_once(F.from_json(F.col("value"), CDC_ENVELOPE, _OPTS), "e")
    return records.select("partition", "offset", env).select(
        "partition", "offset", F.col("e.es").alias("es"),
        F.col("e.table").alias("table"), F.col("e.type").alias("type"),
        F.col("e.isDdl").alias("isDdl"), F.col("e.data").alias("data"),
        F.col("e._corrupt_record").alias("_corrupt_record"))


def explode_rows(envelopes: DataFrame) -> DataFrame:
    """One row per changed record. ``explode`` skips null ``data`` (DDL) and
    empty arrays, which crashed or stalled the reference."""
    return envelopes.select("partition", "offset", "es", "table", "type",
                            F.posexplode("data").alias("pos", "row"))


def route_name(table: Column) -> Column:
    """The one shared naming rule: prefix + upper-case table name."""
    return F.concat(F.lit(params.ROUTE_PREFIX), F.upper(table))


def row_json(row: Column) -> Column:
    """Row back to JSON text without null-valued keys (as the reference's
    JSON library wrote it; plain ``to_json`` of a map keeps nulls)."""
    return F.to_json(F.map_filter(row, lambda k, v: v.isNotNull()))


def once(rows: DataFrame, within: str) -> DataFrame:
    """Streaming rows without those that the source delivers again ``within``
    that time (T5): the same table, id, execution time and content. The time is
    the batch's own, so no row can be late and none is lost however far a
    partition lags; the engine forgets a change when that time has passed."""
    keyed = (rows.withColumn("_id", F.col("row")["id"]).withColumn("_body", F.md5(row_json(F.col("row"))))
             .withColumn("_seen", F.current_timestamp()))
    return (keyed.withWatermark("_seen", within)
            .dropDuplicatesWithinWatermark(["table", "_id", "es", "_body"]).select(*rows.columns))


def routed(rows: DataFrame) -> DataFrame:
    """Rows ready for a per-row topic sink, keyed by table and primary key so
    that duplicates of a message land on the same key (at-least-once safe)."""
    return rows.select(route_name(F.col("table")).alias("topic"),
                       F.concat_ws(":", F.col("table"), F.col("row")["id"]).alias("key"),
                       row_json(F.col("row")).alias("value"))


def typed_orders(rows: DataFrame) -> DataFrame:
    """``order_info`` rows with quoted values coerced by ``try_cast``: a bad
    value gives null in that column, not a failed batch."""
    r = F.col("row")

    def big(k):
        return F.expr(f"try_cast(row['{k}'] AS BIGINT)").alias(k)

    def money(k):
        return F.expr(f"try_cast(row['{k}'] AS {MONEY.simpleString()})").alias(k)

    o = rows.where(F.col("table") == "order_info")
    return o.select(
        big("id"), big("province_id"), r["order_status"].alias("order_status"), big("user_id"),
        money("final_total_amount"), money("benefit_reduce_amount"),
        money("original_total_amount"), money("feight_fee"),
        r["expire_time"].alias("expire_time"), r["create_time"].alias("create_time"),
        r["operate_time"].alias("operate_time"))


def with_time_parts(orders: DataFrame) -> DataFrame:
    d, h = time_string_parts(F.col("create_time"))
    return orders.withColumn("create_date", d).withColumn("create_hour", h)


def offset_ranges(records: DataFrame, batch: Column) -> DataFrame:
    """Per-batch offset range of each topic partition: ``from`` is the first
    offset read, ``until`` one past the last, ``n`` the records read."""
    return (records.withColumn("batch_id", batch)
            .groupBy("batch_id", "topic", "partition")
            .agg(F.min("offset").alias("from_offset"),
                 (F.max("offset") + 1).alias("until_offset"),
                 F.count(F.lit(1)).alias("n")))
