"""Kafka-shaped record streams derived by Spark from the supplied tables.

The reference consumes two feeds: app logs (nested JSON with epoch-ms ``ts``)
and database change envelopes (``{"table":..,"data":[row..]}`` with every
value a string). Kafka is not reachable here, so these functions turn the
supplied tables into rows of the Kafka source shape
``key, value, topic, partition, offset, timestamp`` -- the same rows that
``sources.kafka.read_records`` yields -- and every operator downstream sees
only that shape. All of it is column expressions: nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.money import cents, cents_to_money, hundredths, round_half_up_to_cents
from daypulse.functions.time import MS_PER_DAY, ntz_to_epoch_ms
from daypulse.sources.tables import read_table


def _json_str(c):
    """JSON string literal of a column, or null."""
    return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))


def app_log_records(spark: SparkSession, sf_dir: str, *, corrupt: bool = False,
                    partitions: int = params.LOG_PARTITIONS) -> DataFrame:
    """App logs as Kafka records, one per ``events`` row.

    Adapter rules: ``mid = uid = user_id``; ``ar`` = nation of the customer with
    the same key; ``ch = event_type``; ``vc = 'v' || props.k``; ``ts`` epoch ms.
    ``start`` carries an object for ``view`` and ``signup``, is ``""`` for
    ``click``, ``null`` for ``error`` and absent for ``purchase``, so every
    case of the content split occurs. With ``corrupt=True`` some lines are cut
    mid-JSON, some lose ``common`` and some carry a wrong clock (quarantine input).
    The Kafka offset is the event id: rising inside a partition, with gaps."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("ar_key"))
    # customer is keyed by user: a plain left join; AQE picks the strategy and,
    # both sides being shuffled for the join alone, splits a skewed partition
    j = ev.join(cust, "user_id", "left")
    ms = ntz_to_epoch_ms(F.col("ts"))
    if corrupt:  # the device's clock, not the arrival
        ms = (F.when(F.col("event_id") % params.BAD_CLOCK_EVERY == 0, ms + F.lit(400 * MS_PER_DAY))
              .when(F.col("event_id") % params.HUGE_TS_EVERY == 0, F.lit(2 ** 63 - 1)).otherwise(ms))
    mid = F.col("user_id").cast("string")
    start = (F.when(F.col("event_type") == "view", F.lit('"start":{"entry":"icon"},'))
             .when(F.col("event_type") == "signup", F.lit('"start":{"entry":"notice"},'))
             .when(F.col("event_type") == "click", F.lit('"start":"",'))
             .when(F.col("event_type") == "error", F.lit('"start":null,'))
             .otherwise(F.lit("")))
    value = F.concat(
        F.lit('{"common":{"mid":'), _json_str(mid),
        F.lit(',"uid":'), _json_str(mid),
        F.lit(',"ar":'), _json_str(F.col("ar_key").cast("string")),
        F.lit(',"ch":'), _json_str(F.col("event_type")),
        F.lit(',"vc":'), _json_str(F.concat(F.lit("v"), F.get_json_object("props", "$.k"))),
        F.lit("},"), start, F.lit('"ts":'), ms.cast("string"), F.lit("}"))
    if corrupt:
        value = (F.when(F.col("event_id") % params.CORRUPT_EVERY == 0,
                        value.substr(F.lit(1), F.floor(F.length(value) / 2).cast("int")))
                 .when(F.col("event_id") % params.NO_COMMON_EVERY == 0,
                       F.concat(F.lit('{"ts":'), ms.cast("string"), F.lit("}")))
                 .otherwise(value))
    return j.select(
        mid.alias("key"),
        value.alias("value"),
        F.lit(params.RAW_LOG_TOPIC).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


# --------------------------------------------------------------------------
# change feed
# --------------------------------------------------------------------------

def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_info`` rows with every value a string, as a change feed carries them.

    Rules: ``create_time = o_orderdate + (o_orderkey % 86400) s``; ``province_id``
    = nation of the customer; original amount = sum of line prices, benefit =
    sum of price * discount (lineitem pre-aggregated per order before the join)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    li = (read_table(spark, sf_dir, "lineitem")
          .select("l_orderkey", cents(F.col("l_extendedprice")).alias("pc"),
                  hundredths(F.col("l_discount")).alias("dh"))
          .groupBy("l_orderkey")
          .agg(F.sum("pc").alias("orig_c"), F.sum(F.col("pc") * F.col("dh")).alias("benefit_u")))
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(li, o.o_orderkey == li.l_orderkey, "left"))
    create_ts = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("int"))
    return j.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("c_nationkey").cast("string").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast("decimal(16,2)").cast("string").alias("final_total_amount"),
        cents_to_money(round_half_up_to_cents(F.col("benefit_u"))).cast("string").alias("benefit_reduce_amount"),
        cents_to_money(F.col("orig_c")).cast("string").alias("original_total_amount"),
        F.lit("0.00").alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        F.date_format(create_ts, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


ORDER_FIELDS = ("id", "user_id", "province_id", "order_status", "final_total_amount",
                "benefit_reduce_amount", "original_total_amount", "feight_fee",
                "expire_time", "create_time", "operate_time")


USER_FIELDS = ("id", "name", "user_level", "province_id", "phone_num")


def user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_info`` rows with every value a string; ``phone_num`` is null."""
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("user_level"), F.col("c_nationkey").cast("string").alias("province_id"),
        F.lit(None).cast("string").alias("phone_num"))


def user_records(spark: SparkSession, sf_dir: str, partitions: int = params.LOG_PARTITIONS) -> DataFrame:
    """Change envelopes for ``user_info``, one row each, sent before any order."""
    rows = user_rows(spark, sf_dir)
    key = F.col("id").cast("long")
    body = F.to_json(F.struct(F.lit("user_info").alias("table"), F.lit("INSERT").alias("type"),
                              F.lit(False).alias("isDdl"), key.alias("es"),
                              F.array(_row_map(USER_FIELDS)).alias("data")))
    return rows.select(F.col("id").alias("key"), body.alias("value"), F.lit(params.CDC_TOPIC).alias("topic"),
                       F.pmod(key, F.lit(partitions)).cast("int").alias("partition"),
                       (-key - 10).alias("offset"), F.timestamp_millis(F.lit(0)).alias("timestamp"))


def _row_map(fields=ORDER_FIELDS):
    return F.map_from_arrays(F.array(*[F.lit(f) for f in fields]),
                             F.array(*[F.col(f) for f in fields]))


def cdc_records(spark: SparkSession, sf_dir: str, *, rows_per_message: int = params.CDC_ROWS_PER_MESSAGE,
                partitions: int = params.LOG_PARTITIONS) -> DataFrame:
    """Change envelopes for ``order_info`` as Kafka records.

    Rows are packed ``rows_per_message`` to a message by ``o_orderkey div n``
    (groups hold at most n rows: keys are unique, so no group can grow with the
    data). One DDL message (``data`` null) and one empty message are added, as
    a real feed has them."""
    rows = order_rows(spark, sf_dir)
    n = rows_per_message
    row = F.struct(*ORDER_FIELDS)
    if n == 1:
        # one message per row, sent at its create time (time-ordered feed)
        packed = rows.select(F.col("id").cast("long").alias("msg"),
                             F.array(row).alias("data"),
                             F.col("create_time").alias("first_time"))
    else:
        packed = (rows.withColumn("msg", (F.col("id").cast("long") / F.lit(n)).cast("long"))
                  .groupBy("msg")
                  .agg(F.collect_list(row).alias("data"),
                       F.min(F.col("create_time")).alias("first_time")))
    # rows move as values only; their field names, nulls included, are in the text
    body = F.concat(F.lit('{"table":"order_info","type":"INSERT","isDdl":false,'),
                    F.coalesce(F.concat(F.lit('"es":'), F.col("msg").cast("string"), F.lit(",")), F.lit("")),
                    F.lit('"data":'), F.to_json("data", {"ignoreNullFields": "false"}), F.lit("}"))
    msgs = packed.select(
        F.col("msg").cast("string").alias("key"),
        body.alias("value"),
        F.lit(params.CDC_TOPIC).alias("topic"),
        F.pmod(F.col("msg"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("msg").alias("offset"),
        F.to_timestamp("first_time").alias("timestamp"))
    extra = spark.createDataFrame(
        [("ddl", '{"table":"order_info","type":"ALTER","isDdl":true,"es":-1,"data":null}',
          params.CDC_TOPIC, 0, -2),
         ("empty", '{"table":"order_info","type":"INSERT","isDdl":false,"es":-1,"data":[]}',
          params.CDC_TOPIC, 0, -1)],
        "key string, value string, topic string, partition int, offset bigint",
    ).withColumn("timestamp", F.timestamp_millis(F.lit(0)))
    return msgs.unionByName(extra)
