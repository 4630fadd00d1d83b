"""A key holding a third of all rows: the first-row, first-order and last-writer
aggregates combine below their exchange, joins split the key over many tasks."""

import pytest
from pyspark.sql import functions as F

from daypulse.functions.joins import split_join
from daypulse.operators.dedup import daily_active_keys, first_id_per_key, last_per_key
from daypulse.operators.orders import enrich
from daypulse.operators.sales import sale_orders, sku_counts, summary, wide_detail
from tests.test_plans import below, tree

N = 30_000


def skewed(spark):
    # every third row belongs to device/user 0
    ids = spark.range(N).withColumn("key", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))
    return ids.select(
        F.col("id"),
        F.col("key").cast("string").alias("mid"),
        F.col("key").alias("user_id"),
        F.lit("2024-01-02").cast("date").alias("dt"),
        (F.lit(1704153600000) + (N - F.col("id"))).alias("ts"),
        (N - F.col("id")).alias("ct"),
        F.col("id").alias("version"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("status"))


def partial_below_exchange(df):
    """The exchange of the aggregate has the partial aggregate right under it."""
    nodes = tree(df)
    at = [k for k, (_, line) in enumerate(nodes) if line.startswith("Exchange hashpartitioning")]
    return bool(at) and all("partial_" in next(x for x in below(nodes, k) if "Project" not in x) for k in at)


def test_hot_device_first_row(spark):
    d = daily_active_keys(skewed(spark))
    hot = d.where(F.col("mid") == "0").collect()
    assert len(hot) == 1 and hot[0].ts == 1704153600000 + (N - (N - 3))   # largest id divisible by 3
    assert d.count() == 1 + (N - N // 3)
    assert partial_below_exchange(daily_active_keys(skewed(spark)))


def test_hot_user_first_order(spark):
    f = first_id_per_key(skewed(spark), ["user_id"], "ct", "id")
    assert f.where(F.col("user_id") == 0).first().first_id == N - 3
    assert partial_below_exchange(first_id_per_key(skewed(spark), ["user_id"], "ct", "id"))


def test_hot_key_last_writer(spark):
    u = last_per_key(skewed(spark), ["user_id"], ["version"], ["status"])
    assert u.where(F.col("user_id") == 0).first().status == f"s{N - 3}"
    assert partial_below_exchange(last_per_key(skewed(spark), ["user_id"], ["version"], ["status"]))


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_split_join_equals_plain_join_and_spreads_the_hot_key(spark, no_broadcast):
    rows = skewed(spark)
    users = spark.range(0, N, 2).select(F.col("id").alias("user_id"), (F.col("id") * 7).alias("x"))
    for how in ("inner", "left"):
        got = split_join(rows, users, "user_id", ["id"], how).select("id", "x")
        want = rows.join(users, "user_id", how).select("id", "x")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    parts = split_join(rows, users, "user_id", ["id"], "left").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < N / 8      # a plain join has a third in one task


def test_enrich_moves_a_hot_user_to_many_tasks(spark, no_broadcast):
    orders = skewed(spark).withColumn("province_id", F.when(F.col("id") % 2 == 0, F.lit(3)).otherwise(F.col("id") % 25))
    provinces = spark.range(25).select(F.col("id").alias("province_id"), F.lit("p").alias("province_name"))
    users = spark.range(N).select(F.col("id").alias("user_id"), F.lit("a").alias("user_age_group"),
                                  F.lit("F").alias("user_gender"))
    wide = enrich(orders, provinces, users)
    assert wide.count() == N and wide.where("province_name = 'p' AND user_gender = 'F'").count() == N
    parts = wide.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < N / 8
    joins = [line for _, line in tree(enrich(orders, provinces, users)) if line.startswith("SortMergeJoin")]
    assert len(joins) == 2 and all("_part" in line for line in joins)


def test_wide_detail_moves_detail_rows_by_order_and_by_split_sku(spark, no_broadcast):
    lineitem = skewed(spark).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("user_id").alias("l_partkey"),
        F.lit(1).alias("l_suppkey"), F.lit("d").alias("l_shipdate"), F.lit(1.0).alias("l_quantity"),
        F.lit(1.0).alias("l_extendedprice"))
    orders = skewed(spark).select(F.col("id").alias("o_orderkey"), F.col("user_id").alias("o_custkey"),
                                  F.lit("2024-01-01").cast("date").alias("o_orderdate"))
    customer = spark.range(N).select(F.col("id").alias("c_custkey"), F.lit("s").alias("c_mktsegment"))
    part = spark.range(N).select(F.col("id").alias("p_partkey"), F.lit(1.0).alias("p_retailprice"),
                                 F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"))
    sold = sale_orders(orders, customer)
    counts = sku_counts(summary(lineitem, sold)).checkpoint()     # a kept table
    wide = wide_detail(lineitem, sold, part, counts)
    assert wide.count() == N
    parts = wide.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < N / 8
    keys = [line.split("]")[0] for _, line in tree(wide_detail(lineitem, sold, part, counts))
            if line.startswith("SortMergeJoin")]
    assert len(keys) == 3
    assert sum("l_partkey" in k and "_part" in k for k in keys) == 1
    assert sum("o_custkey" in k and "_part" in k for k in keys) == 1
    assert sum("l_orderkey" in k for k in keys) == 1
