"""Order enrichment: first-order flag against the user state (J1, J2, W1),
province and user dimensions (J3, J4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.joins import split_join
from daypulse.functions.time import time_string_seconds
from daypulse.operators.dedup import first_id_per_key
from daypulse.sources.lookup import for_keys

def user_state_from_orders(orders: DataFrame) -> DataFrame:
    """``user_id, if_consumed='1'`` for every user with an order (the keyed
    state table of the reference, rebuilt from history)."""
    return (orders.select("user_id").distinct()
            .select("user_id", F.lit("1").alias("if_consumed")))


def first_order_flags(batch: DataFrame, state: DataFrame | None) -> DataFrame:
    """``if_first_order='1'`` for the earliest order of a user in the batch
    (by create time, then id) when the user has not consumed before, else '0'.
    Without a ``state`` nobody has.

    Skew-safe shape: the per-user minimum combines map-side, the state test is
    an anti join of one row per user against one row per user, and the flag
    goes back onto the batch by the unique order id. No join on ``user_id``
    touches the raw batch rows, so a user with a third of all orders never
    lands whole in one task."""
    firsts = first_orders(batch)
    if state is not None:
        consumed = for_keys(state.where(F.col("if_consumed") == "1"), firsts, ["user_id"]).select("user_id")
        firsts = firsts.join(consumed, "user_id", "left_anti")
    new_firsts = firsts.select(F.col("first_id").alias("id"), F.lit("1").alias("_flag"))
    return (batch.join(new_firsts, "id", "left")
            .withColumn("if_first_order", F.coalesce("_flag", F.lit("0")))
            .drop("_flag"))


def known_orders(orders: DataFrame) -> DataFrame:
    """Orders that can be a user's first: those with a user and an id."""
    return orders.where(F.col("user_id").isNotNull() & F.col("id").isNotNull())


def first_orders(orders: DataFrame, count: str | None = None) -> DataFrame:
    """``user_id, first_id``: the earliest order of each user by (create
    time, id), via a hash aggregate on a packed key. An order whose time cannot
    be read comes after those with one, so it is first only if it is alone;
    orders without a user or an id are nobody's first. ``count`` names a column
    for the number of orders."""
    known = known_orders(orders).withColumn("_ct", time_string_seconds(F.col("create_time")))
    return first_id_per_key(known, ["user_id"], "_ct", "id", count)


def province_dim(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("province_id"),
        F.col("n_name").alias("province_name"),
        F.col("n_regionkey").cast("string").alias("province_area_code"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("province_iso_code"))


def age_group(age) -> F.Column:
    return (F.when(age < 20, F.lit(params.AGE_BAND_UNDER_20))
            .when(age <= 30, F.lit(params.AGE_BAND_20_30))
            .when(age > 30, F.lit(params.AGE_BAND_OVER_30)))


def user_dim(customer: DataFrame) -> DataFrame:
    """Synthetic user attributes: gender by key parity, age = 15 + key % 50."""
    age = (F.lit(15) + F.col("c_custkey") % 50).cast("bigint")
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("user_gender"),
        age.alias("user_age"),
        age_group(age).alias("user_age_group"),
        F.col("c_mktsegment").alias("user_level"))


def enrich(orders: DataFrame, provinces: DataFrame, users: DataFrame, keys_from: DataFrame | None = None) -> DataFrame:
    """Order ⟕ province ⟕ user. Province is a key that a third of all orders can
    share, and so is a user: both joins split their frequent keys, which are
    counted on ``keys_from`` (the orders before they were flagged)."""
    u = users.select("user_id", "user_age_group", "user_gender")
    base = orders if keys_from is None else keys_from
    wide = split_join(orders, provinces, "province_id", ["id"], "left", base)
    return split_join(wide, u, "user_id", ["id"], "left", base)
