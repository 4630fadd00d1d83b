"""Sales detail: wide rows (J5), date + keyword filter (P14), page (L2), and the
daily summary that answers total (A10) and gender and age shares (A7, A8, grouping
sets); sales by province with all provinces kept (J7, A9)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.joins import split_join
from daypulse.functions.money import cents, cents_to_double
from daypulse.functions.text import keyword_filter
from daypulse.operators.orders import province_dim, user_dim
from daypulse.operators.orders import age_group as age_band

WIDE_COLUMNS = ("order_detail_id", "order_id", "user_id", "sku_id", "user_gender", "user_age",
                "user_level", "sku_price", "sku_name", "sku_tm_id", "dt")
# (l_orderkey, l_linenumber) repeats in the supplied lineitem; this key is total.
DETAIL_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
              "l_quantity", "l_extendedprice")
#: All that wide rows and the summary take from a detail row.
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey")
#: Parts that a month of the summary is counted and written in, by day and sku.
SUMMARY_SLICES = 8


def sale_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``o_orderkey, o_custkey, dt`` and the attributes of the user, one row per
    order. A user with a third of all orders is split over many tasks."""
    o = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"))
    u = user_dim(customer).select(F.col("user_id").alias("o_custkey"), "user_gender", "user_age", "user_level")
    return split_join(o, u, "o_custkey", ["o_orderkey"], "left")


def between(days: DataFrame, date_from: _dt.date | None, date_to: _dt.date | None) -> DataFrame:
    if date_from is not None:
        days = days.where(F.col("dt") >= F.lit(date_from))
    if date_to is not None:
        days = days.where(F.col("dt") <= F.lit(date_to))
    return days


def wide_detail(lineitem: DataFrame, sale_orders: DataFrame, part: DataFrame, sku_counts: DataFrame,
                date_from: _dt.date | None = None, date_to: _dt.date | None = None,
                keyword: str | None = None, keep_key: bool = False) -> DataFrame:
    """detail ⋈ order (with its user) ⋈ sku. Filters are applied to the dimension
    sides before the joins (date on orders, keyword on part), so they reach
    the scans and the runtime filters of the big lineitem join.

    Detail rows move on the order (a few lines each; not at all where both tables
    are bucketed by it) and on the sku. The skus to split come from
    ``sku_counts`` (``l_partkey, _n``), which the daily summary has."""
    o = between(sale_orders, date_from, date_to)
    p = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("sku_price"),
                    F.col("p_name").alias("sku_name"), F.col("p_brand").alias("sku_tm_id"))
    p = p.where(keyword_filter(F.col("sku_name"), keyword))
    li = lineitem.select(*(DETAIL_KEY if keep_key else LINE_KEY))
    j = split_join(li.join(o, li.l_orderkey == o.o_orderkey, "inner"), p, "l_partkey",
                   ["l_orderkey", "l_linenumber"], counts=sku_counts)
    cols = [
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_detail_id"),
        F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("sku_id"), "user_gender", "user_age", "user_level",
        "sku_price", "sku_name", "sku_tm_id", "dt"]
    if keep_key:
        cols += [F.col(k).alias(f"_k_{k}") for k in DETAIL_KEY]
    return j.select(*cols)


def page(detail_with_key: DataFrame, start: int, length: int) -> DataFrame:
    """Rows ``start .. start+length-1`` in total-key order. Spark plans this as
    a per-partition top-(start+length) and a merge, never a full sort; for
    deep pages use ``keyset_page``."""
    keys = [f"_k_{k}" for k in DETAIL_KEY]
    return (detail_with_key.orderBy(*keys).offset(start).limit(length)
            .select(*WIDE_COLUMNS))


def keyset_page(detail_with_key: DataFrame, after: tuple | None, length: int) -> DataFrame:
    """Next page after the last key seen: a pushed-down filter plus a top-k,
    cost independent of the page depth."""
    keys = [f"_k_{k}" for k in DETAIL_KEY]
    df = detail_with_key
    if after is not None:
        df = df.where(after_key(df, keys, after))
    return df.orderBy(*keys).limit(length)


def after_key(df: DataFrame, keys: list[str], values: tuple) -> F.Column:
    """Lexicographic ``(k1, k2, ...) > (v1, v2, ...)`` as an OR-chain, with a
    leading ``k1 >= v1`` that the scan can use for pushdown."""
    lits = [F.lit(v).cast(df.schema[k].dataType) for k, v in zip(keys, values)]
    cond = F.col(keys[-1]) > lits[-1]
    for k, v in zip(reversed(keys[:-1]), reversed(lits[:-1])):
        cond = (F.col(k) > v) | ((F.col(k) == v) & cond)
    return (F.col(keys[0]) >= lits[0]) & cond


SUMMARY_SCHEMA = "l_partkey long, user_gender string, band string, n long, dt date, month date"


def summary(lineitem: DataFrame, sale_orders: DataFrame) -> DataFrame:
    """``dt, l_partkey, user_gender, band, n``: detail rows per day, sku, gender and
    age band, with the ``month`` they are kept under. They move once: a slice of a
    month is counted where it is written. A hot sku's days are dealt to the
    slices of their months."""
    band = age_band(F.col("user_age")).alias("band")
    o = sale_orders.select(F.col("o_orderkey").alias("l_orderkey"), "dt", "user_gender", band)
    month = F.coalesce(F.year("dt") * 12 + F.month("dt"), F.lit(0))
    part = F.pmod(F.xxhash64("dt", "l_partkey"), F.lit(SUMMARY_SLICES)).cast("int")
    return (lineitem.select("l_orderkey", "l_partkey").join(o, "l_orderkey")
            .select("dt", "l_partkey", "user_gender", "band", (month * SUMMARY_SLICES + part).alias("_slice"))
            .repartition("_slice")
            .groupBy("_slice", "dt", "l_partkey", "user_gender", "band").agg(F.count(F.lit(1)).alias("n"))
            .drop("_slice").withColumn("month", F.trunc("dt", "month")))


def write_summary(rows: DataFrame, path: str) -> None:
    """Months of ``rows`` are written whole, the others stay: a day's new orders
    cost the rows of its month. Inside a file rows lie by day. ``rows`` do not move:
    ``summary`` has laid them out by month."""
    (rows.sortWithinPartitions("month", "dt", "l_partkey")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))


def read_summary(table: DataFrame, date_from: _dt.date, date_to: _dt.date) -> DataFrame:
    """The days asked for: other months are not listed, other days are skipped by
    the statistics of the files."""
    return between(table.where(F.col("month").between(F.lit(date_from.replace(day=1)), F.lit(date_to.replace(day=1)))),
                   date_from, date_to)


def sku_counts(summary_rows: DataFrame) -> DataFrame:
    """``l_partkey, _n``: detail rows per sku."""
    return summary_rows.groupBy("l_partkey").agg(F.sum("n").alias("_n"))


def with_keyword(summary_rows: DataFrame, part: DataFrame, keyword: str | None) -> DataFrame:
    """Summary rows of the skus whose name has the keyword. A sku has a row per
    day, gender and band, so the join meets no hot key."""
    p = part.where(keyword_filter(F.col("p_name"), keyword)).select(F.col("p_partkey").alias("l_partkey"))
    return summary_rows.join(p, "l_partkey")


def total(rows: DataFrame) -> DataFrame:
    """Number of filtered detail rows, from the summary."""
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


def _share(grouped: DataFrame) -> DataFrame:
    """Share of each group in the total; the window runs over the few group
    rows only (a handful of genders or bands), not over raw rows."""
    from pyspark.sql import Window
    w = Window.partitionBy()
    return grouped.select("name", "value",
                          F.round(F.col("value") / F.sum("value").over(w), 4).alias("share"))


def _counted(rows: DataFrame, name: F.Column) -> DataFrame:
    return rows.groupBy(name.alias("name")).agg(F.sum("n").alias("value"))


def gender_share(rows: DataFrame) -> DataFrame:
    return _share(_counted(rows, F.col("user_gender")))


def age_share(rows: DataFrame) -> DataFrame:
    return _share(_counted(rows, F.col("band")))


def stat_sets(rows: DataFrame) -> DataFrame:
    """Age bands and genders in one pass (grouping sets)."""
    g = rows.groupingSets([["band"], ["user_gender"]], "band", "user_gender").agg(
        F.sum("n").alias("value"), F.grouping("band").alias("_gb"))
    return g.select(F.when(F.col("_gb") == 0, F.lit("age")).otherwise(F.lit("gender")).alias("kind"),
                    F.when(F.col("_gb") == 0, F.col("band")).otherwise(F.col("user_gender")).alias("name"),
                    "value")


def province_sales(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Orders and money per province with every province present (zeros kept).

    Orders are first combined per customer (map-side), so the customer join
    sees one row per customer on both sides -- a customer with a third of all
    orders costs no single task -- then per province, and the dimension join
    sees one row per province."""
    per_cust = (orders.select("o_custkey", cents(F.col("o_totalprice")).alias("amt_c"))
                .groupBy("o_custkey")
                .agg(F.count(F.lit(1)).alias("value"), F.sum("amt_c").alias("amount_c")))
    c = customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("province_id"))
    per = (per_cust.join(c, "o_custkey", "inner").groupBy("province_id")
           .agg(F.sum("value").alias("value"), F.sum("amount_c").alias("amount_c")))
    j = province_dim(nation).join(per, "province_id", "left")
    value = F.coalesce("value", F.lit(0)).cast("bigint")
    return j.select(
        F.col("province_name").alias("name"),
        value.alias("value"),
        cents_to_double(F.coalesce(F.col("amount_c"), F.lit(0))).alias("amount"),
        F.least(F.floor(value / F.lit(params.PROVINCE_BIN_WIDTH)), F.lit(params.PROVINCE_BIN_MAX)).cast("bigint").alias("bin"))


def stat_json(stat_sets_df: DataFrame) -> DataFrame:
    """The share reply ``{"age":[{"name":..,"value":..}],"gender":[...]}`` from
    ``stat_sets`` (one row per band or gender: a handful)."""
    per_kind = (stat_sets_df.groupBy("kind")
                .agg(F.array_sort(F.collect_list(F.struct("name", "value"))).alias("items")))
    return per_kind.agg(F.to_json(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("kind", "items"))))).alias("json"))


def province_json(province_sales_df: DataFrame) -> DataFrame:
    """The map reply ``[{"name":..,"value":..}, ...]``: one entry per province,
    one row as the page asks for it; the input has one row per province."""
    items = F.array_sort(F.collect_list(F.struct("name", "value")))
    return province_sales_df.agg(F.to_json(items).alias("json"))
