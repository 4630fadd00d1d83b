"""Sales group: wide detail rows, filtered page, total, shares, province map."""

from __future__ import annotations

from daypulse import params
from daypulse.functions.text import token_pattern
from daypulse.operators import sales as S
from daypulse.plans.derived import derived
from daypulse.plans.oracle_common import USER_DIM_SQL
from daypulse.plans.registry import query
from daypulse.sources.tables import read_table

KW = token_pattern(params.SALES_KEYWORD)
DFROM, DTO = params.SALES_DATE_FROM.isoformat(), params.SALES_DATE_TO.isoformat()


def bucketed(spark, sf_dir, name, inputs, rows, key):
    """``rows`` as a table bucketed and sorted by ``key``, so that two such tables
    join on it without moving. The files lie in the work folder; the catalog
    entry is this session's."""
    def build(path):
        buckets = max(params.DETAIL_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        rows().repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format(
            "parquet").saveAsTable(table_name(path))

    def table_name(path):
        return f"daypulse_{name}_{path.rsplit('/', 1)[1]}"

    return spark.table(table_name(derived(spark, sf_dir, name, inputs, build)))


def tables(spark, sf_dir):
    return {n: read_table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "part")}


def orders_by_key(spark, sf_dir):
    """Orders with their users, laid out by order."""
    t = tables(spark, sf_dir)
    return bucketed(spark, sf_dir, "sale_orders", ("orders", "customer"),
                    lambda: S.sale_orders(t["orders"], t["customer"]), "o_orderkey")


def lines_by_key(spark, sf_dir):
    """Keys of the order lines, laid out by order."""
    t = tables(spark, sf_dir)
    return bucketed(spark, sf_dir, "sale_lines", ("lineitem",), lambda: t["lineitem"].select(*S.LINE_KEY), "l_orderkey")


def details_by_key(spark, sf_dir):
    """Order lines with the columns that pages are ordered by, laid out by order."""
    t = tables(spark, sf_dir)
    return bucketed(spark, sf_dir, "sale_details", ("lineitem",), lambda: t["lineitem"].select(*S.DETAIL_KEY), "l_orderkey")


def summary(spark, sf_dir, lines=lines_by_key):
    """The daily sales summary, kept by month. Counted on the table that ``lines``
    gives; both have the same rows."""
    def build(path):
        S.write_summary(S.summary(lines(spark, sf_dir), orders_by_key(spark, sf_dir)), path)

    path = derived(spark, sf_dir, "sale_summary", ("lineitem", "orders", "customer"), build)
    return spark.read.schema(S.SUMMARY_SCHEMA).parquet(path)


def asked(spark, sf_dir):
    """Summary rows of the page's dates and keyword."""
    rows = S.read_summary(summary(spark, sf_dir), params.SALES_DATE_FROM, params.SALES_DATE_TO)
    return S.with_keyword(rows, read_table(spark, sf_dir, "part"), params.SALES_KEYWORD)


def detail(spark, sf_dir, filtered=True, keep_key=False):
    lines = details_by_key if keep_key else lines_by_key
    frames = (lines(spark, sf_dir), orders_by_key(spark, sf_dir), read_table(spark, sf_dir, "part"))
    kept = summary(spark, sf_dir, lines)
    if not filtered:
        return S.wide_detail(*frames, S.sku_counts(kept), keep_key=keep_key)
    days = (params.SALES_DATE_FROM, params.SALES_DATE_TO)
    return S.wide_detail(*frames, S.sku_counts(S.read_summary(kept, *days)), *days, params.SALES_KEYWORD, keep_key)


WIDE_SQL = f"""
u AS ({USER_DIM_SQL}),
wide AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_detail_id,
         l.l_orderkey AS order_id, o.o_custkey AS user_id, l.l_partkey AS sku_id,
         u.user_gender, u.user_age, u.user_level,
         p.p_retailprice AS sku_price, p.p_name AS sku_name, p.p_brand AS sku_tm_id,
         CAST(o.o_orderdate AS DATE) AS dt,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity, l.l_extendedprice
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
                  JOIN part p ON p.p_partkey = l.l_partkey
                  LEFT JOIN u ON u.user_id = o.o_custkey
)"""

FILTERED_SQL = WIDE_SQL + f""",
f AS (SELECT * FROM wide WHERE dt BETWEEN DATE '{DFROM}' AND DATE '{DTO}'
                           AND regexp_matches(sku_name, '{KW}'))"""

COLS = ", ".join(S.WIDE_COLUMNS)


@query("sale_detail_wide", f"WITH {WIDE_SQL}\nSELECT {COLS} FROM wide")
def sale_detail_wide(spark, sf_dir):
    """Every order line with order, user and sku attributes."""
    return detail(spark, sf_dir, filtered=False)


@query("sale_detail_page", f"""WITH {FILTERED_SQL}
SELECT {COLS} FROM f
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice
LIMIT {params.SALES_PAGE_LENGTH} OFFSET {params.SALES_PAGE_START}""")
def sale_detail_page(spark, sf_dir):
    return S.page(detail(spark, sf_dir, keep_key=True), params.SALES_PAGE_START, params.SALES_PAGE_LENGTH)


@query("sale_detail_total", f"WITH {FILTERED_SQL}\nSELECT count(*) AS total FROM f")
def sale_detail_total(spark, sf_dir):
    return S.total(asked(spark, sf_dir))


@query("sale_gender_share", f"""WITH {FILTERED_SQL}
SELECT user_gender AS name, count(*) AS value,
       round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM f GROUP BY user_gender""")
def sale_gender_share(spark, sf_dir):
    return S.gender_share(asked(spark, sf_dir))


AGE_CASE = f"""CASE WHEN user_age < 20 THEN '{params.AGE_BAND_UNDER_20}'
                    WHEN user_age <= 30 THEN '{params.AGE_BAND_20_30}'
                    WHEN user_age > 30 THEN '{params.AGE_BAND_OVER_30}' END"""


@query("sale_age_share", f"""WITH {FILTERED_SQL}
SELECT {AGE_CASE} AS name, count(*) AS value,
       round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM f GROUP BY 1""")
def sale_age_share(spark, sf_dir):
    return S.age_share(asked(spark, sf_dir))


@query("sale_stat_sets", f"""WITH {FILTERED_SQL},
g AS (SELECT {AGE_CASE} AS band, user_gender FROM f)
SELECT CASE WHEN GROUPING(band) = 0 THEN 'age' ELSE 'gender' END AS kind,
       CASE WHEN GROUPING(band) = 0 THEN band ELSE user_gender END AS name,
       count(*) AS value
FROM g GROUP BY GROUPING SETS ((band), (user_gender))""")
def sale_stat_sets(spark, sf_dir):
    return S.stat_sets(asked(spark, sf_dir))


@query("province_sales", f"""
WITH per AS (
  SELECT CAST(c.c_nationkey AS BIGINT) AS province_id, count(*) AS value,
         sum(CAST(o.o_totalprice AS DECIMAL(16,2))) AS amount
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1)
SELECT n.n_name AS name, coalesce(per.value, 0) AS value,
       CAST(coalesce(per.amount, 0) AS DOUBLE) AS amount,
       CAST(least(floor(coalesce(per.value, 0) / {params.PROVINCE_BIN_WIDTH}), {params.PROVINCE_BIN_MAX}) AS BIGINT) AS bin
FROM nation n LEFT JOIN per ON per.province_id = n.n_nationkey
""")
def province_sales(spark, sf_dir):
    """Every province, with order count, amount and display bin."""
    return S.province_sales(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                            read_table(spark, sf_dir, "nation"))
