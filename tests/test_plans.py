"""Plan assertions: pruned scans, pushed filters, no cartesian products, top-k
instead of full sorts, partition pruning on the daily table."""

import re

import pytest

from daypulse.plans.catalog import QUERIES as Q
from tests.conftest import SF_SMALL

STREAMS = {name for name in Q if name.startswith("stream_")} | {"dau_reconcile"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tree(df):
    """(indent, line) of the initial physical plan, top down."""
    text = plan(df).split("== Final Plan ==")[-1].split("== Initial Plan ==")[-1]
    text = re.sub(r"\*\(\d+\) ", "", text)
    return [(len(line) - len(line.lstrip(" :+-")), line.strip(" :+-")) for line in text.splitlines() if line.strip()]


def below(nodes, k):
    """Lines of the subtree under node k."""
    out = []
    for depth, line in nodes[k + 1:]:
        if depth <= nodes[k][0]:
            break
        out.append(line)
    return out


def test_events_scan_reads_only_needed_columns(spark):
    p = plan(Q["dau_info"](spark, SF_SMALL))
    scans = [line for line in p.splitlines() if "events.parquet" in line]
    assert scans
    for line in scans:
        schema = line.split("ReadSchema: ")[1]
        assert "value:double" not in schema and "user_id:bigint" in schema, schema


def test_search_pushes_exact_filter_and_uses_top_k(spark):
    p = plan(Q["search_docs"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(lang,en\)", p)
    assert "TakeOrderedAndProject" in p
    assert "Exchange" not in p


def test_search_request_is_top_k(spark):
    assert "TakeOrderedAndProject" in plan(Q["search_request"](spark, SF_SMALL))


def test_sales_page_is_top_k_and_filters_reach_scans(spark):
    p = plan(Q["sale_detail_page"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    scans = [line for line in p.splitlines() if "sale_orders" in line and "PushedFilters" in line]
    assert scans
    for line in scans:
        assert "GreaterThanOrEqual(dt" in line and "LessThanOrEqual(dt" in line, line


def test_detail_rows_do_not_move_for_the_order_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = tree(Q["sale_detail_wide"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [k for k, (_, line) in enumerate(nodes) if line.startswith("SortMergeJoin [l_orderkey")]
    assert len(joins) == 1 and not any(x.startswith("Exchange") for x in below(nodes, joins[0]))


SUMMARY_QUERIES = ["sale_gender_share", "sale_age_share", "sale_stat_sets", "sale_detail_total"]


@pytest.mark.parametrize("name", SUMMARY_QUERIES)
def test_sales_figures_read_the_days_of_the_summary(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    for table in ("lineitem.parquet", "orders.parquet", "customer.parquet", "sale_details", "sale_orders"):
        assert table not in p
    scans = [line for line in p.splitlines() if "sale_summary" in line and "PartitionFilters" in line]
    assert scans and all("month#" in line.split("PartitionFilters: ")[1] and "GreaterThanOrEqual(dt" in line for line in scans)


def test_page_counts_hot_skus_on_the_summary(spark):
    nodes = tree(Q["sale_detail_page"](spark, SF_SMALL))
    for k, (_, line) in enumerate(nodes):
        if "Aggregate(" in line:
            assert not any("sale_details" in x or "lineitem" in x for x in below(nodes, k))


def test_new_devices_read_one_folder_a_day(spark):
    p = plan(Q["kpi_total"](spark, SF_SMALL))
    assert "events.parquet" not in p
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", p)
    assert len(found) == 2 and all("2024-01-15" in f or "19737" in f for f in found), found
    assert "events.parquet" not in plan(Q["new_devices"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["dau_total", "dau_hour", "dau_hour_compare", "hour_map_json"])
def test_dashboards_read_only_their_days(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", p)
    assert found and all("dt#" in f and ("2024-01-15" in f or "19737" in f) for f in found), found
    assert "events.parquet" not in p


def test_sales_total_reads_no_customer(spark):
    assert "customer.parquet" not in plan(Q["sale_detail_total"](spark, SF_SMALL))


def test_dashboard_figures_use_hash_aggregates(spark):
    for name in ("dau_total", "dau_hour", "dau_hour_compare", "dau_cumulative", "kpi_dod_rate",
                 "order_first_flag"):
        p = plan(Q[name](spark, SF_SMALL))
        assert "SortAggregate" not in p, name
        assert "HashAggregate" in p, name


@pytest.mark.parametrize("name", ["dau_info", "order_first_flag", "province_sales", "new_devices", "sale_gender_share"])
def test_first_row_aggregates_combine_before_the_shuffle(spark, name):
    """Under every final aggregate's exchange stands its partial one."""
    nodes = tree(Q[name](spark, SF_SMALL))
    finals = 0
    for k, (_, line) in enumerate(nodes):
        if "Aggregate(" not in line or "partial_" in line or "keys=[]" in line:
            continue
        under = [x for x in below(nodes, k) if not re.match(r"(\*\(\d+\) )?(Sort|AQEShuffleRead|InputAdapter)\b", x)]
        if under and under[0].startswith("Exchange"):
            assert "Aggregate(" in under[1] and ("partial_" in under[1] or "functions=[]" in under[1]), (name, under[:2])
            finals += 1
    assert finals


def test_no_query_plans_a_cross_product(spark):
    for name, build in sorted(Q.items()):
        if name in STREAMS:
            continue
        p = plan(build(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
