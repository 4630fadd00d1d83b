"""Tables that jobs keep: first days of devices, bitmaps, the sales summary, the
cache over them; offsets and dynamic fields."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daypulse.functions.ranks import numbered
from daypulse.operators import device_sets as D
from daypulse.operators import dynamic, first_seen, offsets
from daypulse.operators import sales as S
from daypulse.schemas import APP_LOG
from daypulse.session import child_folders

DAYS = [dt.date(2024, 1, d) for d in range(1, 8)]


def logs(spark, rows):
    return spark.createDataFrame(rows, "mid string, dt date")


def seen(spark, path):
    return {r.mid: r.first_dt for r in first_seen.read_table(spark, path).collect()}


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [1, 3, 0, 2], [0, 2, 2, 1, 3, 1]])
def test_days_may_come_in_any_order_and_again(spark, scratch, order):
    days = {0: ["a", "b", None], 1: ["b", "c", "c"], 2: ["a", "d"], 3: ["d", "e", "c"]}
    path = scratch + "/t"
    for k in order:
        first_seen.add_day(spark, path, logs(spark, [(m, DAYS[k]) for m in days[k]]), DAYS[k])
    assert seen(spark, path) == {"a": DAYS[0], "b": DAYS[0], "c": DAYS[1], "d": DAYS[2], "e": DAYS[3]}
    assert first_seen.read_table(spark, path).count() == 5


def test_a_folder_that_loses_its_last_device_goes(spark, scratch):
    path = scratch + "/t"
    first_seen.add_day(spark, path, logs(spark, [("a", DAYS[3])]), DAYS[3])
    first_seen.add_day(spark, path, logs(spark, [("a", DAYS[1]), ("b", DAYS[1])]), DAYS[1])
    assert seen(spark, path) == {"a": DAYS[1], "b": DAYS[1]}
    assert child_folders(spark, path) == ["first_dt=2024-01-02"]


def test_history_then_a_day(spark, scratch):
    path = scratch + "/t"
    first_seen.start_table(logs(spark, [("a", DAYS[0]), ("a", DAYS[1]), ("b", DAYS[1])]), path)
    first_seen.add_day(spark, path, logs(spark, [("b", DAYS[2]), ("c", DAYS[2])]), DAYS[2])
    assert {(r.dt, r.n) for r in first_seen.new_devices(first_seen.read_table(spark, path)).collect()} == {
        (DAYS[0], 1), (DAYS[1], 1), (DAYS[2], 1)}


def test_numbers_are_gapless_and_of_the_keys_alone(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("mid"))
    got = {r.mid: r.id for r in numbered(keys, "mid", "id").collect()}
    assert sorted(got.values()) == list(range(1, 5001))
    assert {r.mid: r.id for r in numbered(keys.repartition(7), "mid", "id").collect()} == got


def test_device_sets_over_many_buckets(spark):
    # 70,000 devices, three buckets; device k is active on day k % 3 at hours k % 5 and 9
    start = (spark.range(70_000).select(
        F.col("id").cast("string").alias("mid"), F.date_add(F.lit("2024-01-01"), F.pmod("id", F.lit(3)).cast("int")).alias("dt"),
        F.explode(F.array(F.lpad(F.pmod("id", F.lit(5)).cast("string"), 2, "0"), F.lit("09"))).alias("hr")))
    ids = D.add_devices(start)
    sets = D.hour_sets(start, ids)
    assert sets.select("bucket").distinct().count() == 3
    assert {(r.dt.day, r.n) for r in D.devices(sets, "dt").collect()} == {(1, 23_334), (2, 23_333), (3, 23_333)}
    hours = {(r.dt.day, r.hr): (r.n, r.cum) for r in D.through_the_day(sets).collect()}
    assert hours[1, "04"][1] == hours[1, "09"][1] == hours[1, "09"][0] == 23_334
    assert hours[1, "00"] == (4667, 4667)
    assert {(r.dt.day, r.n) for r in D.over_days(sets, 2).collect()} == {(1, 23_334), (2, 46_667), (3, 46_666)}
    assert {(r.value, r.back) for r in D.day_figures(sets).collect()} == {(23_334, 0), (23_333, 0)}


def test_devices_that_join_later_get_the_next_numbers(spark):
    first = D.add_devices(logs(spark, [("a", DAYS[0]), ("b", DAYS[0]), (None, DAYS[0])]))
    more = D.add_devices(logs(spark, [("b", DAYS[1]), ("c", DAYS[1])]), first)
    assert sorted(r.id for r in first.collect()) == [1, 2] and [tuple(r) for r in more.collect()] == [("c", 3)]


def test_sets_of_a_day_replace_themselves(spark, scratch):
    path = scratch + "/sets"
    start = spark.createDataFrame([("a", DAYS[0], "01"), ("b", DAYS[1], "02")], "mid string, dt date, hr string")
    ids = D.add_devices(start)
    for _ in range(2):
        D.write_sets(D.hour_sets(start, ids), path)
    D.write_sets(D.hour_sets(start.where("mid = 'b'").withColumn("hr", F.lit("05")), ids), path)
    assert {(r.dt, r.hr) for r in D.read_sets(spark, path).collect()} == {(DAYS[0], "01"), (DAYS[1], "05")}


def test_fields_that_no_schema_declares(spark):
    lines = ['{"common":{"mid":"a","extra":1},"ts":5,"new":{"x":[1]}}', '{"common":{"mid":2},"ts":"late"}', "broken{", None,
             "[1]", '"text"', "{}"]
    docs = dynamic.with_document(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {(r.path, r.kind, r.declared): r.n for r in dynamic.census(docs, APP_LOG).collect()}
    assert got == {("common", "OBJECT", True): 2, ("common.mid", "STRING", True): 1, ("common.mid", "BIGINT", True): 1,
                   ("common.extra", "BIGINT", False): 1, ("ts", "BIGINT", True): 1, ("ts", "STRING", True): 1,
                   ("new", "OBJECT", False): 1, ("new.x", "ARRAY", False): 1}
    assert [r[0] for r in docs.select(dynamic.field("$.new.x[0]", "int")).collect()].count(1) == 1
    assert "extra: BIGINT" in dynamic.shape(docs.limit(1)).first()["shape"]


AUDIT = "batch_id long, topic string, partition int, from_offset long, until_offset long"


def test_offset_faults(spark):
    rows = [(0, "t", 0, 0, 10), (1, "t", 0, 10, 20), (2, "t", 0, 25, 30), (3, "t", 0, 28, 40), (4, "t", 0, 5, 6),
            (5, "t", 0, 40, 41), (0, "t", 1, 100, 110), (1, "t", 1, 0, 5), (2, "t", 1, 110, 112)]
    audit = spark.createDataFrame(rows, AUDIT)
    got = {(r.partition, r.batch_id, r.kind, r.from_offset, r.until_offset) for r in offsets.continuity(audit).collect()}
    assert got == {(0, 2, "hole", 20, 25), (0, 3, "overlap", 28, 30), (0, 4, "overlap", 5, 6), (1, 1, "reset", 0, 5)}
    assert offsets.continuity(audit, max_gap=5).where("kind = 'hole'").count() == 0
    runs = {(r.partition, r.from_offset, r.until_offset, r.first_batch, r.last_batch) for r in offsets.runs(audit).collect()}
    assert runs == {(0, 0, 20, 0, 4), (0, 25, 41, 2, 5), (1, 0, 5, 1, 1), (1, 100, 112, 0, 2)}
    assert offsets.rewind(audit, 2) == {"t": {"0": 25, "1": 110}}
    assert offsets.rewind(audit, 3) == {"t": {"0": 28, "1": 112}}
    assert offsets.rewind(audit.where("batch_id > 0"), 0) == {"t": {"0": 10, "1": 0}}


def test_a_month_is_rewritten_and_the_others_stay(spark, scratch):
    path = scratch + "/s"
    schema = "dt date, l_partkey long, user_gender string, band string, n long, month date"
    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    rows = [(jan, 1, "F", "x", 3, jan.replace(day=1)), (feb, 1, "F", "x", 4, feb.replace(day=1))]
    S.write_summary(spark.createDataFrame(rows, schema), path)
    S.write_summary(spark.createDataFrame([(feb, 1, "F", "x", 9, feb.replace(day=1))], schema), path)
    table = spark.read.schema(S.SUMMARY_SCHEMA).parquet(path)
    assert {(r.dt, r.n) for r in table.collect()} == {(jan, 3), (feb, 9)}
    assert [r.n for r in S.read_summary(table, jan, jan).collect()] == [3]
    assert S.read_summary(table, dt.date(2024, 1, 6), feb).count() == 1


def sales(spark, n=4_000):
    ids = spark.range(n)
    lineitem = ids.selectExpr(
        "id div 4 AS l_orderkey", "CAST(id % 4 AS INT) AS l_linenumber", "IF(id % 3 = 0, 0, id % 50) AS l_partkey",
        "id AS l_suppkey", "'d' AS l_shipdate", "1.0D AS l_quantity", "1.0D AS l_extendedprice")
    orders = ids.where(f"id < {n // 4}").selectExpr(
        "id AS o_orderkey", "id % 70 AS o_custkey",
        "IF(id % 9 = 0, NULL, date_add(DATE'2024-01-01', CAST(id % 60 AS INT))) AS o_orderdate")
    customer = spark.range(70).selectExpr("id AS c_custkey", "'s' AS c_mktsegment")
    part = spark.range(50).selectExpr("id AS p_partkey", "1.0D AS p_retailprice", "'n' AS p_name", "'b' AS p_brand")
    return {"lineitem": lineitem, "orders": orders, "customer": customer, "part": part}


def test_summary_rows_move_once_and_are_counted_where_they_are_written(spark, scratch):
    t = sales(spark)
    sold = S.sale_orders(t["orders"], t["customer"]).checkpoint()
    rows = S.summary(t["lineitem"], sold)
    keys = ["dt", "l_partkey", "user_gender"]
    per = t["lineitem"].join(sold, F.expr("l_orderkey = o_orderkey")).groupBy(*keys).count()
    got = rows.groupBy(*keys).agg(F.sum("n").alias("count"))
    assert got.exceptAll(per).count() == per.exceptAll(got).count() == 0
    assert rows.count() == rows.dropDuplicates(["dt", "l_partkey", "user_gender", "band"]).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        S.write_summary(S.summary(t["lineitem"], sold), scratch + "/s")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    table = spark.read.schema(S.SUMMARY_SCHEMA).parquet(scratch + "/s")
    files = table.select("month", F.input_file_name().alias("f")).groupBy("month").agg(F.countDistinct("f").alias("f"))
    assert len(files.collect()) == 3 and 1 < files.agg(F.max("f")).first()[0] <= 8
    assert table.agg(F.sum("n")).first()[0] == per.agg(F.sum("count")).first()[0]


def test_wide_rows_lay_out_the_keys_of_the_lines_only(spark, scratch):
    import pyarrow.dataset as ds
    from daypulse.plans import sales_queries as Q
    for name, df in sales(spark).items():
        df.write.parquet(f"{scratch}/in/{name}.parquet")
    wide = Q.sale_detail_wide(spark, scratch + "/in")
    assert wide.count() == 4_000
    columns = [set(ds.dataset(f.replace("file://", "")).schema.names) for f in wide.inputFiles()]
    lines = [c for c in columns if "l_orderkey" in c]
    assert lines and all(c == {"l_orderkey", "l_linenumber", "l_partkey"} for c in lines)


def test_kept_tables_are_made_again_when_cleared_or_when_an_input_changes(spark, scratch):
    from daypulse.plans.derived import derived
    from daypulse.session import delete_path
    made = []

    def build(path):
        made.append(path)
        spark.range(3).write.parquet(path)

    spark.range(5).write.parquet(f"{scratch}/in.parquet")
    first = derived(spark, scratch, "t", ["in"], build)
    assert derived(spark, scratch, "t", ["in"], build) == first and len(made) == 1
    delete_path(spark, first)                   # as session.clear_work does
    second = derived(spark, scratch, "t", ["in"], build)
    assert spark.read.parquet(second).count() == 3 and len(made) == 2
    spark.range(6).write.mode("append").parquet(f"{scratch}/in.parquet")
    assert derived(spark, scratch, "t", ["in"], build) != second and len(made) == 3
