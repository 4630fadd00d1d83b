"""Edge fixtures: damaged logs, midnight, DDL and empty change messages,
quoted numbers, duplicates, two first orders of one user in a batch."""

import datetime as dt

from pyspark.sql import functions as F

from daypulse.functions.text import has_token, highlight, token_hits
from daypulse.functions.time import time_string_parts
from daypulse.operators import cdc
from daypulse.operators.dedup import daily_active, last_per_key
from daypulse.operators.logs import parse_logs, quarantine_counts, start_logs
from daypulse.operators.orders import first_order_flags
from daypulse.operators.search import nested_exists
from daypulse.schemas import RECORD

MIDNIGHT = 1704153600000  # 2024-01-02 00:00:00.000 UTC


def records(spark, values):
    rows = [(str(i), v, "app_log", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RECORD)


def log(mid, ts, start_part):
    return ('{"common":{"mid":"%s","uid":"u","ar":"1","ch":"web","vc":"v1"},%s"ts":%d}'
            % (mid, start_part, ts))


def test_content_split_and_quarantine(spark):
    vals = [
        log("a", MIDNIGHT, '"start":{"entry":"icon"},'),   # start
        log("b", MIDNIGHT, '"start":"",'),                  # event: empty
        log("c", MIDNIGHT, '"start":null,'),                # event: null
        log("d", MIDNIGHT, ""),                             # event: absent
        '{"common":{"mid":"e"},"ts"',                       # not JSON
        '{"ts":5}',                                         # no common
        '{"common":{"mid":"f"}}',                           # no ts
    ]
    p = parse_logs(records(spark, vals))
    kinds = {r.mid: r.kind for r in p.where("reason is null").collect()}
    assert kinds == {"a": "start", "b": "event", "c": "event", "d": "event"}
    reasons = {r.reason: r.n for r in quarantine_counts(p).collect()}
    assert reasons == {"malformed_json": 1, "missing_mid": 1, "missing_ts": 1}


def arrived(spark, values, at):
    rows = [(str(i), v, "app_log", 0, i, at) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RECORD)


def test_wrong_clocks_are_quarantined(spark):
    at = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    day = 86_400_000
    stamps = {"ok": MIDNIGHT, "late": MIDNIGHT - 29 * day, "soon": MIDNIGHT + day, "far": MIDNIGHT + 400 * day,
              "old": MIDNIGHT - 31 * day, "micro": MIDNIGHT * 1000, "huge": 2 ** 63 - 1, "neg": -1}
    vals = [log(m, t, '"start":{"x":1},') for m, t in stamps.items()]
    p = parse_logs(arrived(spark, vals, at))
    assert {r.mid for r in p.where("reason is null").collect()} == {"ok", "late", "soon"}
    assert {r.reason: r.n for r in quarantine_counts(p).collect()} == {"bad_ts": 5}
    assert {r.dt for r in p.where("reason is not null").collect()} == {None}
    # without an arrival time, years 1970 to 2100 pass
    p = parse_logs(records(spark, vals))
    assert {r.mid for r in p.where("reason = 'bad_ts'").collect()} == {"micro", "huge", "neg"}


def test_odd_order_times_and_ids(spark):
    from daypulse.operators.orders import first_orders
    rows = [(5, 1, "2020-01-02 00:00:00"), (6, 1, "2020-01-02"), (7, 1, "garbage"), (8, 1, None),
            (9, 2, None), (3, 2, "never"), (-4, 3, "1969-12-31 23:59:59"), (4, 3, "1969-12-31 23:59:59"),
            (None, 4, "2020-01-01 00:00:00"), (1, None, "2020-01-01 00:00:00")]
    orders = spark.createDataFrame(rows, "id long, user_id long, create_time string")
    got = {r.user_id: r.first_id for r in first_orders(orders).collect()}
    # midnight and the bare date tie: smaller id; no usable time: smallest id; ids may be negative
    assert got == {1: 5, 2: 3, 3: -4}
    flags = {r.id: r.if_first_order for r in first_order_flags(orders, None).collect()}
    assert flags == {5: "1", 6: "0", 7: "0", 8: "0", 9: "0", 3: "1", -4: "1", 4: "0", None: "0", 1: "0"}


def test_search_request(spark):
    from daypulse.operators.search import request
    turns = spark.createDataFrame(
        [(1, 0, "system", "x"), (1, 1, "user", "the The"), (2, 0, "user", "the the the"), (3, 0, "system", "the"),
         (4, 0, "system", "no"), (5, 0, "system", None)], "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in request(turns, "the", "system").orderBy("conv_id").collect()]
    assert got == [(1, 2, 1, "<em>the</em> <em>The</em>"), (3, 1, 0, "<em>the</em>")]


def test_work_folder_needs_a_shared_place_off_local(spark, monkeypatch):
    import pytest
    from daypulse import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def test_midnight_day_and_hour(spark):
    vals = [log("a", MIDNIGHT - 1, '"start":{"x":1},'), log("a", MIDNIGHT, '"start":{"x":1},')]
    p = parse_logs(records(spark, vals)).orderBy("ts").collect()
    assert (p[0].dt, p[0].hr) == (dt.date(2024, 1, 1), "23")
    assert (p[1].dt, p[1].hr) == (dt.date(2024, 1, 2), "00")
    dau = daily_active(start_logs(parse_logs(records(spark, vals))))
    assert dau.count() == 2  # one device, two days


def test_first_start_log_of_day_wins(spark):
    vals = [log("a", MIDNIGHT + 5000, '"start":{"x":1},'), log("a", MIDNIGHT + 1000, '"start":{"x":2},'),
            log("a", MIDNIGHT + 3000, '"start":{"x":3},')]
    r = daily_active(start_logs(parse_logs(records(spark, vals)))).collect()
    assert len(r) == 1 and r[0].ts == MIDNIGHT + 1000


def envelope_records(spark, values):
    return spark.createDataFrame([(None, v, "db", 0, i, None) for i, v in enumerate(values)], RECORD)


def test_cdc_ddl_empty_several_and_quoted(spark):
    vals = [
        '{"table":"order_info","isDdl":true,"data":null}',
        '{"table":"order_info","data":[]}',
        '{"table":"order_info","data":[{"id":"1","user_id":"7","final_total_amount":"12.50","create_time":"2021-03-14 09:26:53"},'
        '{"id":"2","user_id":"x","final_total_amount":"1.5","create_time":"2021-03-14"},'
        '{"id":"3","user_id":"8","final_total_amount":null,"create_time":null}]}',
        'not json',
    ]
    rows = cdc.explode_rows(cdc.parse_envelopes(envelope_records(spark, vals)))
    typed = cdc.with_time_parts(cdc.typed_orders(rows)).orderBy("id").collect()
    assert [r.id for r in typed] == [1, 2, 3]
    assert typed[0].user_id == 7 and str(typed[0].final_total_amount) == "12.50"
    assert typed[1].user_id is None            # bad number -> null, not a failed batch
    assert typed[0].create_date == "2021-03-14" and typed[0].create_hour == "09"
    assert typed[1].create_date == "2021-03-14" and typed[1].create_hour is None
    assert typed[2].create_date is None and typed[2].create_hour is None
    routed = cdc.routed(rows).collect()
    assert {r.topic for r in routed} == {"ODS_ORDER_INFO"}
    assert all('null' not in r.value for r in routed)   # null-valued keys left out


def test_upsert_last_wins_ignores_arrival_order_and_duplicates(spark):
    ch = spark.createDataFrame([(1, "c", 3), (1, "a", 1), (1, "c", 3), (1, "b", 2), (2, "x", 1)],
                               "id long, status string, version long")
    out = {r.id: (r.status, r.version) for r in last_per_key(ch, ["id"], ["version"], ["status"]).collect()}
    assert out == {1: ("c", 3), 2: ("x", 1)}


def test_two_first_orders_of_one_user_in_a_batch(spark):
    batch = spark.createDataFrame(
        [(10, 1, "2020-01-02 00:00:00"), (11, 1, "2020-01-01 00:00:00"), (12, 1, "2020-01-01 00:00:00"),
         (20, 2, "2020-01-01 00:00:00"), (30, 3, "2020-01-05 00:00:00")],
        "id long, user_id long, create_time string")
    state = spark.createDataFrame([(2, "1"), (3, "0")], "user_id long, if_consumed string")
    flags = {r.id: r.if_first_order for r in first_order_flags(batch, state).collect()}
    # user 1: earliest time, then smallest id; user 2 consumed before; user 3 state says not consumed
    assert flags == {10: "0", 11: "1", 12: "0", 20: "0", 30: "1"}


def test_time_string_parts_null_and_date_only(spark):
    df = spark.createDataFrame([("2021-03-14 09:26:53",), ("2021-03-14",), (None,)], "s string")
    d, h = time_string_parts(F.col("s"))
    assert [tuple(r) for r in df.select(d, h).collect()] == [("2021-03-14", "09"), ("2021-03-14", None), (None, None)]


def test_token_match_and_highlight(spark):
    df = spark.createDataFrame([("The the, THE! other théme xthe the_ the",)], "t string")
    r = df.select(has_token(F.col("t"), "the").alias("m"), token_hits(F.col("t"), "the").alias("n"),
                  highlight(F.col("t"), "the", "<em>", "</em>").alias("h")).first()
    assert r.m is True and r.n == 4
    assert r.h == "<em>The</em> <em>the</em>, <em>THE</em>! other théme xthe the_ <em>the</em>"


def test_nested_exists(spark):
    docs = spark.createDataFrame(
        [("a", [("x",), ("y",)]), ("b", [("z",)]), ("c", [])],
        "name string, actorList array<struct<name:string>>")
    got = [r.name for r in nested_exists(docs, "actorList", lambda a: a["name"] == "y").collect()]
    assert got == ["a"]


def test_keyset_page_continues_offset_page(spark):
    from daypulse.operators import sales as S
    from daypulse.sources.tables import read_table
    from tests.conftest import SF_SMALL
    t = {n: read_table(spark, SF_SMALL, n) for n in ("lineitem", "orders", "customer", "part")}
    o = S.sale_orders(t["orders"], t["customer"])
    counts = S.sku_counts(S.summary(t["lineitem"], o))
    d = S.wide_detail(t["lineitem"], o, t["part"], counts, keep_key=True)
    keys = [f"_k_{k}" for k in S.DETAIL_KEY]
    first = S.keyset_page(d, None, 15).collect()
    nxt = S.keyset_page(d, tuple(first[-1][k] for k in keys), 10).select(*S.WIDE_COLUMNS).collect()
    assert [tuple(r) for r in nxt] == [tuple(r) for r in S.page(d, 15, 10).collect()]


def test_lookup_pruned_to_batch_keys(spark, scratch):
    from daypulse.sources.lookup import for_keys, read_lookup
    spark.createDataFrame([(1, "1"), (2, "1"), (3, "0")], "user_id long, if_consumed string") \
        .write.parquet(scratch + "/state")
    st = read_lookup(spark, path=scratch + "/state")
    got = sorted(r.user_id for r in for_keys(st, spark.createDataFrame([(2,), (3,), (3,), (9,)], "user_id long"),
                                             ["user_id"]).collect())
    assert got == [2, 3]


def test_dau_total_from_logs_exact_and_approx(spark):
    from daypulse.operators.dashboard import dau_total_from_logs
    vals = [log(m, MIDNIGHT + i, '"start":{"x":1},') for i, m in enumerate("abcabcd")]
    start = start_logs(parse_logs(records(spark, vals)))
    assert dau_total_from_logs(start, dt.date(2024, 1, 2)).first().value == 4
    assert dau_total_from_logs(start, dt.date(2024, 1, 2), approx=True).first().value == 4


def test_reply_shapes(spark):
    from daypulse.operators.dashboard import kpi_json
    from daypulse.operators.sales import province_json, stat_json
    kpi = spark.createDataFrame([("new_mid", "New devices", 3), ("dau", "Daily active devices", 7)],
                                "id string, name string, value long")
    assert kpi_json(kpi).first().json == (
        '[{"id":"dau","name":"Daily active devices","value":7},{"id":"new_mid","name":"New devices","value":3}]')
    st = spark.createDataFrame([("age", "under 20", 2), ("gender", "M", 4), ("age", "20-30", 1), ("gender", "F", 3)],
                               "kind string, name string, value long")
    assert stat_json(st).first().json == (
        '{"age":[{"name":"20-30","value":1},{"name":"under 20","value":2}],'
        '"gender":[{"name":"F","value":3},{"name":"M","value":4}]}')
    pv = spark.createDataFrame([("B", 2, 1.0, 0), ("A", 0, 0.0, 0)], "name string, value long, amount double, bin long")
    assert province_json(pv).first().json == '[{"name":"A","value":0},{"name":"B","value":2}]'


def test_one_pass_kpi_equals_two_aggregates(spark):
    from daypulse import params
    from daypulse.operators.dashboard import first_seen, kpi_total, kpi_total_from_logs
    from daypulse.operators.dedup import daily_active_keys
    from daypulse.operators.logs import good_logs
    from daypulse.plans.log_queries import parsed_logs
    from tests.conftest import SF_SMALL
    logs = parsed_logs(spark, SF_SMALL)
    one = sorted(tuple(r) for r in kpi_total_from_logs(good_logs(logs), params.LOG_DAY).collect())
    two = sorted(tuple(r) for r in kpi_total(daily_active_keys(start_logs(logs)), first_seen(good_logs(logs)),
                                            params.LOG_DAY).collect())
    assert one == two


def test_work_folder_is_the_applications_own(spark):
    from daypulse.session import path_exists, work_path
    a, b = work_path(spark, "x"), work_path(spark, "x")
    assert a != b and spark.sparkContext.applicationId in a and not path_exists(spark, a)
