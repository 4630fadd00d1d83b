"""Stream behaviour: watermark delay around midnight, wrong clocks, replayed
batches, resume from checkpoint, merges, repairs and the deployable jobs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daypulse import params
from daypulse.operators.logs import parse_logs, start_logs
from daypulse.schemas import RECORD
from daypulse.session import child_folders, delete_path
from daypulse.sinks.parts import live_parts, merge_parts, read_parts, write_batch
from daypulse.sinks.topics import file_topics
from daypulse.streaming import dau as S
from daypulse.streaming import jobs
from daypulse.streaming.first_order import flag_batch, order_table
from daypulse.streaming.hours import all_hours, hour_table
from daypulse.streaming.keyed import with_state
from daypulse.streaming.reconcile import late_days, recompute, reconcile, repair, repair_late
from daypulse.streaming.runner import rows_dropped_by_watermark, run_until_done
from tests.conftest import SF_SMALL
from tests.test_edges import MIDNIGHT, log

DAY = 86_400_000
PARTS = 2


def land(spark, landing, i, values, at=None):
    rows = [("k", v, "app_log", 0, i * 100 + k, at) for k, v in enumerate(values)]
    spark.createDataFrame(rows, RECORD).coalesce(1).write.parquet(f"{landing}/window-{i:012d}")


def run_batches(spark, scratch, delay, batches, at=None):
    """One start per batch: each is a restart from the checkpoint."""
    landing, table, ckpt = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt"))
    progress = []
    for i, vals in enumerate(batches):
        land(spark, landing, i, vals, at)
        progress += run_until_done(S.start_state_dedup(spark, landing, table, ckpt, delay, PARTS))
    keys = {(str(r.dt), r.mid) for r in S.daily_table(spark, table).collect()}
    return keys, rows_dropped_by_watermark(progress)


START = '"start":{"e":1},'


def day1(mid):
    return log(mid, MIDNIGHT - 10_000, START)           # 2024-01-01 23:59:50


def day2(mid, off=0):
    return log(mid, MIDNIGHT + off, START)              # 2024-01-02 00:00


def test_straggler_dropped_with_one_day_kept_with_two(spark, scratch):
    batches = [[day1("a")], [day2("b")], [day1("c"), day1("a")]]
    keys1, dropped1 = run_batches(spark, scratch + "/one", "1 day", batches)
    keys2, dropped2 = run_batches(spark, scratch + "/two", "2 days", batches)
    assert ("2024-01-01", "c") not in keys1 and dropped1 >= 1
    assert sorted(keys2) == [("2024-01-01", "a"), ("2024-01-01", "c"), ("2024-01-02", "b")]


def test_same_device_in_two_batches_and_twice_in_one(spark, scratch):
    batches = [[day1("a")] * 20, [day1("a"), day2("a")]]
    keys, _ = run_batches(spark, scratch, "2 days", batches)
    assert sorted(keys) == [("2024-01-01", "a"), ("2024-01-02", "a")]


def test_one_wrong_clock_does_not_stop_the_count(spark, scratch):
    at = dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc)
    ahead = log("bad", MIDNIGHT + 400 * DAY, START)
    keys, dropped = run_batches(spark, scratch, "2 days", [[day1("a"), ahead], [day2("b")], [day2("c"), day1("d")]], at)
    assert dropped == 0
    assert {m for _, m in keys} == {"a", "b", "c", "d"}


def run_devices(spark, scratch, batches, delay="2 days", at=None, first=0):
    """The device job, restarted for each batch. Returns table, late table, progress."""
    landing, table, late, ckpt = (f"{scratch}/{x}" for x in ("landing", "table", "late", "ckpt"))
    progress = []
    for i, vals in enumerate(batches, first):
        land(spark, landing, i, vals, at)
        records = jobs.source(spark, PARTS, landing=landing)
        progress += run_until_done(jobs.dau_job(records, table, late, ckpt, delay, interval=None))
    return table, late, progress


def device_keys(spark, table):
    return sorted((r.mid, str(r.dt), r.ts) for r in S.daily_table(spark, table).collect())


def test_device_job_keeps_the_earliest_row_of_the_first_batch(spark, scratch):
    early = log("a", MIDNIGHT - 20_000, START)
    table, late, _ = run_devices(spark, scratch, [[day1("a"), early], [day1("a"), day1("b"), day2("a")],
                                                 [log("b", MIDNIGHT - 30_000, START)]])
    assert device_keys(spark, table) == [("a", "2024-01-01", MIDNIGHT - 20_000), ("a", "2024-01-02", MIDNIGHT),
                                         ("b", "2024-01-01", MIDNIGHT - 10_000)]
    assert read_parts(spark, late, "dt") is None


def test_device_sink_delivered_again_writes_the_same(spark, scratch):
    """A batch that is delivered again brings the state of before it."""
    from daypulse.operators.dedup import DAU_COLUMNS
    rows = (start_logs(parse_logs(spark.createDataFrame([("k", v, "t", 0, i, None) for i, v in enumerate(
        [day1("a"), day1("a"), day1("b"), day2("c")])], RECORD))).select(*DAU_COLUMNS, "partition", "offset"))
    touched = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 2), (dt.date(2024, 1, 1), "b", 7)],
                                    "dt date, mid string, n_ever long")
    batch = with_state(rows, touched)
    sink = S.device_sink(scratch + "/t", scratch + "/late")
    for _ in range(2):
        sink(batch, 5)
    assert [k[0] for k in device_keys(spark, scratch + "/t")] == ["a"]          # b was known
    assert [r.mid for r in S.late_rows(spark, scratch + "/late").collect()] == ["c"]   # its day was closed


def test_state_of_known_users_is_not_read(spark, scratch):
    """Ten times the known users: a batch of one new and one known user updates
    two state rows, reads one file and writes one."""
    def order(i, user):
        return {"id": str(i), "user_id": str(user), "create_time": "2020-01-01 10:00:00"}

    per_batch = {}
    for known in (30, 300):
        landing, table, ckpt = (f"{scratch}/{known}/{x}" for x in ("l", "t", "c"))
        land(spark, landing, 0, [change("order_info", *(order(u, u) for u in range(1, known + 1)))])
        land(spark, landing, 1, [change("order_info", order(10_001, 5), order(10_002, 9_999))])
        progress = run_until_done(jobs.order_job(jobs.source(spark, PARTS, landing=landing, max_files=1), table, None,
                                                 ckpt, interval=None))
        last = [p for p in progress if p["numInputRows"]][-1]
        per_batch[known] = (last["numInputRows"], last["stateOperators"][0]["numRowsUpdated"])
        assert last["stateOperators"][0]["numRowsTotal"] == known + 1
        flags = {r.id: r.if_first_order for r in order_table(spark, table).collect()}
        assert flags[10_001] == "0" and flags[10_002] == "1" and len(flags) == known + 2
        assert sorted(child_folders(spark, f"{scratch}/{known}")) == ["c", "l", "t"]     # no state table
    assert per_batch[30] == per_batch[300] and per_batch[30][1] == 2


def test_parts_do_not_grow_with_batches_and_survive_a_crash_in_a_merge(spark, scratch):
    table = scratch + "/t"
    day = f"{table}/dt=2024-01-01"

    def batch(k):
        write_batch(spark.createDataFrame([(dt.date(2024, 1, 1), f"m{k}")], "dt date, mid string"), table, "dt", k)
        merge_parts(spark, table, "dt", ["2024-01-01"], 3)

    def mids():
        return sorted(r.mid for r in read_parts(spark, table, "dt").collect())

    for k in range(10):
        batch(k)
        assert len(live_parts(spark, day)) <= 3 and len(child_folders(spark, day)) <= 8
    whole = sorted(f"m{k}" for k in range(10))
    assert mids() == whole
    batch(9)                # again, as after a crash: its rows are in no part twice
    assert mids() == whole
    # a merge that was written but whose marker is missing does not count
    merged = [p for p in live_parts(spark, day) if p.startswith("part=m-")][0]
    spark.read.parquet(f"{day}/{merged}").write.parquet(f"{day}/part=m-000000000099")
    delete_path(spark, f"{day}/part=m-000000000099/_SUCCESS")
    assert mids() == whole


def test_a_frame_built_before_a_merge_can_be_run_after_it(spark, scratch):
    table = scratch + "/t"
    for k in range(5):
        write_batch(spark.createDataFrame([(dt.date(2024, 1, 1), f"m{k}")], "dt date, mid string"), table, "dt", k)
    frame = read_parts(spark, table, "dt")
    merge_parts(spark, table, "dt", ["2024-01-01"], 3)
    assert frame.count() == 5 == read_parts(spark, table, "dt").count()


def test_compaction_of_an_appended_table(spark, scratch):
    table = scratch + "/t"
    schema = "month string, id long"

    def batch(k):
        write_batch(spark.createDataFrame([("2024-01", k), ("2024-02", 100 + k)], schema), table, "month", k)

    def ids():
        return sorted(r.id for r in read_parts(spark, table, "month").collect())

    for k in range(5):
        batch(k)
    frame = read_parts(spark, table, "month")
    jobs.compact(spark, table, "month", ["2024-01"], every=4)
    assert [p[:7] for p in live_parts(spark, f"{table}/month=2024-01")] == ["part=m-"]
    assert len(live_parts(spark, f"{table}/month=2024-02")) == 5
    whole = [*range(5), *range(100, 105)]
    assert ids() == whole and frame.count() == 10
    batch(4)                # delivered again after it was merged
    assert ids() == whole
    for k in range(5, 9):
        batch(k)
    jobs.compact(spark, table, "month", every=4)
    assert ids() == [*range(9), *range(100, 109)]
    assert all(len(live_parts(spark, f"{table}/month=2024-0{m}")) == 1 for m in (1, 2))
    assert "part=b-000000000001" not in child_folders(spark, f"{table}/month=2024-01")


ORDERS = "id long, user_id long, create_time string"


def flags(spark, orders, users):
    got = flag_batch(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(users, "user_id long, n_ever long"))
    return {(r.id, r.user_id): r.if_first_order for r in got.collect()}


def test_first_order_flags_of_a_batch(spark):
    orders = [(1, 7, "2020-01-02 00:00:00"), (2, 7, "2020-01-01 00:00:00"), (3, 8, "2020-02-01 00:00:00"),
              (4, 9, None), (None, 10, "2020-01-01 00:00:00"), (5, None, "2020-01-01 00:00:00")]
    # 7 and 9 have all their orders in the batch, 8 has had two before
    assert flags(spark, orders, [(7, 2), (8, 3), (9, 1)]) == {
        (1, 7): "0", (2, 7): "1", (3, 8): "0", (4, 9): "1", (None, 10): "0", (5, None): "0"}


def test_user_whose_first_order_had_no_time_is_flagged_once(spark, scratch):
    landing, table = scratch + "/l", scratch + "/t"
    land(spark, landing, 0, [change("order_info", {"id": "1", "user_id": "7"}, {"user_id": "8", "create_time": "2020-01-01"})])
    land(spark, landing, 1, [change("order_info", *({"id": str(i), "user_id": str(u), "create_time": "2020-02-01 00:00:00"}
                                                    for i, u in ((2, 7), (3, 8))))])
    run_until_done(jobs.order_job(jobs.source(spark, PARTS, landing=landing, max_files=1), table, None, scratch + "/c",
                                  interval=None))
    got = {(r.id, r.user_id): r.if_first_order for r in order_table(spark, table).collect()}
    assert got == {(1, 7): "1", (None, 8): "0", (2, 7): "0", (3, 8): "1"}


def test_order_job_delivers_a_batch_again_with_the_same_flags(spark, scratch):
    """The commit of the last batch is lost: it runs again from the state before it."""
    landing, table, ckpt = scratch + "/l", scratch + "/t", scratch + "/c"
    for k, (i, u) in enumerate(((1, 7), (2, 7), (3, 8))):
        land(spark, landing, k, [change("order_info", {"id": str(i), "user_id": str(u), "create_time": "2020-01-01 00:00:00"})])

    def run():
        run_until_done(jobs.order_job(jobs.source(spark, PARTS, landing=landing, max_files=1), table, None, ckpt,
                                      interval=None))
        return {r.id: r.if_first_order for r in order_table(spark, table).collect()}

    before = run()
    assert before == {1: "1", 2: "0", 3: "1"}
    delete_path(spark, f"{ckpt}/commits/2")
    assert run() == before and order_table(spark, table).count() == 3


def test_upsert_versions_and_merges(spark, scratch):
    from daypulse.sinks.upsert import current, upsert
    path = scratch + "/u"
    for k in range(7):
        rows = [(1, f"v{9 - k}", 9 - k), (100 + k, "x", 1)]
        upsert(spark, spark.createDataFrame(rows, "id long, status string, version long"), path, k, "id",
               ["version"], ["status"], 2, 3)
    got = {r.id: (r.status, r.version) for r in current(spark, path, "id", ["version"], ["status"]).collect()}
    assert got == {1: ("v9", 9), **{100 + k: ("x", 1) for k in range(7)}}


def test_a_failed_read_is_not_an_empty_table(spark, scratch):
    table, late = scratch + "/table", scratch + "/late"
    for path in (table, late):
        write_batch(spark.createDataFrame([("a", "u", "1", "c", "v", dt.date(2024, 1, 1), "23", 5)],
                                          "mid string, uid string, ar string, ch string, vc string, dt date, hr string, "
                                          "ts long"), path, "dt", 0)
    part = child_folders(spark, f"{table}/dt=2024-01-01")[0]
    for name in os.listdir(f"{table}/dt=2024-01-01/{part}"):
        if name.endswith(".parquet"):
            with open(f"{table}/dt=2024-01-01/{part}/{name}", "wb") as f:
                f.write(b"broken")
    with pytest.raises(Exception):
        repair_late(spark, table, late).collect()


def test_resume_processes_only_new_files(spark, scratch):
    landing, table, ckpt = scratch + "/l", scratch + "/t", scratch + "/c"
    land(spark, landing, 0, [day1("a")])
    run_until_done(S.start_state_dedup(spark, landing, table, ckpt, "2 days", PARTS))
    p = run_until_done(S.start_state_dedup(spark, landing, table, ckpt, "2 days", PARTS))
    assert sum(x["numInputRows"] for x in p) == 0      # nothing re-read after restart
    land(spark, landing, 1, [day1("b")])
    p = run_until_done(S.start_state_dedup(spark, landing, table, ckpt, "2 days", PARTS))
    assert sum(x["numInputRows"] for x in p) == 1
    assert S.daily_table(spark, table).where(F.col("mid") == "b").count() == 1


def test_a_stream_leaves_the_callers_settings_alone(spark, scratch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    landing = scratch + "/l"
    land(spark, landing, 0, [day1("a")])
    q = S.start_state_dedup(spark, landing, scratch + "/t", scratch + "/c", "2 days", 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    run_until_done(q)
    state = child_folders(spark, f"file:{scratch}/c/state/0")
    assert len([n for n in state if n.isdigit()]) == 3


def finish(q):
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_dau_job_runs_with_processing_time_trigger(spark, scratch):
    landing = scratch + "/l"
    land(spark, landing, 0, [day1("a"), day1("b"), day2("a")])
    finish(jobs.dau_job(jobs.source(spark, PARTS, landing=landing), scratch + "/t", scratch + "/late",
                        scratch + "/c", "2 days", interval="1 second"))
    keys = sorted((r.mid, str(r.dt)) for r in S.daily_table(spark, scratch + "/t").collect())
    assert keys == [("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-01-01")]


def test_audit_job_and_rewind(spark, scratch):
    from daypulse.operators.offsets import continuity, rewind
    landing, audit = scratch + "/l", scratch + "/audit"
    for k in range(3):
        land(spark, landing, k, [day1("a"), day1("b")])     # offsets 0-1, 100-101, 200-201
    run_until_done(jobs.audit_job(jobs.source(spark, PARTS, landing=landing, max_files=1), audit, scratch + "/c",
                                  interval=None))
    rows = spark.read.parquet(audit)
    assert sum(r.n for r in rows.collect()) == 6
    assert [(r.kind, r.from_offset, r.until_offset) for r in continuity(rows).orderBy("batch_id").collect()] == [
        ("hole", 2, 100), ("hole", 102, 200)]
    assert rewind(rows, 1) == {"app_log": {"0": 100}} and rewind(rows, 9) == {"app_log": {"0": 202}}


def test_console_preview_takes_every_batch(spark, scratch):
    landing = scratch + "/l"
    land(spark, landing, 0, [day1("seen-on-console")])
    rows = parse_logs(jobs.source(spark, PARTS, landing=landing)).select("mid", "kind")
    progress = run_until_done(jobs.console_preview(rows, interval=None))
    assert sum(p["numInputRows"] for p in progress) == 1 and "Console" in progress[0]["sink"]["description"]


def test_a_window_lands_in_many_files_and_is_one_batch(spark, scratch):
    """No task holds a whole window; small windows are filled up, so that each is
    still one micro-batch."""
    from daypulse.sources.files import land_windows
    sent = [("k" * 30, f"v{i}", "app_log", 0, i, at) for at, n in ((1, 3000), (100, 1), (200, 2000)) for i in range(n)]
    rows = spark.createDataFrame(sent, "key string, value string, topic string, partition int, offset long, at long")
    records = rows.withColumn("timestamp", F.timestamp_millis("at")).drop("at").repartition(6)
    landing, audit = scratch + "/l", scratch + "/audit"
    files = land_windows(spark, records, landing, 50, file_bytes=8_000)
    assert files > 1
    for k, n in enumerate((3000, 1, 2000)):
        landed = spark.read.parquet(f"{landing}/window-{k:012d}")
        per_file = [r["count"] for r in landed.where("topic IS NOT NULL").groupBy(F.input_file_name()).count().collect()]
        assert len({*landed.inputFiles()}) == files and sum(per_file) == n and (n == 1 or max(per_file) < n)
    run_until_done(jobs.audit_job(jobs.source(spark, PARTS, landing=landing, max_files=files), audit, scratch + "/c",
                                  interval=None))
    assert [(r.batch_id, r.n) for r in spark.read.parquet(audit).orderBy("batch_id").collect()] == [(0, 3000), (1, 1), (2, 2000)]


def test_order_batch_is_joined_in_the_callers_number_of_tasks(spark, scratch):
    """The state's few partitions bind the state alone, and are as before after
    the batch."""
    from daypulse.streaming.conf import batch_settings, stream_session
    own = stream_session(spark, 2)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    own.conf.set(keys[1], "false")                      # as the engine has it in a stream
    with batch_settings(own):
        assert [own.conf.get(k) for k in keys] == [spark.conf.get(keys[0]), "true"]
    assert [own.conf.get(k) for k in keys] == ["2", "false"]


def test_fan_out_sends_a_redelivered_change_once(spark, scratch):
    landing, out = scratch + "/l", scratch + "/out"
    one, two = change("order_info", {"id": "1"}), change("order_info", {"id": "2"}, {"id": "2", "x": "new"})
    land(spark, landing, 0, [one, one, two])
    land(spark, landing, 1, [one, two, change("user_info", {"id": "1"})])
    run_until_done(jobs.fan_out_job(jobs.source(spark, PARTS, landing=landing, max_files=1), file_topics(out),
                                    scratch + "/c", None, once_within="1 hour"))
    got = sorted((r.key, r.value) for r in read_parts(spark, out, "topic").collect())
    assert got == [("order_info:1", '{"id":"1"}'), ("order_info:2", '{"id":"2","x":"new"}'), ("order_info:2", '{"id":"2"}'),
                   ("user_info:1", '{"id":"1"}')]


def test_hour_job_emits_each_closed_day_once(spark, scratch):
    landing, table = scratch + "/l", scratch + "/t"
    hour = 3_600_000
    land(spark, landing, 0, [log("a", MIDNIGHT + 5 * hour, START), log("b", MIDNIGHT + 6 * hour, START)])
    land(spark, landing, 1, [log("a", MIDNIGHT + 4 * hour, START), log("a", MIDNIGHT + 7 * hour, START),
                             log("c", MIDNIGHT + 30 * hour, START)])       # out of order, within the delay
    land(spark, landing, 2, [log("d", MIDNIGHT + 100 * hour, START)])
    for _ in range(2):      # a restart emits nothing again
        run_until_done(jobs.hour_job(jobs.source(spark, PARTS, landing=landing, max_files=1), table, scratch + "/c",
                                     "2 days", interval=None))
    got = sorted((str(r.dt), r.hr, r.n) for r in hour_table(spark, table).collect())
    assert got == [("2024-01-02", "04", 1), ("2024-01-02", "06", 1), ("2024-01-03", "06", 1)]


def test_hours_of_open_days_are_in_the_result(spark, scratch):
    landing, table, ckpt = scratch + "/l", scratch + "/t", scratch + "/c"
    hour = 3_600_000

    def hours():
        run_until_done(jobs.hour_job(jobs.source(spark, PARTS, landing=landing, max_files=1), table, ckpt, "2 days",
                                     interval=None))
        return sorted((str(r.dt), r.hr, r.n) for r in all_hours(spark, table, ckpt).collect())

    land(spark, landing, 0, [log("a", MIDNIGHT + 5 * hour, START), log("b", MIDNIGHT + 5 * hour, START)])
    assert hours() == [("2024-01-02", "05", 2)]         # no day is closed yet
    land(spark, landing, 1, [log("a", MIDNIGHT + 4 * hour, START), log("c", MIDNIGHT + 100 * hour, START),
                             log("c", MIDNIGHT + 99 * hour, START)])
    assert hours() == [("2024-01-02", "04", 1), ("2024-01-02", "05", 1), ("2024-01-06", "03", 1)]


def change(table, *rows):
    import json
    return json.dumps({"table": table, "type": "INSERT", "data": list(rows)})


def test_fan_out_job_routes_tables_apart_and_replays_exactly(spark, scratch):
    landing, out = scratch + "/l", scratch + "/out"
    land(spark, landing, 0, [change("order_info", {"id": "1", "x": None}, {"id": "2", "x": "y"}),
                             change("user_info", {"id": "1"}), change("user_info"), "not json",
                             '{"table":"order_info","isDdl":true,"data":null}'])
    for ckpt in ("/c", "/c2"):   # a lost checkpoint delivers the batch again
        finish(jobs.fan_out_job(jobs.source(spark, PARTS, landing=landing), file_topics(out), scratch + ckpt, "1 second"))
    got = sorted((r.topic, r.key, r.value) for r in read_parts(spark, out, "topic").collect())
    assert got == [("ODS_ORDER_INFO", "order_info:1", '{"id":"1"}'), ("ODS_ORDER_INFO", "order_info:2", '{"id":"2","x":"y"}'),
                   ("ODS_USER_INFO", "user_info:1", '{"id":"1"}')]


def test_log_split_job_writes_two_topics_and_a_quarantine(spark, scratch):
    landing, out, bad = scratch + "/l", scratch + "/out", scratch + "/bad"
    vals = [day1("a"), log("b", MIDNIGHT, ""), '{"ts":5}', log("c", 2 ** 63 - 1, START)]
    land(spark, landing, 0, vals)
    finish(jobs.log_split_job(jobs.source(spark, PARTS, landing=landing), file_topics(out), bad, scratch + "/c", "1 second"))
    assert sorted((r.topic, r.key, r.value) for r in read_parts(spark, out, "topic").collect()) == [
        (params.EVENT_TOPIC, "b", vals[1]), (params.START_TOPIC, "a", vals[0])]
    assert {r.reason: r.value for r in read_parts(spark, bad, "reason").collect()} == {"missing_mid": vals[2], "bad_ts": vals[3]}


def test_order_job_flags_and_enriches(spark, scratch):
    landing = scratch + "/l"
    provinces = spark.createDataFrame([(5, "P5", "1", "N5")], "province_id long, province_name string, "
                                      "province_area_code string, province_iso_code string")
    users = spark.createDataFrame([(7, "20-30", "F")], "user_id long, user_age_group string, user_gender string")
    order = {"id": "1", "user_id": "7", "province_id": "5", "create_time": "2020-01-01 10:00:00"}
    land(spark, landing, 0, [change("order_info", order, {**order, "id": "2"})])
    land(spark, landing, 1, [change("order_info", {**order, "id": "3"}, {"id": "4", "user_id": "9", "create_time": "?"})])
    asked = []
    finish(jobs.order_job(jobs.source(spark, PARTS, landing=landing, max_files=1), scratch + "/t",
                          lambda _: asked.append(1) or (provinces, users), scratch + "/c", "1 second"))
    assert len(asked) == 2      # the dimensions are asked for in every batch
    got = sorted((r.id, r.if_first_order, r.province_name, r.user_gender, r.create_hour)
                 for r in order_table(spark, scratch + "/t").collect())
    assert got == [(1, "1", "P5", "F", "10"), (2, "0", "P5", "F", "10"), (3, "0", "P5", "F", "10"), (4, "1", None, None, None)]


def test_late_rows_and_repair_make_the_table_whole(spark):
    from daypulse.operators.dedup import daily_active
    from daypulse.plans.stream_queries import run_dau_job, stalled
    from daypulse.sinks.files import archive_raw
    from daypulse.sinks.parts import groups
    from daypulse.sources.replay import app_log_records
    recs = stalled(app_log_records(spark, SF_SMALL), params.STALL_PARTITION, params.STALL_FROM,
                   params.STALL_TO, params.STALL_DELAY_MS)
    archive = spark.read.parquet(archive_raw(spark, recs))
    table, late, progress = run_dau_job(spark, recs)
    assert rows_dropped_by_watermark(progress) > 0
    days = [params.STALL_FROM, params.STALL_TO]
    # only days that the engine closed too soon are read: the second came late, too, but was still open
    assert groups(spark, late, "dt") == [params.STALL_FROM.isoformat()]
    assert late_days(archive, params.STREAM_DELAY_MS) == days
    batch = recompute(archive, days)
    keys = S.stream_keys(spark, table, days)
    status = {r.status: r.n for r in reconcile(keys, batch.select("dt", "mid"))
              .groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert "extra" not in status
    for _ in range(2):
        assert repair_late(spark, table, late).count() == status["repaired"] > 0
    after = S.daily_table(spark, table)
    whole = daily_active(start_logs(parse_logs(archive)))
    assert after.count() == whole.count() == after.select("dt", "mid").distinct().count()
    repair(table, batch, keys)      # from the archive: the same rows
    assert S.daily_table(spark, table).count() == whole.count()


def test_second_repair_keeps_the_first(spark, scratch):
    at = dt.datetime(2024, 1, 9, tzinfo=dt.timezone.utc)
    table, late, _ = run_devices(spark, scratch, [[day1("a")], [log("x", MIDNIGHT + 6 * DAY, START)], [day1("late1")]],
                                 at=at)
    assert [r.mid for r in repair_late(spark, table, late).collect()] == ["late1"]
    run_devices(spark, scratch, [[day1("late1"), day1("late2"), day1("a")]], at=at, first=3)
    repair_late(spark, table, late)
    assert [k[0] for k in device_keys(spark, table)] == ["a", "late1", "late2", "x"]
