"""Streams with one state row per key: seen keys, first days, windows from panes."""

import os
import re

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.operators import alert as A
from retail_pulse.operators.dedup import dedup_device_day, first_seen_dates
from retail_pulse.streaming import alert as SA
from retail_pulse.streaming import jobs
from retail_pulse.streaming import keyed as K
from retail_pulse.streaming.runner import stream_conf

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC
HOUR, DAY = 3_600_000, 86_400_000
LOG = "mid string, ms long, event_id long"
TABLE = "mid string, ms long, event_id long, log_date string, _batch_id long"
NOW = {"availableNow": True}


def land(spark, path, name, rows, schema=LOG):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(path, name))


def logs(spark, src, files=1):
    s = spark.readStream.schema(LOG).option("maxFilesPerTrigger", files).parquet(os.path.join(src, "*"))
    t = F.timestamp_millis("ms")
    return s.withColumn("ts_event", t).withColumn("log_date", F.date_format(t, "yyyy-MM-dd"))


@pytest.fixture()
def work(spark, tmp_dir):
    with stream_conf(spark, 2):
        yield {p: os.path.join(tmp_dir, p) for p in ("src", "table", "ckpt")}


def run_dau(spark, work, delay="1 day"):
    q = K.start_dau_state_stream(logs(spark, work["src"]), work["table"], work["ckpt"], NOW, ["ms", "event_id"], delay)
    assert q.awaitTermination(300)
    return q


def table(spark, work):
    return sorted((r.mid, r.log_date, r.ms, r.event_id) for r in K.dau_state_table(spark, work["table"], TABLE).collect())


def test_device_days_across_batches_and_restarts(spark, work):
    d1, d2 = "2024-01-01", "2024-01-02"
    land(spark, work["src"], "a", [("m1", T0 + 5, 1), ("m1", T0 + 4, 2), (None, T0, 3), ("m2", None, 4), ("m3", T0 + 9, 5), ("m3", T0 + 9, 6)])
    run_dau(spark, work)
    assert table(spark, work) == [("m1", d1, T0 + 4, 2), ("m3", d1, T0 + 9, 5)]
    # an older record replaces the winner, an equal or younger one does not, another day is a row of its own
    land(spark, work["src"], "b", [("m1", T0 + 2, 7), ("m3", T0 + 9, 5), ("m3", T0 + 50, 8), ("m4", T0 + DAY, 9), ("m1", T0 + DAY, 10)])
    run_dau(spark, work)
    assert table(spark, work) == [("m1", d1, T0 + 2, 7), ("m1", d2, T0 + DAY, 10), ("m3", d1, T0 + 9, 5), ("m4", d2, T0 + DAY, 9)]
    versions = spark.read.schema(TABLE).parquet(work["table"])
    assert versions.where("mid = 'm3'").count() == 1 and versions.where("mid = 'm1' AND log_date = '2024-01-01'").count() == 2
    run_dau(spark, work)  # nothing new
    assert spark.read.schema(TABLE).parquet(work["table"]).count() == versions.count()


def test_state_of_a_closed_day_is_evicted(spark, work):
    for n, day in enumerate([0, 0, 3, 5]):
        land(spark, work["src"], f"f{n}", [(f"m{i}", T0 + day * DAY + i, n * 100 + i) for i in range(20)])
    run_dau(spark, work)
    days = {r.key[0].start.strftime("%d") for r in spark.read.format("statestore").load(work["ckpt"]).select("key").collect()}
    assert days == {"06"}  # one day of delay behind the last record
    land(spark, work["src"], "late", [("m1", T0 - 1, 999), ("m1", T0, 998)])  # behind the watermark: the day is closed
    run_dau(spark, work)
    assert ("m1", "2024-01-01", T0 + 1, 1) in table(spark, work) and not [r for r in table(spark, work) if r[3] > 900]


def test_crash_after_the_write_emits_the_same_rows_again(spark, work):
    writer, state = K.dau_state_writer(work["table"]), {"armed": False, "crashed": False}

    def crashing(batch, n):
        writer(batch, n)
        if state["armed"] and not batch.isEmpty():
            state.update(armed=False, crashed=True)
            raise RuntimeError("simulated crash after the write, before the commit")

    def start(fn):
        return K.dau_state(logs(spark, work["src"]), ["ms", "event_id"]).writeStream.outputMode("update").foreachBatch(fn) \
            .option("checkpointLocation", work["ckpt"]).trigger(**NOW).start()
    land(spark, work["src"], "a", [("m1", T0 + 5, 1)])
    start(crashing).awaitTermination(120)
    land(spark, work["src"], "b", [("m1", T0 + 3, 2), ("m2", T0 + 7, 3), ("m1", T0 + 6, 4)])
    state["armed"] = True
    with pytest.raises(Exception, match="simulated"):
        start(crashing).awaitTermination(120)
    assert state["crashed"] and start(writer).awaitTermination(120)
    got = sorted((r.mid, r.ms - T0, r._batch_id > 0) for r in spark.read.schema(TABLE).parquet(work["table"]).collect())
    assert got == [("m1", 3, True), ("m1", 5, False), ("m2", 7, True)]


def test_many_batches_of_one_date_read_no_table(spark, tmp_dir, monkeypatch):
    """However many batches a day has had, a batch reads its own input only: no list or scan of what was written."""
    batches = int(os.environ.get("RP_STATE_BATCHES", "60"))
    src, detail, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "detail", "ckpt"))
    os.makedirs(src)
    for n in range(batches):  # a new device in every batch, and one that is in all of them
        with open(os.path.join(src, f"{n:04d}.json"), "w") as f:
            f.write('{"mid":"hot","ms":%d,"event_id":%d}\n{"mid":"m%d","ms":%d,"event_id":%d}\n' % (T0 + n, n, n, T0 + n, 1000 + n))
        os.utime(os.path.join(src, f"{n:04d}.json"), (1_700_000_000 + n, 1_700_000_000 + n))  # the source takes files by age
    with stream_conf(spark, 1):
        t = F.timestamp_millis("ms")
        s = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).json(src).withColumn("ts_event", t).withColumn("log_date", F.date_format(t, "yyyy-MM-dd"))

        def no_read(*_, **__):
            raise AssertionError("a batch reads a table")
        for name in ("parquet", "load", "table"):
            monkeypatch.setattr(DataFrameReader, name, no_read)
        q = K.start_dau_state_stream(s, detail, ckpt, NOW, ["ms", "event_id"])
        assert q.awaitTermination(600)
        monkeypatch.undo()
        assert q.exception() is None and {p.numInputRows for p in q.recentProgress} <= {0, 2}
    rows = spark.read.schema(TABLE).parquet(detail)
    assert rows.count() == batches + 1 and rows.where("mid = 'hot'").count() == 1
    assert rows.select("_batch_id").distinct().count() == batches


# ---- first days ----

def run_first_seen(spark, work):
    q = K.start_first_seen_stream(spark, logs(spark, work["src"]), work["table"], work["ckpt"], NOW)
    assert q.awaitTermination(300)


def new_by_day(spark, work, days):
    return [K.new_devices_of_day(spark, work["table"], f"2024-01-0{d}").first().new_mid for d in days]


def test_first_days_are_kept_up_with_old_records(spark, work):
    land(spark, work["src"], "a", [("m1", T0 + 2 * DAY, 1), ("m2", T0 + 2 * DAY, 2), ("m1", T0 + 3 * DAY, 3), (None, T0, 4)])
    run_first_seen(spark, work)
    land(spark, work["src"], "b", [("m1", T0 + 2 * DAY + 5, 5), ("m3", T0 + 3 * DAY, 6), ("m2", T0 + 4 * DAY, 7)])
    run_first_seen(spark, work)
    assert new_by_day(spark, work, [1, 2, 3, 4, 5]) == [0, 0, 2, 1, 0]
    land(spark, work["src"], "c", [("m1", T0 + DAY, 8), ("m3", T0, 9)])  # old records: both were there before
    run_first_seen(spark, work)
    assert new_by_day(spark, work, [1, 2, 3, 4]) == [1, 1, 1, 0]
    land(spark, work["src"], "d", [("m1", T0, 10), ("m1", T0 + DAY, 11)])  # and once more
    run_first_seen(spark, work)
    assert new_by_day(spark, work, [1, 2, 3, 4]) == [2, 0, 1, 0]
    want = first_seen_dates(spark.read.parquet(os.path.join(work["src"], "*")).where("mid IS NOT NULL")
                            .withColumn("log_date", F.date_format(F.timestamp_millis("ms"), "yyyy-MM-dd")))
    assert sorted(map(tuple, K.first_seen_table(spark, work["table"]).collect())) == sorted(map(tuple, want.collect()))


def test_replay_of_a_moving_batch(spark, work):
    fn = K.first_seen_writer(spark, work["table"])
    def batch(rows):
        return spark.createDataFrame([(m, (d, f), la, s) for m, d, f, la, s in rows], "mid string, f struct<log_date:string,a:long>, l long, s long").select(
            "mid", F.struct(F.col("f.log_date").alias("log_date"), F.timestamp_seconds("f.a").alias("_arrived")).alias("_first"),
            F.timestamp_seconds("l").alias("_last"), F.timestamp_seconds("s").alias("_since"))
    fn(batch([("m1", "2024-01-03", 1, 1, 1)]), 0)
    moving = batch([("m1", "2024-01-02", 2, 2, 1), ("m2", "2024-01-02", 2, 2, 2)])
    for _ in range(2):  # the batch is run again after a crash
        fn(moving, 1)
    assert new_by_day(spark, work, [2, 3]) == [2, 0]


def test_cards_read_one_folder_of_each_table(spark, work):
    paths = [os.path.join(work["table"], n) for n in ("detail", "seen", "orders")]
    day = "2024-01-02"
    spark.createDataFrame([(1, 1, 1, 1, "00", d, 0) for d in ("2024-01-01", day)], jobs._DAU_STATE_TABLE).write.partitionBy("log_date", "_batch_id").parquet(paths[0])
    spark.createDataFrame([("m1", 1, d, 0) for d in ("2024-01-01", day, "2024-01-03")], K.FIRST_SEEN_TABLE).write.partitionBy("first_date", "_batch_id").parquet(paths[1])
    from retail_pulse.streaming.gmv import order_batch_writer, parsed_orders
    orders = [f'{{"id":"{i}","total_amount":"2.5","create_time":"2024-0{m}-02 09:00:00"}}' for i, m in ((1, 1), (2, 1), (3, 2))]
    order_batch_writer(paths[2])(parsed_orders(spark.createDataFrame([(o,) for o in orders], "value string")), 0)
    cards = jobs.table_cards(spark, *paths, day)
    plan = cards._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("log_date#" in x and day in x for x in filters) and any("first_date#" in x and day in x for x in filters) and any("CREATE_MONTH#" in x for x in filters)
    assert {r.id: r.value for r in cards.collect()} == {"dau": 1.0, "new_mid": 1.0, "order_amount": 5.0}


# ---- windows from panes ----

EVENT = "mid string, uid string, evid string, itemid string, ms long"


def sliding(spark, tmp_dir, rows, duration="5 minutes", slide="1 minute", batches=3):
    src, docs, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "docs", "ckpt"))
    rows = sorted(rows, key=lambda r: r[4])
    cut = [rows[i * len(rows) // batches:(i + 1) * len(rows) // batches] for i in range(batches)] + [[(None, None, "flush", None, rows[-1][4] + 10 * DAY)]]
    with stream_conf(spark, 2):
        for n, part in enumerate(cut):
            spark.createDataFrame(part, EVENT).withColumn("ts", F.timestamp_millis("ms")).drop("ms").coalesce(1).write.parquet(os.path.join(src, f"f{n}"))
            stream = spark.readStream.schema("mid string, uid string, evid string, itemid string, ts timestamp").parquet(os.path.join(src, "*"))
            assert SA.start_alert_stream(spark, stream, docs, ckpt, NOW, duration, slide, "1 minute").awaitTermination(300)
    got = {(r.id, tuple(r.uids), tuple(r.itemIds), tuple(map(tuple, r.events)), r.n_events) for r in SA.alert_index(spark, docs).collect()}
    ev = spark.createDataFrame(rows, EVENT).withColumn("ts", F.timestamp_millis("ms"))
    want = {(r.id, tuple(r.uids), tuple(r.itemIds), tuple(map(tuple, r.events)), r.n_events)
            for r in A.alert_documents(A.coupon_alerts(ev, duration, slide)).collect()}
    return got, want, ckpt


def test_sliding_windows_from_panes_equal_the_batch_form(spark, tmp_dir):
    rows = []
    for i in range(600):  # "hot" has a third of all events
        mid = "hot" if i % 3 == 0 else f"m{i % 7}"
        evid = "coupon" if i % 4 else "view"
        rows.append((mid, f"u{i % 11}" if i % 13 else None, evid, f"i{i % 5}", T0 + i * 7000))
    rows += [("m1", "u1", "clickItem", "i1", T0 + 600_000), ("hot", "u1", "clickItem", "i1", T0 + 2_000_000)]
    got, want, ckpt = sliding(spark, tmp_dir, rows)
    assert got == want and len(want) > 100
    for operator in (0, 1):  # both aggregates keep one number per key
        state = spark.read.format("statestore").option("operatorId", operator).load(ckpt)
        assert [f.dataType for f in state.schema["value"].dataType] == [T.LongType()]
        assert not [f for f in state.schema["key"].dataType if isinstance(f.dataType, (T.ArrayType, T.MapType))]


def test_sale_job_broadcasts_only_what_was_measured(spark, tmp_dir, monkeypatch):
    """The SKU keys are few bytes in their file and many in the driver: no join may be planned as a broadcast before it runs."""
    from retail_pulse.streaming import runner, sales
    joins = lambda df: re.findall(r"\w+Join\w*", df._jdf.queryExecution().executedPlan().toString())
    table, parked, skus, seen = f"{tmp_dir}/sales", f"{tmp_dir}/parked", f"{tmp_dir}/part", []
    write = sales.write_batch_partition
    monkeypatch.setattr(sales, "write_batch_partition", lambda df, path, *args, **kw: seen.append((path, joins(df))) or write(df, path, *args, **kw))
    spark.range(100, 200).selectExpr("id AS p_partkey", "'ring' AS p_name").write.parquet(skus)
    part = spark.read.parquet(skus)
    at = F.timestamp_seconds(F.lit(1704067200)).alias
    batch = spark.range(300).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"), F.lit(1.0).alias("l_quantity"),
                                    F.lit(2.0).alias("l_extendedprice"), at("l_ts"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("o_orderkey"),
                                    F.col("id").alias("o_custkey"), at("o_ts"))
    limits = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    sales.sale_writer(spark, part, table, parked)(batch, 0)
    orders = batch.select(F.col("l_orderkey").alias("o_orderkey"), "o_custkey", F.col("o_ts").alias("ts"))
    sales.recover_parked(spark, orders, part, table, 0, parked)
    assert [path for path, _ in seen] == [table, parked, table, f"{parked}_recovered"]
    for _, kinds in seen[:3]:  # the fourth shows what the third has run
        assert kinds and set(kinds) == {"SortMergeJoin"}
    assert sorted(r.order_id for r in spark.read.parquet(table).collect()) == list(range(100, 200))
    assert sales.open_lines(spark, parked).count() == 200

    small = batch.join(part, F.col("l_partkey") == F.col("p_partkey"))
    with runner.measured_broadcasts(spark):
        assert len(small.collect()) == 100 and joins(small)[0] == "BroadcastHashJoin"  # it was measured to be small
    assert {k: spark.conf.get(k, None) for k in limits} == limits  # the session's own


def test_window_plan_keeps_no_sets_and_counts_an_event_once(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "s"))
    stream = spark.readStream.schema("mid string, uid string, evid string, itemid string, ts timestamp").parquet(os.path.join(tmp_dir, "s"))
    for slide in (None, "1 minute"):
        plan = SA.stage_one(stream, "5 minutes", slide)._jdf.queryExecution().analyzed().toString()
        assert "collect_set" not in plan and "collect_list" not in plan
    lines = plan.splitlines()
    copies = [i for i, x in enumerate(lines) if x.strip(" :+-~").startswith("Expand")]
    sums = [i for i, x in enumerate(lines) if "Aggregate" in x]
    # read from the bottom: pane counts, then the copies into windows, then the sums of the windows
    assert len(sums) == 2 and len(copies) == 1 and sums[0] < copies[0] < sums[1]


# ---- sale rows: users and parked lines ----

def test_user_version_valid_at_the_order_time(spark, tmp_dir):
    from retail_pulse.streaming.sales import USER_COLUMNS, user_version_writer, user_versions, with_user
    schema = "user_id long, valid_from timestamp, user_name string, user_level string, user_gender string, user_age int"
    at = lambda d: F.lit(d).cast("timestamp")
    users = spark.createDataFrame([(1, None, "a", "1", "M", 20), (2, None, "b", "1", "F", 30), (None, None, "x", "1", "F", 3)], schema)
    write = user_version_writer(f"{tmp_dir}/u")
    write(users.withColumn("valid_from", at("2024-01-01 00:00:00")), 0)
    for _ in range(2):  # a replayed batch of changes
        write(users.where("user_id = 1").withColumn("valid_from", at("2024-01-05 00:00:00")).withColumn("user_level", F.lit("2")), 1)
    write(users.where("user_id = 1").withColumn("valid_from", at("2024-01-05 00:00:00")).withColumn("user_level", F.lit("3")), 2)  # corrected
    rows = spark.createDataFrame([(1, "2023-12-31 23:00:00"), (1, "2024-01-01 00:00:00"), (1, "2024-01-04 23:59:59"), (1, "2024-01-05 00:00:00"), (2, "2024-02-01 00:00:00"),
                                  (3, "2024-02-01 00:00:00"), (None, "2024-02-01 00:00:00"), (2, None), (1, "2024-01-05 00:00:00")], "user_id long, t string")
    got = with_user(rows.withColumn("order_ts", F.col("t").cast("timestamp")), user_versions(spark, f"{tmp_dir}/u"))
    assert got.columns == ["user_id", "t", "order_ts", *USER_COLUMNS]
    level = sorted(((r.user_id or 0, r.t or "", r.user_level) for r in got.collect()), key=repr)
    assert level == sorted([(1, "2023-12-31 23:00:00", None), (1, "2024-01-01 00:00:00", "1"), (1, "2024-01-04 23:59:59", "1"), (1, "2024-01-05 00:00:00", "3"),
                            (1, "2024-01-05 00:00:00", "3"), (2, "2024-02-01 00:00:00", "1"), (3, "2024-02-01 00:00:00", None), (0, "2024-02-01 00:00:00", None), (2, "", None)], key=repr)


def test_parked_lines_come_back_once(spark, tmp_dir):
    from retail_pulse.streaming.sales import open_lines, parked_beside, recover_parked, sale_writer
    table = f"{tmp_dir}/sales"
    ts = F.timestamp_millis("ms")
    batch = spark.createDataFrame([(1, 1, 100, 1.0, 5.0, T0, 1, 10, T0), (2, 1, 100, 1.0, 6.0, T0, None, None, None), (3, 1, 101, 1.0, 7.0, T0, 3, 30, T0),
                                   (3, 1, 100, 2.0, 9.0, T0, 3, 30, T0), (2, 1, 101, 1.0, 3.0, T0, None, None, None),  # a line number twice in an order
                                   (4, 2, 999, 1.0, 8.0, T0, None, None, None)],
                                  "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, ms long, o_orderkey long, o_custkey long, o long") \
        .withColumn("l_ts", ts).withColumn("o_ts", F.timestamp_millis("o"))
    part = spark.createDataFrame([(100, "ring")], "p_partkey long, p_name string")
    sale_writer(spark, part, table, parked_beside(table))(batch, 0)

    def sales():
        return sorted((r.order_id, r.line_no, r.user_id, r.sku_name, r.sku_price, r.dt) for r in spark.read.parquet(table).collect())
    assert sales() == [(1, 1, 10, "ring", 5.0, "2024-01-01"), (3, 1, 30, "ring", 9.0, "2024-01-01")]
    assert sorted((r.order_id, r.reason) for r in open_lines(spark, parked_beside(table)).collect()) == [(2, "no_order"), (2, "no_order"), (3, "no_sku"), (4, "no_order")]
    orders = spark.createDataFrame([(1, 10, T0), (2, 20, T0), (3, 30, T0)], "o_orderkey long, o_custkey long, ms long").withColumn("ts", ts)
    recover_parked(spark, orders, part, table, 0)  # order 2 has come
    parts = part.union(spark.createDataFrame([(101, "bolt")], part.schema))
    for n in (1, 1, 2):  # SKU 101 has come; the round is run again, then another one finds nothing
        recover_parked(spark, orders, parts, table, n)
    assert sales() == [(1, 1, 10, "ring", 5.0, "2024-01-01"), (2, 1, 20, "bolt", 3.0, "2024-01-01"), (2, 1, 20, "ring", 6.0, "2024-01-01"),
                       (3, 1, 30, "bolt", 7.0, "2024-01-01"), (3, 1, 30, "ring", 9.0, "2024-01-01")]
    assert [r.order_id for r in open_lines(spark, parked_beside(table)).collect()] == [4]
