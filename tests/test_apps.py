"""The streaming applications end to end on JSON-lines / change-feed files (availableNow)."""

import json
import os

from retail_pulse.schemas import CHANGE_EVENT
from retail_pulse.streaming.apps import start_app

AVAILABLE_NOW = {"availableNow": True}
T0 = 1704067200000  # 2024-01-01 00:00:00 UTC


def _lines(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def test_cdc_then_orders_app(spark, tmp_dir):
    feed, msgs, work = (os.path.join(tmp_dir, p) for p in ("feed", "msgs", "work"))

    def row(**kv):
        return [{"name": k, "value": v} for k, v in kv.items()]
    spark.createDataFrame([
        (None, "gmall", "order_info", "ROWDATA", "INSERT",
         [row(id="1", total_amount="10.5", create_time="2024-01-01 09:05:06", consignee_tel="13812345678")]),
        (None, "gmall", "order_info", "ROWDATA", "UPDATE", [row(id="1", total_amount="99")]),
        (None, "gmall", "user_info", "ROWDATA", "INSERT", [row(id="7")]),
        (None, "archive", "order_info", "ROWDATA", "INSERT", [row(id="8", total_amount="1", create_time="2024-01-01 09:05:06")]),
    ], CHANGE_EVENT).write.parquet(feed)
    assert start_app(spark, "cdc", "files", feed, work, AVAILABLE_NOW, out=msgs).awaitTermination(120)
    assert start_app(spark, "orders", "files", msgs, work, AVAILABLE_NOW).awaitTermination(120)
    rows = spark.read.parquet(os.path.join(work, "order_info")).collect()
    assert [(r.ID, r.TOTAL_AMOUNT, r.CONSIGNEE_TEL, r.CREATE_DATE) for r in rows] == \
        [("1", 10.5, "138****5678", "2024-01-01")]


def test_dau_app(spark, tmp_dir):
    src, work = os.path.join(tmp_dir, "startup"), os.path.join(tmp_dir, "work")
    _lines(src, "a.json", [{"mid": "m1", "uid": "u1", "ts": T0 + 5000}, {"mid": "m1", "uid": "u1", "ts": T0 + 1000},
                           {"mid": "m2", "uid": "u2", "ts": T0 + 86_400_000}])
    with open(os.path.join(src, "a.json"), "a") as f:
        f.write("bad{\n")  # dropped by the parser, the batch goes on
    from retail_pulse.streaming.runner import BatchCounts
    lines = []
    counts = BatchCounts(printer=lines.append)
    assert start_app(spark, "dau", "files", src, work, AVAILABLE_NOW, counts=counts).awaitTermination(120)
    assert lines == ["batch 0: raw=3, in_batch=2, new=2"]
    got = sorted((r.mid, r.log_date, r.ts) for r in spark.read.parquet(os.path.join(work, "dau_detail")).collect())
    assert [(m, str(d), t) for m, d, t in got] == [("m1", "2024-01-01", T0 + 1000), ("m2", "2024-01-02", T0 + 86_400_000)]


def test_dau_app_on_keyed_state_beside_first_seen(spark, tmp_dir):
    from retail_pulse.streaming.keyed import dau_state_table, new_devices_of_day
    src, work = os.path.join(tmp_dir, "startup"), os.path.join(tmp_dir, "work")
    schema = "mid string, ts long, log_date string, _batch_id long"

    def run():
        queries = [start_app(spark, "dau", "files", src, work, AVAILABLE_NOW, keyed_state=True), start_app(spark, "first_seen", "files", src, work, AVAILABLE_NOW)]
        for q in [*queries, *spark.streams.active]:
            assert q.awaitTermination(180)
        return (sorted((r.mid, r.log_date, r.ts) for r in dau_state_table(spark, os.path.join(work, "dau_detail"), schema).collect()),
                [new_devices_of_day(spark, os.path.join(work, "first_seen"), d).first().new_mid for d in ("2024-01-01", "2024-01-02")])
    _lines(src, "a.json", [{"mid": "m1", "uid": "u1", "ts": T0 + 5000}, {"mid": "m1", "uid": "u1", "ts": T0 + 1000}, {"mid": "m2", "ts": T0 + 86_400_000}, {"ts": T0}])
    assert run() == ([("m1", "2024-01-01", T0 + 1000), ("m2", "2024-01-02", T0 + 86_400_000)], [1, 1])
    _lines(src, "b.json", [{"mid": "m1", "uid": "u1", "ts": T0 + 500}, {"mid": "m2", "ts": T0 + 86_399_000}, {"mid": "m1", "ts": T0 + 86_400_000}])
    assert run() == ([("m1", "2024-01-01", T0 + 500), ("m1", "2024-01-02", T0 + 86_400_000), ("m2", "2024-01-01", T0 + 86_399_000),
                      ("m2", "2024-01-02", T0 + 86_400_000)], [2, 0])
    bad = spark.read.parquet(os.path.join(work, "startup_quarantine")).collect()
    assert [r._reject_reason for r in bad] == ["missing_mid"]


def test_alert_app(spark, tmp_dir):
    src, work = os.path.join(tmp_dir, "events"), os.path.join(tmp_dir, "work")
    coupons = [{"mid": "m1", "uid": f"u{i}", "evid": "coupon", "itemid": "i1", "ts": T0 + i * 1000} for i in range(3)]
    later = [{"mid": "m9", "uid": "u1", "evid": "view", "ts": T0 + 3_600_000}]  # moves the watermark on
    _lines(src, "a.json", coupons + later)
    assert start_app(spark, "alert", "files", src, work, AVAILABLE_NOW).awaitTermination(180)
    from retail_pulse.schemas import ALERT_INDEX_SUFFIX, ES_ALERT_INDEX
    from retail_pulse.sources.sinks import index_name
    from retail_pulse.streaming.alert import alert_index
    docs = alert_index(spark, os.path.join(work, index_name(ES_ALERT_INDEX, ALERT_INDEX_SUFFIX))).collect()
    # 5-minute windows sliding by 1 minute: the three coupons fall in 5 windows -> 5 documents
    assert len(docs) == 5 and all(d.mid == "m1" and d.uids == ["u0", "u1", "u2"] for d in docs)


def test_command_line(spark, tmp_dir):
    from retail_pulse.streaming.apps import main
    src, work = os.path.join(tmp_dir, "startup"), os.path.join(tmp_dir, "work")
    _lines(src, "a.json", [{"mid": "m1", "uid": "u1", "ts": T0}])
    _lines(src, "b.json", [{"mid": "m2", "uid": "u2", "ts": T0 + 1000}])
    main(["dau", "--location", src, "--work", work, "--available-now", "--max-per-trigger", "1"])
    t = spark.read.parquet(os.path.join(work, "dau_detail"))
    assert t.count() == 2 and t.select("_batch_id").distinct().count() == 2  # one file per micro-batch
