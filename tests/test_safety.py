"""The streaming tables under replays, broken messages and repeated deliveries."""

import json

import pytest
from pyspark.sql import functions as F

from retail_pulse.functions.time import create_time_ok, current_day, ms_to_timestamp, previous_day
from retail_pulse.operators import alert as A
from retail_pulse.operators.dashboard import hour_maps_json
from retail_pulse.operators.dedup import extend_first_seen, first_seen_dates
from retail_pulse.sources import readers, sinks
from retail_pulse.streaming.dau import dau_batch_writer, startup_parsed
from retail_pulse.streaming.gmv import order_batch_writer, order_table, parsed_orders

DETAIL = "mid string, ts long, log_date string, _batch_id long"
DOC = "id string, name string"


def _batch(spark, rows):
    return spark.createDataFrame(rows, "mid string, ts long, log_date string")


def test_replay_after_compaction_keeps_all_rows(spark, tmp_dir):
    live, compact = f"{tmp_dir}/live", f"{tmp_dir}/compact"
    batches = [[("a", 1, "2024-01-01"), ("b", 2, "2024-01-01")], [("c", 3, "2024-01-01"), ("a", 4, "2024-01-01")]]
    write = dau_batch_writer(spark, live, ["ts"])
    for n, rows in enumerate(batches):
        write(_batch(spark, rows), n)
    sinks.compact_batches(spark, live, compact, ["log_date"], schema=spark.createDataFrame([], DETAIL).schema)
    again = dau_batch_writer(spark, compact, ["ts"])
    again(_batch(spark, batches[1]), 1)  # the last batch is replayed after the restart
    again(_batch(spark, [("d", 5, "2024-01-01"), ("b", 6, "2024-01-01")]), 2)
    assert sorted(r.mid for r in spark.read.schema(DETAIL).parquet(compact).collect()) == ["a", "b", "c", "d"]


def test_document_replay_after_compaction(spark, tmp_dir):
    live, compact = f"{tmp_dir}/live", f"{tmp_dir}/compact"
    docs = [spark.createDataFrame([("1", "a"), ("2", "b")], DOC), spark.createDataFrame([("2", "b2")], DOC)]
    for n, d in enumerate(docs):
        sinks.upsert_documents(d, live, n)
    sinks.compact_documents(spark, live, compact)
    sinks.upsert_documents(docs[1], compact, 1)
    assert {r.id: r.name for r in sinks.latest_documents(spark.read.parquet(compact)).collect()} == {"1": "a", "2": "b2"}


def test_equal_documents_without_id_stay_apart_and_replays_do_not_double(spark, tmp_dir):
    path = f"{tmp_dir}/docs"
    df = spark.createDataFrame([(None, "x"), (None, "x"), (None, None), ("7", "x")], DOC)
    for n in (0, 1, 1):
        sinks.upsert_documents(df, path, n)
    assert sinks.latest_documents(spark.read.parquet(path)).count() == 7  # 3 nameless in each batch, and one keyed


def test_broken_startup_messages_go_to_the_quarantine(spark, tmp_dir):
    detail, bad = f"{tmp_dir}/detail", f"{tmp_dir}/bad"
    t = 1704067200000
    messages = [json.dumps(m) for m in ({"mid": "a", "ts": t}, {"mid": None, "ts": t}, {"mid": "b"}, {"mid": "c", "ts": "x"},
                                        {"mid": "d", "ts": 2**63 - 1}, {"mid": "e", "ts": -5})] + ["{", "null"]
    batch = startup_parsed(spark.createDataFrame([(m,) for m in messages], "value string"))
    write = dau_batch_writer(spark, detail, ["ts"], quarantine_path=bad)
    for _ in range(2):  # a replay
        write(batch, 0)
    assert [(r.mid, r.log_date) for r in spark.read.parquet(detail).select("mid", F.col("log_date").cast("string")).collect()] == [("a", "2024-01-01")]
    assert sorted(r._reject_reason for r in spark.read.parquet(bad).collect()) == \
        ["bad_number", "bad_time", "bad_time", "malformed_json", "malformed_json", "missing_mid", "missing_ts"]


def test_rows_without_key_do_not_stop_a_typed_batch_or_repeat(spark, tmp_dir):
    detail, bad = f"{tmp_dir}/detail", f"{tmp_dir}/bad"
    write = dau_batch_writer(spark, detail, ["ts"], quarantine_path=bad)
    for n in range(2):
        write(_batch(spark, [("a", 1, "2024-01-01"), (None, 1, "2024-01-01"), ("b", 1, None)]), n)
    assert spark.read.schema(DETAIL).parquet(detail).count() == 1
    assert spark.read.parquet(bad).groupBy("_reject_reason").count().collect()[0]["count"] == 4


def test_orders_delivered_twice_count_once(spark, tmp_dir):
    table, bad = f"{tmp_dir}/orders", f"{tmp_dir}/bad"
    good = {"id": "1", "total_amount": "12.5", "create_time": "2024-01-01 09:05:06"}
    messages = [good, good, {"id": "2", "total_amount": "1", "create_time": "2024-01-01T09:05:06"}, {"id": "3", "total_amount": "1"},
                {"total_amount": "1", "create_time": "2024-01-01 09:05:06"}]
    batch = parsed_orders(spark.createDataFrame([(json.dumps(m),) for m in messages], "value string"))
    write = order_batch_writer(table, bad)
    write(batch, 0)
    write(batch.where("id = '1'"), 1)
    assert order_table(spark, table, keyed=False).count() == 4
    assert order_table(spark, table, ["2024-01-01"]).agg(F.sum("TOTAL_AMOUNT")).first()[0] == 12.5
    assert sorted(r._reject_reason for r in spark.read.parquet(bad).collect()) == ["bad_time", "bad_time", "missing_id"]


def test_failed_order_write_releases_the_batch(spark, tmp_dir, monkeypatch):
    from retail_pulse.streaming import gmv

    def fail(*a, **k):
        raise OSError("disk")
    monkeypatch.setattr(gmv, "write_batch_partition", fail)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    with pytest.raises(OSError):
        order_batch_writer(f"{tmp_dir}/t")(parsed_orders(spark.createDataFrame([("{}",)], "value string")), 0)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_times_out_of_range_and_of_other_shapes(spark):
    df = spark.createDataFrame([(2**63 - 1, "2024-01-01T09:05:06"), (-1, "2024-01-01 09:05:06"), (0, None), (None, "x")], "ts long, c string")
    got = df.select(ms_to_timestamp("ts").isNull().alias("none"), create_time_ok("c").alias("ok")).collect()
    assert [(r.none, r.ok) for r in got] == [(True, False), (True, True), (False, None), (True, False)]
    assert previous_day("2024-03-01") == "2024-02-29" and len(current_day()) == 10


def test_hour_with_a_sum_of_zero_stays_in_the_json(spark):
    df = spark.createDataFrame([("08", 0.0, None), ("09", 1.5, 2.0)], "hour string, today double, yesterday double")
    assert json.loads(hour_maps_json(df, zero_is_missing=False).first().json) == {"today": {"08": 0.0, "09": 1.5}, "yesterday": {"09": 2.0}}


def test_counts_are_whole_numbers_in_the_card_json(spark):
    from retail_pulse.operators.dashboard import metric_cards, metric_cards_json
    whole, amount = spark.sql("SELECT 16L AS a"), spark.sql("SELECT 2.5D AS a")
    assert [c["value"] for c in json.loads(metric_cards_json(metric_cards(whole, whole, amount, keep_order=True)).first().json)] == [16, 16, 2.5]
    assert '"value":16}' in metric_cards_json(metric_cards(whole, whole, amount, keep_order=True)).first().json


def test_hot_device_with_a_third_of_the_rows(spark):
    rows = [("hot", f"u{i}", "coupon" if i % 2 else "view", None, i) for i in range(3000)] + [("hot", "u1", "clickItem", None, 5)]
    rows += [(f"m{i % 700}", f"u{i % 5}", "coupon", f"i{i % 3}", i) for i in range(6000)]
    rows += [(None, f"u{i}", "coupon", None, 1) for i in range(4)]
    df = spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, s long").withColumn("ts", F.timestamp_seconds(F.col("s") % 600))
    def text(d):
        return sorted(map(str, d.select("window", "mid", "uids", "itemIds", "events_hist", "n_events").collect()))
    fast, plain = A.coupon_alerts(df, "5 minutes", "1 minute"), A.alert_rule(A.coupon_profiles(df, "5 minutes", "1 minute"))
    assert text(fast) == text(plain) and len(text(fast)) > 10


def test_first_seen_table_extended_by_a_batch(spark):
    logs = spark.createDataFrame([("a", "2024-01-02"), ("b", "2024-01-05")], "mid string, log_date string")
    more = spark.createDataFrame([("a", "2024-01-03"), ("b", "2024-01-04"), ("c", "2024-01-04")], "mid string, log_date string")
    got = extend_first_seen(first_seen_dates(logs), more).collect()
    assert {r.mid: r.first_date for r in got} == {"a": "2024-01-02", "b": "2024-01-04", "c": "2024-01-04"}


def test_connector_options_without_a_server():
    o = readers.kafka_options("h:9092", "T", max_offsets_per_trigger=5)
    assert o["failOnDataLoss"] == "true" and o["subscribe"] == "T" and o["maxOffsetsPerTrigger"] == "5"
    assert readers.kafka_options("h:9092", "T", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    o = readers.jdbc_options("jdbc:x://h/db", "t", user="u", password="p", partition_column="id", lower=1, upper=9, num_partitions=3, driver="d.D")
    assert o == {"url": "jdbc:x://h/db", "dbtable": "t", "user": "u", "password": "p", "driver": "d.D", "partitionColumn": "id",
                 "lowerBound": "1", "upperBound": "9", "numPartitions": "3"}
    assert readers.jdbc_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t"}
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")


def test_keyset_pages_walk_through_all_rows(spark):
    from retail_pulse.operators.sales import detail_page_after
    df = spark.createDataFrame([(i // 3, i % 3, f"n{i}") for i in range(10)], "a int, b int, n string")
    after, seen = None, []
    while rows := detail_page_after(df, F.lit(True), ["a", "b"], after, 4).collect():
        seen += [r.n for r in rows]
        after = (rows[-1].a, rows[-1].b)
    assert seen == [f"n{i}" for i in range(10)]


class _Session:
    """A session that answers the settings only."""

    def __init__(self, conf, master):
        self.conf = self
        self._conf, self.master, self.sparkContext = conf, master, self

    def get(self, key, default=None):
        return self._conf.get(key, default)

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return None


def test_work_folder_keeps_its_scheme_and_is_never_local_on_a_cluster():
    from retail_pulse.session import shared_dir
    for root in ("file:///shared", "hdfs://nn/shared/", "/shared"):
        assert shared_dir(_Session({"spark.checkpoint.dir": root}, "yarn"), "x").startswith(f"{root.rstrip('/')}/retail_pulse/x-")
    with pytest.raises(ValueError):
        shared_dir(_Session({}, "yarn"), "x")
