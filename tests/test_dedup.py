import random

from hypothesis import given, settings
from hypothesis import strategies as st

from retail_pulse.operators.dedup import dedup_device_day, drop_seen, new_devices_count

SCHEMA = "mid string, log_date string, ts bigint, event_id bigint"


def test_in_batch_duplicate_keeps_min_ts(spark):
    df = spark.createDataFrame([("m1", "d", 5, 1), ("m1", "d", 3, 2)], SCHEMA)
    assert [r.ts for r in dedup_device_day(df).collect()] == [3]


def test_same_device_two_days_both_kept(spark):
    df = spark.createDataFrame([("m1", "d1", 5, 1), ("m1", "d2", 3, 2)], SCHEMA)
    assert sorted(r.log_date for r in dedup_device_day(df).collect()) == ["d1", "d2"]


def test_equal_ts_tie_break_is_deterministic(spark):
    rows = [("m1", "d", 5, 9), ("m1", "d", 5, 4), ("m1", "d", 5, 7)]
    for _ in range(3):
        random.shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        assert [r.event_id for r in dedup_device_day(df).collect()] == [4]


def test_late_previous_day_is_dropped(spark):
    seen = spark.createDataFrame([("m1", "d1")], "mid string, log_date string")
    batch = spark.createDataFrame([("m1", "d1", 10, 1), ("m2", "d1", 10, 2)], SCHEMA)
    assert [r.mid for r in drop_seen(batch, seen).collect()] == ["m2"]


def test_new_devices(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-01-02"), ("c", "2024-01-03")],
                               "mid string, log_date string")
    assert new_devices_count(df, "2024-01-02").first().new_mid == 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["m1", "m2", "m3"]), st.sampled_from(["d1", "d2"]),
                          st.integers(0, 5)), min_size=1, max_size=20), st.randoms())
def test_dedup_is_order_independent(spark, rows, rnd):
    data = [(m, d, ts, i) for i, (m, d, ts) in enumerate(rows)]
    expect = {}
    for m, d, ts, i in data:
        k = (m, d)
        if k not in expect or (ts, i) < expect[k]:
            expect[k] = (ts, i)
    shuffled = list(data)
    rnd.shuffle(shuffled)
    got = {(r.mid, r.log_date): (r.ts, r.event_id) for r in
           dedup_device_day(spark.createDataFrame(shuffled, SCHEMA).repartition(2)).collect()}
    assert got == expect
