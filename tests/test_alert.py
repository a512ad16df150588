
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_pulse.operators import alert as A

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC


def events(spark, rows):
    """rows: (mid, uid, evid, itemid, seconds after T0)"""
    df = spark.createDataFrame([(m, u, e, i, T0 + s * 1000) for m, u, e, i, s in rows],
                               "mid string, uid string, evid string, itemid string, ms bigint")
    return df.withColumn("ts", F.timestamp_millis("ms")).drop("ms")


def alerts(spark, rows, duration="5 minutes"):
    return A.alert_documents(A.coupon_alerts(events(spark, rows), duration), expand=True).collect()


def test_alert_hit(spark):
    rows = [("m1", "u1", "coupon", "i1", 1), ("m1", "u2", "coupon", "i2", 2), ("m1", "u3", "coupon", "i1", 3),
            ("m1", "u1", "addCart", "i9", 4)]
    (doc,) = alerts(spark, rows)
    assert doc.uids == ["u1", "u2", "u3"]
    assert doc.itemIds == ["i1", "i2"]
    assert sorted(doc.events) == ["addCart", "coupon", "coupon", "coupon"]
    assert len(doc.events) == 4


def test_document_has_the_alert_record_fields(spark):
    from retail_pulse.schemas import COUPON_ALERT
    rows = [("m1", f"u{i}", "coupon", "i1", i) for i in range(3)]
    doc = A.alert_documents(A.coupon_alerts(events(spark, rows), "5 minutes"), expand=True)
    assert set(COUPON_ALERT.fieldNames()) <= set(doc.columns)
    assert {f.name: f.dataType for f in doc.schema.fields if f.name in COUPON_ALERT.fieldNames()} == \
        {f.name: f.dataType for f in COUPON_ALERT.fields}


def test_same_uid_three_times_no_alert(spark):
    rows = [("m1", "u1", "coupon", "i1", s) for s in (1, 2, 3)]
    assert alerts(spark, rows) == []


def test_click_anywhere_suppresses(spark):
    base = [("m1", f"u{i}", "coupon", "i1", 10 + i) for i in range(3)]
    assert alerts(spark, [("m1", "u1", "clickItem", "i1", 1)] + base) == []
    assert alerts(spark, base + [("m1", "u1", "clickItem", "i1", 50)]) == []


def test_null_uid_not_counted(spark):
    rows = [("m1", "a", "coupon", "i1", 1), ("m1", "b", "coupon", "i1", 2), ("m1", None, "coupon", "i1", 3)]
    assert alerts(spark, rows) == []


def test_alert_id_is_mid_plus_minute_of_window_end(spark):
    rows = [("m1", f"u{i}", "coupon", "i1", 10 + i) for i in range(3)]
    (doc,) = alerts(spark, rows, duration="1 minute")
    assert doc.ts == 1704067260000
    assert doc.id == "m128401121"


def test_events_histogram_is_exact(spark):
    rows = [("m1", "u1", "coupon", "i1", 1)] * 2 + [("m1", "u2", "view", None, 2)] * 3
    prof = A.coupon_profiles(events(spark, rows), "5 minutes").first()
    assert [(e.evid, e.n) for e in prof.events_hist] == [("coupon", 2), ("view", 3)]
    assert prof.n_events == 5


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["m1", "m2"]), st.sampled_from(["u1", "u2", "u3", "u4"]),
                          st.sampled_from(["coupon", "coupon", "view", "clickItem"]), st.integers(0, 299)),
                min_size=1, max_size=25), st.randoms())
def test_alerts_order_independent_and_click_only_removes(spark, rows, rnd):
    data = [(m, u, e, "i", s) for m, u, e, s in rows]
    base = {(d.id, tuple(d.uids)) for d in alerts(spark, data)}
    shuffled = list(data)
    rnd.shuffle(shuffled)
    assert {(d.id, tuple(d.uids)) for d in alerts(spark, shuffled)} == base
    with_click = {d.id for d in alerts(spark, data + [("m1", "u1", "clickItem", "i", 5)])}
    assert with_click <= {i for i, _ in base}
