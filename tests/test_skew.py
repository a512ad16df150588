"""One key holding a third of all rows: results must equal brute force, nothing dropped."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from retail_pulse.operators import alert as A
from retail_pulse.operators.dedup import dedup_device_day
from retail_pulse.sources.tables import balanced

T0 = 1704067200000


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        mid = "hot" if i % 3 == 0 else f"m{rnd.randrange(200)}"
        day = rnd.randrange(3)
        evid = rnd.choice(["coupon", "view", "addCart"]) if mid == "hot" else rnd.choice(["coupon", "clickItem", "view"])
        out.append((mid, f"u{rnd.randrange(50)}", evid, None, T0 + day * 86_400_000 + rnd.randrange(86_400_000), i))
    return out


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, ms bigint, event_id long")
    return df.withColumn("ts", F.timestamp_millis("ms")).repartition(8)


def test_dedup_with_hot_device(spark):
    rows = _rows()
    df = _frame(spark, rows).withColumn("log_date", F.date_format("ts", "yyyy-MM-dd"))
    got = {(r.mid, r.log_date): r.event_id for r in dedup_device_day(df, order_cols=["ms", "event_id"]).collect()}
    best = {}
    for mid, _u, _e, _i, ms, eid in rows:
        k = (mid, str((T0 + (ms - T0) // 86_400_000 * 86_400_000) // 86_400_000))
        if k not in best or (ms, eid) < best[k][0]:
            best[k] = ((ms, eid), eid)
    assert len(got) == len(best)
    assert sorted(got.values()) == sorted(v[1] for v in best.values())


def test_alert_profile_with_hot_device(spark):
    rows = _rows()
    prof = {(r.window.start.day, r.mid): r for r in A.coupon_profiles(_frame(spark, rows), "1 day").collect()}
    events, users = defaultdict(Counter), defaultdict(set)
    for mid, uid, evid, _i, ms, _e in rows:
        k = ((ms - T0) // 86_400_000 + 1, mid)
        events[k][evid] += 1
        if evid == "coupon":
            users[k].add(uid)
    assert set(prof) == set(events)
    for k, r in prof.items():
        assert dict((e.evid, e.n) for e in r.events_hist) == dict(events[k])
        assert r.n_events == sum(events[k].values())
        assert r.uids == sorted(users[k])
        assert r.clicked == ("clickItem" in events[k])
    hot_alerts = A.alert_rule(A.coupon_profiles(_frame(spark, rows), "1 day")).where("mid = 'hot'").count()
    assert hot_alerts == 3  # one per day: many coupon users, never a click


def test_balanced_only_marks_the_plan(spark):
    from retail_pulse.operators import search
    narrow = spark.range(100).coalesce(1)
    assert balanced(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("balanced-probe", "")
    docs = spark.range(50).selectExpr("cast(id as string) AS doc_id", "'the ' || id AS text", "'en' AS lang").repartition(3, "doc_id")
    search.total_hits(docs, search.BoolQuery("text", "the", {"lang": "en"}))
    jobs = tracker.getJobIdsForGroup("balanced-probe")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []  # building the query runs nothing
