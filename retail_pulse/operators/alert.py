"""Coupon-abuse alert: per device and time window, many coupon users and no item click.

Profile per (window, mid):

* ``uids``    distinct users with a coupon event (NULL uids are ignored),
* ``itemIds`` distinct items of those coupon events,
* ``events``  every event type seen in the window, with multiplicity,
* ``clicked`` any click event.

The reference builds the profile by materialising each device's whole event
list. Here nothing per-row is collected: stage 1 aggregates per
``(window, mid, evid)`` (partial aggregation before the shuffle, so a hot
device ships one partial row per event type and map task), stage 2 folds the
few event-type rows of a device into the profile. ``events`` is therefore
kept as an exact histogram ``[(evid, n)]`` sorted by evid; the sorted list
with duplicates is ``flatten(transform(..., array_repeat))`` of it and can be
expanded at the edge. ``uids`` / ``itemIds`` are sets of distinct values,
merged from partial sets, never from rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_pulse.functions.time import minute_of, to_millis

# Event names and threshold of the alert rule.
COUPON_EVENT = "coupon"
CLICK_EVENT = "clickItem"
MIN_COUPON_USERS = 3


def with_window(events: DataFrame, ts: str, duration: str, slide: str | None = None) -> DataFrame:
    """Add ``window`` (struct start/end) for tumbling or sliding windows."""
    w = F.window(F.col(ts), duration, slide) if slide else F.window(F.col(ts), duration)
    return events.withColumn("window", w)


def coupon_profiles(events: DataFrame, duration: str = "5 minutes", slide: str | None = None,
                    mid: str = "mid", uid: str = "uid", evid: str = "evid", item: str = "itemid",
                    ts: str = "ts", coupon: str = COUPON_EVENT, click: str = CLICK_EVENT,
                    windowed: bool = False) -> DataFrame:
    """(window, mid, uids, itemIds, events_hist, n_events, clicked) per device-window.

    ``windowed=True`` means ``events`` already carries a ``window`` column
    (e.g. a streaming frame that set its watermark on it).
    """
    w = events if windowed else with_window(events, ts, duration, slide)
    is_coupon = F.col(evid) == F.lit(coupon)
    per_type = w.groupBy("window", F.col(mid).alias("mid"), F.col(evid).alias("evid")).agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.when(is_coupon, F.col(uid))).alias("_uids"),
        F.collect_set(F.when(is_coupon, F.col(item))).alias("_items"),
    )
    return fold_profiles(per_type, coupon, click)


def fold_profiles(per_type: DataFrame, coupon: str = COUPON_EVENT, click: str = CLICK_EVENT) -> DataFrame:
    """Stage 2: (window, mid, evid, n, _uids, _items) rows -> one profile per (window, mid)."""
    is_coupon = F.col("evid") == F.lit(coupon)
    empty = F.array().cast("array<string>")
    return per_type.groupBy("window", "mid").agg(
        F.array_sort(F.flatten(F.collect_list(F.when(is_coupon, F.col("_uids").cast("array<string>"))
                                              .otherwise(empty)))).alias("uids"),
        F.array_sort(F.flatten(F.collect_list(F.when(is_coupon, F.col("_items").cast("array<string>"))
                                              .otherwise(empty)))).alias("itemIds"),
        F.array_sort(F.collect_list(F.struct(F.col("evid"), F.col("n").cast("bigint").alias("n"))))
        .alias("events_hist"),
        F.sum("n").cast("bigint").alias("n_events"),
        F.max(F.col("evid") == F.lit(click)).alias("clicked"),
    )


def alert_rule(profiles: DataFrame, min_users: int = MIN_COUPON_USERS) -> DataFrame:
    """Keep profiles with >= ``min_users`` distinct coupon users and no click."""
    return profiles.where((F.size("uids") >= F.lit(min_users)) & ~F.col("clicked"))


def hist_text(hist: Column) -> Column:
    """``[(evid, n)]`` histogram -> ``"evid:n,evid:n"`` (sorted by evid)."""
    return F.array_join(F.transform(hist, lambda e: F.concat(e["evid"], F.lit(":"), e["n"].cast("string"))), ",")


def expand_events(hist: Column) -> Column:
    """``[(evid, n)]`` histogram -> sorted event list with duplicates.

    Only for the edge (exporting to a consumer that wants the flat list): the
    result has one element per event, so it is as large as the device's
    event count in the window. Stored documents keep the histogram.
    """
    return F.flatten(F.transform(hist, lambda e: F.array_repeat(e["evid"], e["n"].cast("int"))))


def alert_documents(alerts: DataFrame, expand: bool = False) -> DataFrame:
    """Alert documents keyed by ``id = mid || minute(window end)``.

    ``ts`` is the window end in epoch ms (event time; the reference stamps
    processing time). ``events`` is the exact histogram ``[(evid, n)]``
    (bounded by the number of event types); ``expand`` turns it into the
    flat list of the original record shape (see :func:`expand_events`).
    """
    end_ms = to_millis(F.col("window.end"))
    doc_id = F.concat(F.col("mid").cast("string"), minute_of(end_ms).cast("string"))
    events = expand_events(F.col("events_hist")) if expand else F.col("events_hist")
    return alerts.select(
        doc_id.alias("id"),
        F.col("mid").cast("string").alias("mid"),
        F.col("uids"), F.col("itemIds"), events.alias("events"), F.col("n_events"),
        end_ms.alias("ts"),
    )


def alerting_windows(per_type: DataFrame, min_users: int = MIN_COUPON_USERS, coupon: str = COUPON_EVENT,
                     click: str = CLICK_EVENT) -> DataFrame:
    """The rule before any list: (window, mid) with enough distinct coupon users and no click.

    ``per_type`` has one row per (window, mid, evid, uid, item) with the number of events ``n``.
    Users are counted by two aggregates, so no set of users is ever built for a device that does not alert.
    """
    users = per_type.where((F.col("evid") == F.lit(coupon)) & F.col("uid").isNotNull()).select("window", "mid", "uid").distinct() \
        .groupBy("window", "mid").agg(F.count(F.lit(1)).alias("n_users")).where(F.col("n_users") >= F.lit(min_users))
    clicked = per_type.where(F.col("evid") == F.lit(click)).select("window", "mid").distinct()
    same = lambda a, b: a["window"].eqNullSafe(b["window"]) & a["mid"].eqNullSafe(b["mid"])
    return users.join(clicked, same(users, clicked), "left_anti").select("window", "mid")


def coupon_alerts(events: DataFrame, duration: str = "5 minutes", slide: str | None = None,
                  min_users: int = MIN_COUPON_USERS, mid: str = "mid", uid: str = "uid", evid: str = "evid",
                  item: str = "itemid", ts: str = "ts", coupon: str = COUPON_EVENT, click: str = CLICK_EVENT) -> DataFrame:
    """Alerting profiles (batch form): the rule first, then the lists of the device-windows that alert.

    Same rows as ``alert_rule(coupon_profiles(...))``. Users and items are kept only for coupon events, so the
    pre-aggregate has one row per event type and coupon user and item, whatever the number of events.
    """
    is_coupon = F.col(evid) == F.lit(coupon)
    rows = with_window(events, ts, duration, slide).select(
        "window", F.col(mid).alias("mid"), F.col(evid).alias("evid"), F.when(is_coupon, F.col(uid)).alias("uid"),
        F.when(is_coupon, F.col(item)).alias("item"))
    per_type = rows.groupBy("window", "mid", "evid", "uid", "item").agg(F.count(F.lit(1)).alias("n"))
    return alerts_of_counts(per_type, min_users, coupon, click)


def alerts_of_counts(per_type: DataFrame, min_users: int = MIN_COUPON_USERS, coupon: str = COUPON_EVENT,
                     click: str = CLICK_EVENT) -> DataFrame:
    """Alerting profiles from counts per (window, mid, evid, uid, item): lists are built for the device-windows that alert only."""
    hits = alerting_windows(per_type, min_users, coupon, click).select(F.col("window").alias("_w"), F.col("mid").alias("_m"))
    kept = per_type.join(hits, F.col("window").eqNullSafe(F.col("_w")) & F.col("mid").eqNullSafe(F.col("_m")), "left_semi")
    by_type = kept.groupBy("window", "mid", "evid").agg(
        F.sum("n").alias("n"), F.collect_set("uid").alias("_uids"), F.collect_set("item").alias("_items"))
    return alert_rule(fold_profiles(by_type, coupon, click), min_users)
