"""Coupon-alert stream: event-time windows with a watermark, keyed upsert of alert documents.

The reference windows by processing time; here windows are on event time
(``window(ts, duration, slide)``) with a watermark, so replays and late data
give the same documents.

* Streaming part (stateful, RocksDB-compatible state): counts per
  ``(window, mid, evid, coupon user, coupon item)`` in **append** mode -- a window's rows
  are emitted once, when the watermark passes its end, all in the same
  micro-batch. A state row is a key and a number, whatever the device does; no
  list or set is ever kept or rewritten.
* Sliding windows are put together from panes: a first aggregate counts per pane (as long as
  the slide), a second one, chained to it, adds the panes of each window. An event is
  counted once, and only the pane's counts are copied into the windows that hold it.
* ``foreachBatch`` part (static frame): the rule first, then the lists of the
  device-windows that alert; documents keyed by ``mid || minute(window end)`` are upserted under
  the batch id (last write wins per id), in folders by the day of the window's end.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.functions.time import minute_of, to_millis
from retail_pulse.operators import alert as A
from retail_pulse.sources.sinks import latest_documents, upsert_documents
from retail_pulse.streaming.runner import read_partitions

# 1-minute slide for the 5-minute window: documents are keyed per device-minute,
# so a finer slide would only repeat rows without adding documents.
DEFAULT_WINDOW = "5 minutes"
DEFAULT_SLIDE = "1 minute"


def _timed(events: DataFrame, ts: str, delay: str, arrival_time: bool) -> DataFrame:
    """Event time (the record's ``ts``) or arrival time (the micro-batch's clock), with a watermark."""
    t = F.current_timestamp() if arrival_time else F.col(ts).cast("timestamp")
    return events.withColumn(ts, t).withWatermark(ts, delay)


def stage_one(events: DataFrame, duration: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
              delay: str = "1 minute", coupon: str = A.COUPON_EVENT, ts: str = "ts",
              arrival_time: bool = False) -> DataFrame:
    """Streaming: watermark + window + counts per (window, mid, evid, uid, item); users and items of coupon events only.

    With a ``slide`` (which must divide ``duration``) the windows are added up from panes of that length.
    """
    is_coupon = F.col("evid") == F.lit(coupon)
    ev = _timed(events, ts, delay, arrival_time).withColumn("uid", F.when(is_coupon, F.col("uid"))) \
        .withColumn("item", F.when(is_coupon, F.col("itemid")))
    key = ["mid", "evid", "uid", "item"]
    first = ev.groupBy(F.window(F.col(ts), slide or duration).alias("window"), *key).agg(F.count(F.lit(1)).alias("n"))
    if not slide or slide == duration:
        return first
    panes = first.select(F.window_time("window").alias("pane_time"), *key, "n")
    return panes.groupBy(F.window("pane_time", duration, slide).alias("window"), *key).agg(F.sum("n").alias("n"))


# Stored alert document versions (as written by ``upsert_documents``).
ALERT_DOC_TABLE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("mid", T.StringType()),
    T.StructField("uids", T.ArrayType(T.StringType())), T.StructField("itemIds", T.ArrayType(T.StringType())),
    T.StructField("events", T.ArrayType(T.StructType([T.StructField("evid", T.StringType()),
                                                      T.StructField("n", T.LongType())]))),
    T.StructField("n_events", T.LongType()),
    T.StructField("ts", T.LongType()), T.StructField("_seq", T.LongType()), T.StructField("win_date", T.StringType()),
    T.StructField("_batch_id", T.LongType()),
])


def alert_index(spark: SparkSession, docs_path: str, win_dates: list[str] | None = None) -> DataFrame:
    """Latest alert document per id (empty, not an error, before the first alert); ``win_dates`` reads the folders of these days."""
    t = spark.read.schema(ALERT_DOC_TABLE).parquet(docs_path)
    if win_dates is not None:
        t = t.where(F.col("win_date").isin(win_dates))
    return latest_documents(t)


def alert_batch_writer(docs_path: str, coupon: str = A.COUPON_EVENT, click: str = A.CLICK_EVENT,
                       min_users: int = A.MIN_COUPON_USERS):
    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # the rule and the lists read it
        try:
            alerts = A.alerts_of_counts(batch, min_users, coupon, click)
            docs = A.alert_documents(alerts)  # events kept as the bounded histogram
            docs = docs.withColumn("win_date", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd"))
            upsert_documents(docs, docs_path, batch_id, "id", order_col="ts", partition_cols=["win_date"])
        finally:
            batch.unpersist()
    return process


def start_alert_stream(spark: SparkSession, events: DataFrame, docs_path: str, checkpoint: str, trigger: dict,
                       duration: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE, delay: str = "1 minute",
                       coupon: str = A.COUPON_EVENT, click: str = A.CLICK_EVENT, arrival_time: bool = False):
    agg = stage_one(events, duration, slide, delay, coupon, arrival_time=arrival_time)
    return agg.writeStream.outputMode("append") \
        .foreachBatch(alert_batch_writer(docs_path, coupon, click)) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --- low-latency variant: update mode + tombstones ----------------------------

def live_profiles(events: DataFrame, duration: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                  delay: str = "1 minute", coupon: str = A.COUPON_EVENT, click: str = A.CLICK_EVENT,
                  ts: str = "ts", arrival_time: bool = False) -> DataFrame:
    """Streaming profile per (window, mid) from bounded aggregates only.

    Emitted in update mode every micro-batch a device's window changes, so
    an alert can be raised while the window is still open. Event types are
    kept as a distinct set (multiplicities need the two-stage append job).
    ``arrival_time`` windows by the micro-batch's clock instead of ``ts`` (the
    reference's processing-time window over the last minutes of arrivals).
    """
    ev = _timed(events, ts, delay, arrival_time)
    w = F.window(F.col(ts), duration, slide) if slide else F.window(F.col(ts), duration)
    is_coupon = F.col("evid") == F.lit(coupon)
    return ev.groupBy(w.alias("window"), "mid").agg(
        F.array_sort(F.collect_set(F.when(is_coupon, F.col("uid")))).alias("uids"),
        F.array_sort(F.collect_set(F.when(is_coupon, F.col("itemid")))).alias("itemIds"),
        F.array_sort(F.collect_set(F.col("evid"))).alias("event_types"),
        F.count(F.lit(1)).cast("bigint").alias("n_events"),
        F.max(F.col("evid") == F.lit(click)).alias("clicked"))


LIVE_DOC_TABLE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("mid", T.StringType()),
    T.StructField("uids", T.ArrayType(T.StringType())), T.StructField("itemIds", T.ArrayType(T.StringType())),
    T.StructField("event_types", T.ArrayType(T.StringType())), T.StructField("n_events", T.LongType()),
    T.StructField("ts", T.LongType()), T.StructField("deleted", T.BooleanType()),
    T.StructField("_seq", T.LongType()), T.StructField("win_date", T.StringType()),
    T.StructField("_batch_id", T.LongType()),
])


def live_alert_index(spark: SparkSession, docs_path: str, win_dates: list[str] | None = None) -> DataFrame:
    """Current alerts: latest version per id that is not a tombstone.

    Documents are partitioned by the date of their window end; ``win_dates``
    reads only those folders.
    """
    if win_dates is not None:
        versions = read_partitions(spark, docs_path, "win_date", win_dates, LIVE_DOC_TABLE)
        if versions is None:
            return spark.createDataFrame([], LIVE_DOC_TABLE).drop("deleted", "_seq", "_batch_id")
    else:
        versions = spark.read.schema(LIVE_DOC_TABLE).parquet(docs_path)
    return latest_documents(versions).where(~F.col("deleted")).drop("deleted")


def live_alert_writer(spark: SparkSession, docs_path: str, min_users: int = A.MIN_COUPON_USERS):
    """``foreachBatch`` for update mode: upsert qualifying profiles; tombstone only documents that
    are live and whose profile stopped qualifying (never one per non-alerting device). The live
    documents are looked up only in the window-end dates of this batch (a handful of folders)."""
    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            store(batch, batch_id)
        finally:
            batch.unpersist()

    def store(batch: DataFrame, batch_id: int) -> None:
        end_ms = to_millis(F.col("window.end"))
        docs = batch.select(
            F.concat(F.col("mid").cast("string"), minute_of(end_ms).cast("string")).alias("id"),
            F.col("mid").cast("string").alias("mid"), "uids", "itemIds", "event_types", "n_events",
            end_ms.alias("ts"),
            (~((F.size("uids") >= F.lit(min_users)) & ~F.coalesce(F.col("clicked"), F.lit(False)))).alias("deleted"),
            F.date_format("window.end", "yyyy-MM-dd").alias("win_date"))
        live = docs.where(~F.col("deleted"))
        win_dates = [r[0] for r in batch.select(F.date_format("window.end", "yyyy-MM-dd")).distinct().collect()]
        current = live_alert_index(spark, docs_path, win_dates).select("id")
        gone = docs.where(F.col("deleted")).join(current, "id", "left_semi")
        upsert_documents(live.unionByName(gone), docs_path, batch_id, "id", order_col="ts",
                         partition_cols=["win_date"])
    return process


def start_live_alert_stream(spark: SparkSession, events: DataFrame, docs_path: str, checkpoint: str,
                            trigger: dict, duration: str = DEFAULT_WINDOW, slide: str | None = DEFAULT_SLIDE,
                            delay: str = "1 minute", coupon: str = A.COUPON_EVENT, click: str = A.CLICK_EVENT,
                            arrival_time: bool = False):
    prof = live_profiles(events, duration, slide, delay, coupon, click, arrival_time=arrival_time)
    return prof.writeStream.outputMode("update").foreachBatch(live_alert_writer(spark, docs_path)) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
