"""Streaming queries registered for the driver.

Each replays a warehouse table through the real streaming job and returns
the table the job wrote, so the result can be checked against the batch
operator / SQL. Work folders live under the session's shared
``spark.checkpoint.dir``; each call uses a fresh sub-folder.

Every replay writes its source in 4 event-time slices and runs the query
with ``availableNow`` after each slice from the same checkpoint, so each
slice is one micro-batch and every run after the first is a restart from
the checkpoint.

* ``dau_stream``: startup records -> DAU ``foreachBatch`` (dedup, seen-set
  anti join, idempotent write).
* ``startup_stream``: the same through JSON text messages and the string
  schema parse.
* ``alert_stream``: the watermarked window job in append mode; a last row far in the future
  closes every window, so the result is the whole batch answer.
* ``alert_live``: the same windows in update mode (alerts while a window is open).
* ``alert_sliding_stream``: sliding windows put together from panes, both in the state.
* ``dau_state_stream``: the DAU job with its seen keys in keyed state.
* ``first_seen_stream``: the first day of each device as a maintained table; ``metric_cards_table``: the
  dashboard's cards from one day's folders of these tables.
* ``gmv_stream``: a change feed built from orders and customers, in commit
  order -> order table (+ quarantine); entries of other databases are not subscribed.
* ``order_table_keyed``: every order message delivered twice.
* ``startup_quarantine``: messages broken in each way that the job rejects, counted by reason.
* ``dau_table_*``, ``gmv_table_*``: the dashboard's numbers read from the tables that the jobs wrote.
* ``dau_batch_counts``: the per-batch counts that ride on the write job.
* ``sale_detail_stream``: order and line change streams -> interval join ->
  SKU and user enrichment; ``sale_unmatched``: the lines parked; ``sale_recovered``: the sales after their re-injection.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.operators import alert as A
from retail_pulse.operators import cdc, dashboard, metrics
from retail_pulse.plans import queries as Q
from retail_pulse.session import shared_dir
from retail_pulse.sources import readers
from retail_pulse.sources import tables as tb
from retail_pulse.schemas import (ALERT_INDEX_SUFFIX, ES_ALERT_INDEX, ES_SALE_DETAIL_INDEX, ES_SALE_DETAIL_QUERY,
                                  STARTUP_LOG)
from retail_pulse.sources.sinks import index_name, materialize
from retail_pulse.streaming import alert as SA
from retail_pulse.streaming import keyed as K
from retail_pulse.functions.jsonparse import to_json_messages
from retail_pulse.functions.time import to_millis
from retail_pulse.streaming.dau import dau_table_view, start_dau_stream, startup_from_messages, startup_parsed
from retail_pulse.streaming.gmv import order_batch_writer, order_table, parsed_orders, start_gmv_stream
from retail_pulse.streaming.sales import PARKED_LINES, parked_beside, recover_parked, start_sale_detail_stream, start_user_stream
from retail_pulse.streaming.runner import BatchCounts, measured_broadcasts, replay_chunks, stream_conf

REPLAY_SLICES = 4
ALERT_WINDOW = "1 day"
ALERT_DELAY = "1 hour"
AVAILABLE_NOW = {"availableNow": True}
TIMEOUT_S = 600
# every third user has another level from this time on (shared with the oracle SQL)
USER_CHANGE = Q.USER_CHANGE


# Micro-batch wall times (ms, ``triggerExecution``) of the last replay per job.
BATCH_MS: dict[str, list[int]] = {}


def _await(q, job: str):
    if not q.awaitTermination(TIMEOUT_S):
        q.stop()
        raise TimeoutError("streaming replay did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    for p in q.recentProgress:
        if p.numInputRows:
            BATCH_MS.setdefault(job, []).append(int(p.durationMs.get("triggerExecution", 0)))


def _replay_dau(spark: SparkSession, sf: str, job: str, counts: BatchCounts | None = None) -> tuple[str, T.StructType]:
    """Replay the startup logs through the DAU job; path and schema of the table it wrote."""
    BATCH_MS[job] = []
    work = shared_dir(spark, job.replace("_", "-"))
    src, detail, ckpt = (os.path.join(work, p) for p in ("source", "detail", "checkpoint"))
    logs = tb.startup_logs(tb.table(spark, sf, "events")) \
        .select("mid", "uid", "event_id", "ts", "ts_ms", "log_date", "log_hour")
    for _ in replay_chunks(spark, logs, "ts", REPLAY_SLICES, src):
        stream = spark.readStream.schema(logs.schema).parquet(src)
        _await(start_dau_stream(spark, stream, detail, ckpt, AVAILABLE_NOW, order_cols=["ts", "event_id"], counts=counts), job)
    return detail, T.StructType(logs.schema.fields + [T.StructField("_batch_id", T.LongType())])


def dau_stream(spark: SparkSession, sf: str) -> DataFrame:
    detail, schema = _replay_dau(spark, sf, "dau_stream")
    return readers.detail_table(spark, detail, "log_date", schema=schema) \
        .select("mid", "log_date", "log_hour", "event_id", "ts_ms")


def _replay_logs(spark: SparkSession, sf: str, job: str, starts) -> None:
    """Replay the startup logs in time slices; after each one run the queries that ``starts`` makes of the stream."""
    BATCH_MS[job] = []
    src = os.path.join(shared_dir(spark, job.replace("_", "-")), "source")
    logs = tb.startup_logs(tb.table(spark, sf, "events")).select("mid", "uid", "event_id", "ts", "ts_ms", "log_date", "log_hour")
    for _ in replay_chunks(spark, logs, "ts", REPLAY_SLICES, src):
        stream = spark.readStream.schema(logs.schema).parquet(src).withColumn("ts_event", F.col("ts").cast("timestamp")).drop("ts")
        for q in [start(stream) for start in starts]:  # beside each other, as they are deployed
            _await(q, job)


_DAU_STATE_TABLE = T.StructType([T.StructField("mid", T.LongType()), T.StructField("uid", T.LongType()), T.StructField("event_id", T.LongType()),
                                 T.StructField("ts_ms", T.LongType()), T.StructField("log_hour", T.StringType()),
                                 T.StructField("log_date", T.StringType()), T.StructField("_batch_id", T.LongType())])


def dau_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The daily active devices with the seen keys in keyed state: nothing of the table is read while the job runs."""
    work = shared_dir(spark, "dau-state")
    detail, ckpt = os.path.join(work, "detail"), os.path.join(work, "checkpoint")
    _replay_logs(spark, sf, "dau_state_stream", [
        lambda stream: K.start_dau_state_stream(stream, detail, ckpt, AVAILABLE_NOW, ["ts_ms", "ts_event", "event_id"])])
    return K.dau_state_table(spark, detail, _DAU_STATE_TABLE).select("mid", "log_date", "log_hour", "event_id", "ts_ms")


def first_seen_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The first day of each device, kept up by a job of its own."""
    work = shared_dir(spark, "first-seen")
    path, ckpt = os.path.join(work, "first_seen"), os.path.join(work, "checkpoint")
    _replay_logs(spark, sf, "first_seen_stream", [lambda stream: K.start_first_seen_stream(spark, stream, path, ckpt, AVAILABLE_NOW)])
    return K.first_seen_table(spark, path).select(F.col("mid").cast("bigint").alias("mid"), "first_date")


def metric_cards_table(spark: SparkSession, sf: str) -> DataFrame:
    """The metric cards of a day from the tables that the jobs keep: one day folder of devices, one of first days, one month of orders."""
    work = shared_dir(spark, "metric-cards")
    detail, seen, orders, bad, msgs = (os.path.join(work, p) for p in ("detail", "first_seen", "orders", "quarantine", "messages"))
    ckpt = [os.path.join(work, f"checkpoint-{n}") for n in range(3)]
    _replay_logs(spark, sf, "metric_cards_table", [
        lambda stream: K.start_dau_state_stream(stream, detail, ckpt[0], AVAILABLE_NOW, ["ts_ms", "ts_event", "event_id"]),
        lambda stream: K.start_first_seen_stream(spark, stream, seen, ckpt[1], AVAILABLE_NOW)])
    # purchases are the orders whose time has an hour
    bought = tb.table(spark, sf, "events").where(F.col("event_type") == F.lit(tb.EVENTS_COUPON))
    to_json_messages(bought.select(F.col("event_id").cast("string").alias("id"), F.col("value").cast("string").alias("total_amount"),
                                   F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time"))).write.text(msgs)
    parsed = parsed_orders(readers.message_stream(spark, msgs, max_files_per_trigger=None))
    _await(parsed.writeStream.foreachBatch(order_batch_writer(orders, bad)).option("checkpointLocation", ckpt[2])
           .trigger(**AVAILABLE_NOW).start(), "metric_cards_table")
    return table_cards(spark, detail, seen, orders, Q.NEW_DEVICE_DATE)


def table_cards(spark: SparkSession, detail: str, seen: str, orders: str, date: str) -> DataFrame:
    day = K.dau_state_table(spark, detail, _DAU_STATE_TABLE, [date])
    return dashboard.metric_cards(metrics.count_total(day, "dau"), K.new_devices_of_day(spark, seen, date),
                                  metrics.sum_total(order_table(spark, orders, [date]), "TOTAL_AMOUNT", "order_amount"))


def _dau_table_day(spark: SparkSession, sf: str, job: str) -> DataFrame:
    detail, schema = _replay_dau(spark, sf, job)
    return dau_table_view(readers.detail_table(spark, detail, "log_date", [Q.DAU_DATE], schema))


def dau_table_total(spark: SparkSession, sf: str) -> DataFrame:
    """The day's active devices, read from the table that the DAU job wrote (upper-case columns)."""
    return metrics.count_total(_dau_table_day(spark, sf, "dau_table_total"), "dau")


def dau_table_hour(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.count_by_hour(_dau_table_day(spark, sf, "dau_table_hour"), "LOGHOUR", "dau")


def dau_batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the DAU batches read, kept after the in-batch dedup, and stored, over all batches: from the table of counts that the job writes."""
    path = os.path.join(shared_dir(spark, "dau-batch-counts"), "counts")
    _replay_dau(spark, sf, "dau_batch_counts", BatchCounts(table=path))
    rows = spark.read.schema("point string, n bigint, _batch_id bigint").parquet(path)
    return rows.agg(*[F.sum(F.when(F.col("point") == p, F.col("n"))).alias(p) for p in ("raw", "in_batch", "new")])


def startup_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Startup messages of which some are broken on purpose: rejected messages per reason."""
    work = shared_dir(spark, "startup-quarantine")
    src, detail, bad, ckpt = (os.path.join(work, p) for p in ("messages", "detail", "quarantine", "checkpoint"))
    ev = tb.table(spark, sf, "events")
    kind = F.col("event_id") % 10
    ts = F.when(kind == 1, F.lit("soon")).when(kind == 2, F.lit(str(2**63 - 1))).when(kind == 3, F.lit(None)).otherwise(to_millis("ts").cast("string"))
    mid = F.when(kind != 4, F.col("user_id").cast("string"))
    message = F.to_json(F.struct(mid.alias("mid"), F.col("user_id").cast("string").alias("uid"), ts.alias("ts")))
    ev.select(F.when(kind == 5, F.lit("{not json")).otherwise(message).alias("value")).write.text(src)
    logs = startup_parsed(readers.message_stream(spark, src, max_files_per_trigger=None))
    _await(start_dau_stream(spark, logs, detail, ckpt, AVAILABLE_NOW, order_cols=["ts", "uid"], quarantine_path=bad), "startup_quarantine")
    return spark.read.parquet(bad).groupBy(F.col("_reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def startup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Startup logs as JSON messages (epoch-ms ``ts``) in text files -> text stream -> parse with
    the string schema + try_cast -> log_date/log_hour from epoch ms -> DAU foreachBatch."""
    BATCH_MS["startup_stream"] = []
    work = shared_dir(spark, "startup-stream")
    src, detail, ckpt = (os.path.join(work, p) for p in ("messages", "detail", "checkpoint"))
    ev = tb.table(spark, sf, "events")

    def as_messages(part: DataFrame) -> DataFrame:
        return to_json_messages(part.select(F.col("user_id").cast("string").alias("mid"),
                                            F.col("user_id").cast("string").alias("uid"),
                                            F.col("event_type").alias("type"), to_millis("ts").alias("ts")))
    for _ in replay_chunks(spark, ev, "ts", REPLAY_SLICES, src, fmt="text", project=as_messages):
        logs = startup_from_messages(readers.message_stream(spark, src, max_files_per_trigger=None))
        _await(start_dau_stream(spark, logs, detail, ckpt, AVAILABLE_NOW,
                                order_cols=["ts", "uid", "type"]), "startup_stream")
    # partition values are typed by the table's schema, not guessed (log_date stays a string)
    detail_schema = T.StructType([T.StructField(c, T.LongType() if c == "ts" else T.StringType())
                                  for c in STARTUP_LOG.fieldNames()]
                                 + [T.StructField("log_hour", T.StringType()), T.StructField("log_date", T.StringType()),
                                    T.StructField("_batch_id", T.LongType())])
    return spark.read.schema(detail_schema).parquet(detail).select(
        F.col("mid").cast("bigint").alias("mid"), "log_date", "log_hour", F.col("ts").alias("ts_ms"))


def alert_stream(spark: SparkSession, sf: str) -> DataFrame:
    BATCH_MS["alert_stream"] = []
    work = shared_dir(spark, "alert-stream")
    src, ckpt = os.path.join(work, "source"), os.path.join(work, "checkpoint")
    docs = os.path.join(work, index_name(ES_ALERT_INDEX, ALERT_INDEX_SUFFIX))
    ev = tb.event_logs(tb.table(spark, sf, "events")).select("mid", "uid", "evid", "itemid", "ts")
    def run():
        stream = spark.readStream.schema(ev.schema).parquet(src)
        _await(SA.start_alert_stream(spark, stream, docs, ckpt, AVAILABLE_NOW, ALERT_WINDOW, None, ALERT_DELAY,
                                     coupon=tb.EVENTS_COUPON, click=tb.EVENTS_CLICK), "alert_stream")
    for _ in replay_chunks(spark, ev, "ts", REPLAY_SLICES, src):
        run()
    _flush(ev).write.mode("append").parquet(src)
    run()
    latest = SA.alert_index(spark, docs)
    return latest.select("id", "mid", F.size("uids").cast("bigint").alias("n_uids"),
                         F.array_join("itemIds", ",").alias("item_ids"),
                         A.hist_text(F.col("events")).alias("events"), "ts")


def alert_sliding_stream(spark: SparkSession, sf: str) -> DataFrame:
    """One-day windows every 12 hours, streamed: 12-hour panes, and the windows added up from them."""
    BATCH_MS["alert_sliding_stream"] = []
    work = shared_dir(spark, "alert-sliding")
    src, docs, ckpt = (os.path.join(work, p) for p in ("source", "docs", "checkpoint"))
    ev = tb.event_logs(tb.table(spark, sf, "events")).select("mid", "uid", "evid", "itemid", "ts")

    def run():
        stream = spark.readStream.schema(ev.schema).parquet(src)
        _await(SA.start_alert_stream(spark, stream, docs, ckpt, AVAILABLE_NOW, ALERT_WINDOW, Q.ALERT_SLIDE, ALERT_DELAY,
                                     coupon=tb.EVENTS_COUPON, click=tb.EVENTS_CLICK), "alert_sliding_stream")
    for _ in replay_chunks(spark, ev, "ts", 2, src):
        run()
    _flush(ev).write.mode("append").parquet(src)
    run()
    start = F.timestamp_millis("ts") - F.expr(f"INTERVAL {ALERT_WINDOW}")
    return SA.alert_index(spark, docs).select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "mid",
                                              F.size("uids").cast("bigint").alias("n_uids"), F.array_join("uids", ",").alias("uids"),
                                              "n_events", A.hist_text(F.col("events")).alias("events"))


def _flush(ev: DataFrame) -> DataFrame:
    """One row far ahead: append mode holds a window until the watermark has passed it, and this row closes them all."""
    return ev.agg((F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts")).where("ts IS NOT NULL") \
        .select(F.lit(None).cast("string").alias("mid"), F.lit(None).cast("string").alias("uid"), F.lit("flush").alias("evid"),
                F.lit(None).cast("string").alias("itemid"), "ts")


def alert_live(spark: SparkSession, sf: str) -> DataFrame:
    """The update-mode alert job over the same windows: what is live once all events are in."""
    BATCH_MS["alert_live"] = []
    work = shared_dir(spark, "alert-live")
    src, docs, ckpt = (os.path.join(work, p) for p in ("source", "docs", "checkpoint"))
    ev = tb.event_logs(tb.table(spark, sf, "events")).select("mid", "uid", "evid", "itemid", "ts")
    for _ in replay_chunks(spark, ev, "ts", 2, src):
        stream = spark.readStream.schema(ev.schema).parquet(src)
        _await(SA.start_live_alert_stream(spark, stream, docs, ckpt, AVAILABLE_NOW, ALERT_WINDOW, None, ALERT_DELAY,
                                          coupon=tb.EVENTS_COUPON, click=tb.EVENTS_CLICK), "alert_live")
    return SA.live_alert_index(spark, docs).select("id", "mid", F.size("uids").cast("bigint").alias("n_uids"), "n_events", "ts")


def _order_messages(spark: SparkSession, sf: str, job: str) -> str:
    """All orders delivered twice as messages (two slices, each a batch) through the order job; the table it wrote."""
    BATCH_MS[job] = []
    work = shared_dir(spark, job.replace("_", "-"))
    src, table, bad, ckpt = (os.path.join(work, p) for p in ("messages", "orders", "quarantine", "checkpoint"))
    messages = to_json_messages(tb.order_info(tb.table(spark, sf, "orders")))
    for _ in range(2):
        messages.write.mode("append").text(src)
        parsed = parsed_orders(readers.message_stream(spark, src, max_files_per_trigger=None))
        _await(parsed.writeStream.foreachBatch(order_batch_writer(table, bad)).option("checkpointLocation", ckpt)
               .trigger(**AVAILABLE_NOW).start(), job)
    return table


def order_table_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders delivered twice are one order of the table."""
    t = order_table(spark, _order_messages(spark, sf, "order_table_keyed"))
    return t.select(F.col("ID").alias("id"), F.col("TOTAL_AMOUNT").alias("total_amount"), F.col("CREATE_DATE").alias("create_date"))


def gmv_table_total(spark: SparkSession, sf: str) -> DataFrame:
    """The day's order value, read from the table that the order job wrote."""
    t = order_table(spark, _order_messages(spark, sf, "gmv_table_total"), [Q.GMV_DATE])
    return metrics.sum_total(t, "TOTAL_AMOUNT", "order_amount")


def gmv_table_hour(spark: SparkSession, sf: str) -> DataFrame:
    t = order_table(spark, _order_messages(spark, sf, "gmv_table_hour"), [Q.GMV_DATE])
    return metrics.sum_by_hour(t, "CREATE_HOUR", "TOTAL_AMOUNT", "order_amount")


def gmv_stream(spark: SparkSession, sf: str) -> DataFrame:
    BATCH_MS["gmv_stream"] = []
    work = shared_dir(spark, "gmv-stream")
    src, table, bad, ckpt = (os.path.join(work, p) for p in ("source", "orders", "quarantine", "checkpoint"))
    oi = tb.order_info(tb.table(spark, sf, "orders"))
    et = F.when(F.col("order_status") == F.lit("F"), F.lit(cdc.INSERT)).otherwise(F.lit(cdc.UPDATE))
    xt = F.to_timestamp("create_time")
    feed = cdc.as_change_entries(oi, "order_info", et, columns=oi.columns, execute_time=xt).unionByName(
        cdc.as_change_entries(tb.table(spark, sf, "customer").select("c_custkey", "c_name"), "user_info",
                              cdc.INSERT, execute_time=F.lit("1995-01-01 00:00:00")))
    # the same orders in a database that is not subscribed
    feed = feed.unionByName(cdc.as_change_entries(oi, "order_info", cdc.INSERT, columns=oi.columns, execute_time=xt, database="archive"))
    # entries arrive in commit order: replay the feed in execute_time slices, one batch each
    for _ in replay_chunks(spark, feed, "execute_time", REPLAY_SLICES, src):
        changes = readers.subscribed(readers.change_feed_stream(spark, src, max_files_per_trigger=None))
        _await(start_gmv_stream(spark, changes, table, ckpt, AVAILABLE_NOW, quarantine_path=bad), "gmv_stream")
    t = order_table(spark, table)
    return t.select(F.col("ID").alias("id"), F.col("USER_ID").alias("user_id"),
                    F.col("TOTAL_AMOUNT").alias("total_amount"), F.col("CONSIGNEE_TEL").alias("consignee_tel"),
                    F.col("CREATE_DATE").alias("create_date"), F.col("CREATE_HOUR").alias("create_hour"))


def _user_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A change stream of users: all of them from the start, and a new level of every third one from ``USER_CHANGE`` on."""
    users = tb.users(tb.table(spark, sf, "customer"))
    first = users.withColumn("valid_from", F.lit("1990-01-01 00:00:00").cast("timestamp"))
    later = users.where(F.col("user_id") % 3 == 0).withColumn("user_level", F.lower("user_level")) \
        .withColumn("valid_from", F.lit(USER_CHANGE).cast("timestamp"))
    return first.unionByName(later)


def _replay_users(spark: SparkSession, sf: str, work: str, job: str) -> str:
    src, path, ckpt = (os.path.join(work, p) for p in ("user-changes", "users", "user-checkpoint"))
    changes = _user_changes(spark, sf)
    changes.write.parquet(src)
    _await(start_user_stream(spark.readStream.schema(changes.schema).parquet(src), path, ckpt, AVAILABLE_NOW), job)
    return path


def sale_detail_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and order lines replayed as two change streams (a line is committed with its order,
    ``ts`` = order time + line number seconds), interval-joined, enriched with the SKU table and with
    the user as of the order's time."""
    BATCH_MS["sale_detail_stream"] = []
    work = shared_dir(spark, "sale-stream")
    o_src, l_src, ckpt = (os.path.join(work, p) for p in ("orders", "lines", "checkpoint"))
    table = os.path.join(work, ES_SALE_DETAIL_INDEX)
    users = _replay_users(spark, sf, work, "sale_detail_stream")
    orders = tb.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("ts"))
    # the line feed (each line stamped with its order's commit time) is built once, then sliced
    lines = materialize(tb.table(spark, sf, "lineitem").join(orders.select("o_orderkey", "ts"),
                                                             F.col("l_orderkey") == F.col("o_orderkey"))
                        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                                (F.col("ts") + F.make_dt_interval(secs=F.col("l_linenumber").cast("decimal(18,6)")))
                                .alias("ts")), "sale-stream-lines")
    part = tb.table(spark, sf, "part")
    slices = zip(replay_chunks(spark, orders, "ts", REPLAY_SLICES, o_src),
                 replay_chunks(spark, lines, "ts", REPLAY_SLICES, l_src))
    for _ in slices:
        os_ = spark.readStream.schema(orders.schema).parquet(o_src)
        ls_ = spark.readStream.schema(lines.schema).parquet(l_src)
        _await(start_sale_detail_stream(spark, os_, ls_, part, table, ckpt, AVAILABLE_NOW, users_path=users), "sale_detail_stream")
    # the query alias is a view over the index table (view names take no "-")
    alias = readers.register_view(spark.read.parquet(table).drop("_batch_id", "dt_month"), ES_SALE_DETAIL_QUERY.replace("-", "_"))
    return spark.table(alias)


def _replay_gaps(spark: SparkSession, sf: str, job: str, users: bool = False) -> tuple[str, str, str | None]:
    """The sale job where every seventh order never comes in time and every fifth SKU is unknown: (table, parked lines, users)."""
    BATCH_MS[job] = []
    work = shared_dir(spark, job.replace("_", "-"))
    o_src, l_src, table, ckpt = (os.path.join(work, p) for p in ("orders", "lines", "sales", "checkpoint"))
    users_path = _replay_users(spark, sf, work, job) if users else None
    all_orders = tb.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("ts"))
    lines = tb.table(spark, sf, "lineitem").join(all_orders.select("o_orderkey", "ts"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "ts")
    part = tb.table(spark, sf, "part").where(F.col("p_partkey") % 5 != 0)
    all_orders.where(F.col("o_orderkey") % 7 != 0).write.parquet(o_src)
    with measured_broadcasts(spark):
        lines.write.parquet(l_src)
    for step in range(2):
        if step:  # one order and one line far ahead rule out every open match
            ahead = all_orders.agg((F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts")).where("ts IS NOT NULL")
            ahead.select(F.lit(-1).cast("long").alias("o_orderkey"), F.lit(None).cast("long").alias("o_custkey"), "ts").write.mode("append").parquet(o_src)
            ahead.select(F.lit(-2).cast("long").alias("l_orderkey"), *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in lines.columns[1:-1]],
                         "ts").write.mode("append").parquet(l_src)
        streams = [spark.readStream.schema(d.schema).parquet(p) for d, p in ((all_orders, o_src), (lines, l_src))]
        _await(start_sale_detail_stream(spark, *streams, part, table, ckpt, AVAILABLE_NOW, users_path=users_path), job)
    return table, parked_beside(table), users_path


def sale_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines that no sale row is made of, per reason: every seventh order never comes, every fifth SKU is unknown."""
    _, parked, _ = _replay_gaps(spark, sf, "sale_unmatched")
    return spark.read.schema(PARKED_LINES).parquet(parked).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def sale_recovered(spark: SparkSession, sf: str) -> DataFrame:
    """The same, after the missing orders and then the missing SKUs have come: the sale rows are complete, with their users."""
    table, parked, users = _replay_gaps(spark, sf, "sale_recovered", users=True)
    orders = tb.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("ts"))
    part = tb.table(spark, sf, "part")
    recover_parked(spark, orders, part.where(F.col("p_partkey") % 5 != 0), table, 0, users_path=users)
    for _ in range(2):  # the second round is run twice, as after a crash
        recover_parked(spark, orders, part, table, 1, users_path=users)
    return spark.read.parquet(table).drop("_batch_id", "dt_month")


def _with_stream_conf(fn):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        with stream_conf(spark):
            return fn(spark, sf)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


STREAM_QUERIES = {name: _with_stream_conf(fn) for name, fn in {
    "dau_stream": dau_stream,
    "startup_stream": startup_stream,
    "alert_stream": alert_stream,
    "gmv_stream": gmv_stream,
    "sale_detail_stream": sale_detail_stream,
    "dau_table_total": dau_table_total,
    "dau_table_hour": dau_table_hour,
    "dau_batch_counts": dau_batch_counts,
    "startup_quarantine": startup_quarantine,
    "order_table_keyed": order_table_keyed,
    "gmv_table_total": gmv_table_total,
    "gmv_table_hour": gmv_table_hour,
    "alert_live": alert_live,
    "sale_unmatched": sale_unmatched,
    "sale_recovered": sale_recovered,
    "dau_state_stream": dau_state_stream,
    "first_seen_stream": first_seen_stream,
    "metric_cards_table": metric_cards_table,
    "alert_sliding_stream": alert_sliding_stream,
}.items()}
