"""The deployable streaming applications, wired end to end.

* ``dau``    startup messages -> parse -> DAU ``foreachBatch`` -> detail table
* ``dau --keyed-state``  the same with the seen keys in keyed state instead of the detail table
* ``first_seen`` startup messages -> first day of each device, kept up (run it beside ``dau``)
* ``orders`` order messages -> parse -> order table (+ quarantine)
* ``alert``  event messages -> parse -> watermarked windows -> alert index
* ``cdc``    change entries -> INSERT rows of one table -> order messages (text files or a topic)

Sources are a Kafka topic (``--source kafka --location brokers``) or a
folder of JSON-lines text files (``--source files --location path``). All
state, tables and checkpoints live under ``--work`` (shared storage on a
cluster). The clock is the job's micro-batch interval, or ``availableNow``
to process what is there and stop.

    python -m retail_pulse.streaming.apps dau --source kafka --location host:9092 --work /shared/rp

(with ``spark-submit``, ship the package with ``--py-files`` and run this module as the main file).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from retail_pulse.functions.jsonparse import parse_json_column, split_quarantine
from retail_pulse.functions.time import log_date, log_hour, ms_in_range, ms_to_timestamp
from retail_pulse.operators import alert as A
from retail_pulse.operators import cdc
from retail_pulse.schemas import ALERT_INDEX_SUFFIX, ES_ALERT_INDEX, EVENT_LOG, EVENT_TYPES, TOPIC_ORDER
from retail_pulse.sources import readers
from retail_pulse.sources.sinks import index_name, kafka_sink_options, write_batch_partition
from retail_pulse.streaming import alert as SA
from retail_pulse.streaming import keyed as K
from retail_pulse.streaming.dau import start_dau_stream, startup_parsed
from retail_pulse.streaming.gmv import order_batch_writer, parsed_orders
from retail_pulse.streaming.runner import BatchCounts, trigger_kwargs

APPS = ("dau", "first_seen", "orders", "alert", "cdc")
STARTUP_ORDER = ["ts", "uid", "appid", "area", "os", "ch", "type", "vs"]


def message_source(spark: SparkSession, source: str, location: str, stream: str,
                   max_per_trigger: int | None = None) -> DataFrame:
    """``value`` strings of one logical stream from Kafka or from JSON-lines files.

    ``max_per_trigger`` caps one micro-batch (Kafka offsets or files), so a job
    catching up on a backlog works through it in bounded batches.
    """
    if source == "kafka":
        return readers.kafka_stream(spark, location, stream,
                                    max_offsets_per_trigger=max_per_trigger).select("value")
    return readers.message_stream(spark, location, max_files_per_trigger=max_per_trigger)


def events_from_messages(messages: DataFrame) -> DataFrame:
    """Event-log JSON messages -> (mid, uid, evid, itemid, ts TIMESTAMP, log_date, log_hour)."""
    good, _bad = split_quarantine(event_parsed(messages))
    t = ms_to_timestamp("ts")
    return good.select("mid", "uid", "evid", "itemid", t.alias("ts"),
                       log_date(t).alias("log_date"), log_hour(t).alias("log_hour"))


def event_parsed(messages: DataFrame) -> DataFrame:
    """Event-log JSON messages parsed; rejects are malformed JSON, a bad number, no ``ts`` or one out of range."""
    return parse_json_column(messages, EVENT_LOG, EVENT_TYPES, required=["ts"], checks={"bad_time": ms_in_range("ts")})


def start_quarantine(parsed: DataFrame, path: str, checkpoint: str, trigger: dict, name: str = "event_quarantine"):
    """A query of its own for the messages that a stateful job cannot use: such a job is
    one plan without a batch hook before its state."""
    bad = split_quarantine(parsed)[1]
    return bad.writeStream.queryName(name) \
        .foreachBatch(lambda batch, n: write_batch_partition(batch, path, n)) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()


def orders_from_messages(messages: DataFrame) -> DataFrame:
    """Order JSON messages -> parsed rows with ``_parse_ok`` (split per batch by the writer)."""
    return parsed_orders(messages)


def start_app(spark: SparkSession, app: str, source: str, location: str, work: str, trigger: dict,
              sink: str = "files", out: str | None = None, counts: BatchCounts | None = None,
              live: bool = False, max_per_trigger: int | None = None, arrival_time: bool = False,
              topic: str | None = None, feed_format: str = "parquet", tables: str = readers.CDC_TABLE_PATTERN,
              keyed_state: bool = False):
    """Start one application; returns the running ``StreamingQuery``.

    ``sink``/``out`` apply to ``cdc``: order messages to a Kafka topic (``out`` = brokers) or
    to text files (``out`` = folder, default under ``work``). ``live`` runs the alert app in
    update mode (alerts while the window is open, retracted by tombstones). ``topic``,
    ``feed_format`` (parquet or json) and ``tables`` (a regex on ``database.table``) apply to ``cdc``.
    ``keyed_state`` runs the dau app on keyed state. The stateful apps start a second, named query for broken
    messages: await ``spark.streams`` to see the end of either.
    """
    ckpt = os.path.join(work, "checkpoints", app)
    if app == "first_seen" or app == "dau" and keyed_state:
        parsed = startup_parsed(message_source(spark, source, location, "startup", max_per_trigger))
        logs = split_quarantine(parsed)[0].withColumn("ts_event", ms_to_timestamp("ts"))
        if app == "first_seen":  # the broken messages are the dau app's
            return K.start_first_seen_stream(spark, logs, os.path.join(work, "first_seen"), ckpt, trigger, query_name="first_seen")
        start_quarantine(startup_parsed(message_source(spark, source, location, "startup", max_per_trigger)),
                         os.path.join(work, "startup_quarantine"), ckpt + "_state_quarantine", trigger, "startup_quarantine")
        return K.start_dau_state_stream(logs, os.path.join(work, "dau_detail"), ckpt + "_state", trigger, STARTUP_ORDER, query_name="dau")
    if app == "dau":
        logs = startup_parsed(message_source(spark, source, location, "startup", max_per_trigger))
        # per-batch counts (raw, after in-batch dedup, new) ride on the batch's own write job
        return start_dau_stream(spark, logs, os.path.join(work, "dau_detail"), ckpt, trigger,
                                order_cols=STARTUP_ORDER,
                                counts=counts or BatchCounts(printer=print, table=os.path.join(work, "dau_counts")), query_name="dau",
                                quarantine_path=os.path.join(work, "startup_quarantine"))
    if app == "orders":
        parsed = orders_from_messages(message_source(spark, source, location, "order", max_per_trigger))
        writer = order_batch_writer(os.path.join(work, "order_info"), os.path.join(work, "order_quarantine"))
        return parsed.writeStream.queryName("orders").foreachBatch(writer) \
            .option("checkpointLocation", ckpt).trigger(**trigger).start()
    if app == "alert":
        events = events_from_messages(message_source(spark, source, location, "event", max_per_trigger))
        docs = os.path.join(work, index_name(ES_ALERT_INDEX, ALERT_INDEX_SUFFIX))
        start_quarantine(event_parsed(message_source(spark, source, location, "event", max_per_trigger)),
                         os.path.join(work, "event_quarantine"), ckpt + "_quarantine", trigger)
        if live:
            return SA.start_live_alert_stream(spark, events, os.path.join(docs, "live"), ckpt + "_live", trigger,
                                              coupon=A.COUPON_EVENT, click=A.CLICK_EVENT, arrival_time=arrival_time)
        return SA.start_alert_stream(spark, events, docs, ckpt, trigger, coupon=A.COUPON_EVENT, click=A.CLICK_EVENT,
                                     arrival_time=arrival_time)
    if app == "cdc":
        if source == "kafka":
            changes = readers.change_feed_messages(
                readers.kafka_stream(spark, location, "cdc", topic=topic, max_offsets_per_trigger=max_per_trigger))
        else:
            changes = readers.change_feed_stream(spark, location, feed_format, max_files_per_trigger=max_per_trigger)
        messages = cdc.change_feed_messages(readers.subscribed(changes, tables), "order_info", cdc.INSERT)
        if sink == "kafka":
            return messages.writeStream.format("kafka").options(**kafka_sink_options(out, TOPIC_ORDER)) \
                .option("checkpointLocation", ckpt).trigger(**trigger).start()
        return messages.writeStream.format("text").option("path", out or os.path.join(work, "order_messages")) \
            .option("checkpointLocation", ckpt).trigger(**trigger).start()
    raise ValueError(f"unknown app {app!r}; expected one of {APPS}")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="retail_pulse.streaming.apps")
    p.add_argument("app", choices=APPS)
    p.add_argument("--source", choices=("kafka", "files"), default="files",
                   help="read a Kafka topic or JSON-lines files (change-feed files for cdc)")
    p.add_argument("--location", required=True, help="Kafka brokers, or the input folder")
    p.add_argument("--work", required=True, help="shared folder for tables and checkpoints")
    p.add_argument("--sink", choices=("kafka", "files"), default="files", help="cdc: where order messages go")
    p.add_argument("--out", default=None, help="cdc: Kafka brokers, or a folder for order messages")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--live", action="store_true", help="alert: update mode, alerts while windows are open")
    p.add_argument("--keyed-state", action="store_true", help="dau: seen keys in keyed state, no look-up in the table")
    p.add_argument("--arrival-time", action="store_true", help="alert: window by arrival (processing) time")
    p.add_argument("--max-per-trigger", type=int, default=None,
                   help="cap per micro-batch: Kafka offsets, or files for file sources")
    p.add_argument("--topic", default=None, help="cdc: topic of the change entries (JSON)")
    p.add_argument("--feed-format", choices=("parquet", "json"), default="parquet", help="cdc: format of change-feed files")
    p.add_argument("--tables", default=readers.CDC_TABLE_PATTERN, help="cdc: regex of database.table")
    a = p.parse_args(argv)
    if a.app == "cdc" and a.source == "kafka" and not a.topic:
        p.error("cdc --source kafka needs --topic <change feed topic>")
    if a.app == "cdc" and a.sink == "kafka" and not a.out:
        p.error("cdc --sink kafka needs --out <brokers>")
    from retail_pulse.session import build_session
    spark = build_session(app_name=f"retail_pulse_{a.app}")
    clock = {"dau": "dau", "first_seen": "dau", "orders": "gmv", "alert": "alert", "cdc": "gmv"}[a.app]
    q = start_app(spark, a.app, a.source, a.location, a.work, trigger_kwargs(clock, a.available_now), a.sink, a.out,
                  live=a.live, max_per_trigger=a.max_per_trigger, arrival_time=a.arrival_time, topic=a.topic,
                  feed_format=a.feed_format, tables=a.tables, keyed_state=a.keyed_state)
    if a.available_now:
        for s in [q, *spark.streams.active]:
            s.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
