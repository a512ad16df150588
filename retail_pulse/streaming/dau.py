"""Daily-active-device stream: replay-safe cross-batch dedup into a detail table.

Per micro-batch ``n`` (``foreachBatch``):

1. in-batch dedup: earliest record per (mid, log_date) -- ``row_number`` is
   not allowed on a streaming frame, but the batch frame is static;
2. cross-batch filter: left-anti join against the detail table's rows of
   batches ``< n`` for the dates present in this batch. The batch's distinct
   dates (a handful of strings) pick the ``log_date`` folders to read, so
   file listing is proportional to those dates, not to the table's history
   of batch folders;
3. idempotent write to ``log_date=<d>/_batch_id=<n>`` with dynamic partition
   overwrite.

A replayed batch reads the same input, sees the same older batches and
rewrites the same partitions, so the table is exactly-once. The seen set
itself never goes through the driver: it is a table scan joined on executors.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.functions.jsonparse import parse_json_column, split_quarantine
from retail_pulse.functions.time import log_date, log_hour, ms_in_range, ms_to_timestamp
from retail_pulse.operators.dedup import dedup_device_day, drop_seen
from retail_pulse.schemas import DAU_TABLE_COLUMNS, STARTUP_LOG, STARTUP_TYPES
from retail_pulse.sources.sinks import write_batch_partition
from retail_pulse.streaming.runner import BatchCounts, read_partitions


def startup_parsed(messages: DataFrame) -> DataFrame:
    """``value`` JSON messages -> typed startup logs with log_date/log_hour, ``_parse_ok`` and
    ``_reject_reason``: malformed JSON, a bad number, no ``mid`` or ``ts``, a ``ts`` out of range."""
    parsed = parse_json_column(messages, STARTUP_LOG, STARTUP_TYPES, required=["mid", "ts"],
                               checks={"bad_time": ms_in_range("ts")})
    t = ms_to_timestamp("ts")
    return parsed.withColumn("log_date", log_date(t)).withColumn("log_hour", log_hour(t))


def startup_from_messages(messages: DataFrame) -> DataFrame:
    """The good rows of :func:`startup_parsed` (the jobs keep the others in a quarantine table)."""
    return split_quarantine(startup_parsed(messages))[0]


def split_keyless(batch: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to store, quarantine rows): rejected messages, and rows whose key is NULL."""
    parsed = "_parse_ok" in batch.columns
    good, bad = split_quarantine(batch) if parsed else (batch, None)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    keyless = good.where(missing).select(F.to_json(F.struct(*good.columns)).alias("_raw"), F.lit("missing_key").alias("_reject_reason"))
    return good.where(~missing), bad.unionByName(keyless) if parsed else keyless


def dau_batch_writer(spark: SparkSession, detail_path: str, order_cols: list[str] | None = None,
                     counts: BatchCounts | None = None, mid: str = "mid", date_col: str = "log_date",
                     quarantine_path: str | None = None):
    """Build the ``foreachBatch`` function writing new device-days to ``detail_path``.

    Rejected messages and rows without a device or day go to ``quarantine_path`` (under the batch
    id, so a replay does not double them). The batch is computed once and kept for its jobs.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, bad = split_keyless(batch, [mid, date_col])
            if quarantine_path and not bad.isEmpty():
                write_batch_partition(bad, quarantine_path, batch_id)
            store(rows, batch_id)
        finally:
            batch.unpersist()

    def store(batch: DataFrame, batch_id: int) -> None:
        raw = counts.tap(batch, "raw") if counts else batch
        first = dedup_device_day(raw, mid, date_col, order_cols)
        if counts:
            first = counts.tap(first, "in_batch")
        schema = T.StructType(list(first.schema.fields) + [T.StructField("_batch_id", T.LongType())])
        dates = [r[0] for r in batch.select(date_col).distinct().collect()]  # days in this batch: a handful
        detail = read_partitions(spark, detail_path, date_col, dates, schema)
        if detail is not None:
            seen = detail.where(F.col("_batch_id") < F.lit(int(batch_id))).select(mid, date_col)
            first = drop_seen(first, seen, [mid, date_col])
        if counts:
            first = counts.tap(first, "new")
        write_batch_partition(first, detail_path, batch_id, [date_col])
        if counts:
            counts.collect(batch_id)

    return process


def dau_table_view(detail: DataFrame) -> DataFrame:
    """Detail rows in the serving table's upper-case columns (positional projection)."""
    cols = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "log_date", "log_hour", "ts"]
    present = [F.col(c) if c in detail.columns else F.lit(None).cast("string") for c in cols]
    return detail.select(*[c.alias(t) for c, t in zip(present, DAU_TABLE_COLUMNS)])


def start_dau_stream(spark: SparkSession, source: DataFrame, detail_path: str, checkpoint: str,
                     trigger: dict, order_cols: list[str] | None = None, counts: BatchCounts | None = None,
                     query_name: str | None = None, quarantine_path: str | None = None):
    """Start the DAU query on a streaming frame in startup-log shape (with or without parse flags)."""
    w = source.writeStream.foreachBatch(dau_batch_writer(spark, detail_path, order_cols, counts, quarantine_path=quarantine_path)) \
        .option("checkpointLocation", checkpoint).trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def first_arrivals(logs: DataFrame, delay: str = "1 day", mid: str = "mid", date_col: str = "log_date",
                   ts: str = "ts_event") -> DataFrame:
    """Low-latency variant: first *arriving* record per (mid, log_date), state kept for ``delay``.

    ``dropDuplicatesWithinWatermark`` needs no ``foreachBatch`` and its state
    is bounded by the watermark, but it keeps the first record to arrive,
    not the earliest by time: a record of the same device-day with an
    earlier timestamp in a later batch is dropped. It equals the min-ts
    dedup when records arrive in time order. ``ts`` must be a TIMESTAMP
    column (the event time the watermark tracks).
    """
    return logs.withWatermark(ts, delay).dropDuplicatesWithinWatermark([mid, date_col])
