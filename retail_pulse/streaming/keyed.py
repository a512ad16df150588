"""Streams that keep one small state row per key instead of looking keys up in a table.

``earliest_per_key`` is a streaming aggregate in update mode: per key the earliest record so far and the clock
of the key's last batch. A key comes out of a micro-batch only if it had records in it, and its winner carries
the clock of the batch that brought it, so "the winner is of this batch" tells new and improved keys from all
others without reading anything: neither the table that was written nor a list of its folders. What a batch
costs depends on its own records, not on how long the stream has run.

* ``dau_state``: per (day, device); the state of a day is evicted once the watermark has passed it.
* ``first_seen``: per device, for good (one row of a few bytes per device, in RocksDB).

The clock is the micro-batch's own time, which Spark stores with the offsets: a replayed batch has the clock of its
first run and emits the same rows. (The clock must not run backwards between two batches of a query.)
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.operators.dedup import first_per_key
from retail_pulse.sources.sinks import write_batch_partition


def earliest_per_key(stream: DataFrame, keys: list[Column | str], order_cols: list[str], columns: list[str]) -> DataFrame:
    """Keys, ``_first`` (struct of ``columns`` and ``_arrived``: the earliest record by ``order_cols``) and ``_last`` (clock of
    the key's last batch, with ``_since``, that of its first one). Ties go to the record that came first."""
    row = F.struct(*columns, "_arrived")
    return stream.withColumn("_arrived", F.current_timestamp()).groupBy(*keys).agg(
        F.min_by(row, F.struct(*order_cols, "_arrived")).alias("_first"),
        F.max("_arrived").alias("_last"), F.min("_arrived").alias("_since"))


def of_this_batch(batch: DataFrame) -> DataFrame:
    """The keys of an update-mode batch whose earliest record came with this batch."""
    return batch.where(F.col("_first._arrived") == F.col("_last"))


# --- daily active devices ---------------------------------------------------------

def dau_state(logs: DataFrame, order_cols: list[str], delay: str = "1 day", mid: str = "mid", date_col: str = "log_date",
              ts: str = "ts_event") -> DataFrame:
    """First record of each (day, device) as keyed state. ``ts`` is a TIMESTAMP column; rows without a device or a time
    take no part, and records that come more than ``delay`` behind the newest are dropped, as their day is closed."""
    rows = logs.where(F.col(mid).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    columns = [c for c in rows.columns if c != ts]
    return earliest_per_key(rows, [F.window(F.col(ts), "1 day").alias("day"), F.col(mid).alias("_mid")], order_cols, columns)


def dau_state_writer(detail_path: str, date_col: str = "log_date"):
    """``foreachBatch``: device-days that are new, or whose first record turned out to be an earlier one, as one version each."""
    def process(batch: DataFrame, batch_id: int) -> None:
        won = of_this_batch(batch).select("_first.*").drop("_arrived")
        write_batch_partition(won, detail_path, batch_id, [date_col])
    return process


def start_dau_state_stream(logs: DataFrame, detail_path: str, checkpoint: str, trigger: dict, order_cols: list[str],
                           delay: str = "1 day", ts: str = "ts_event", query_name: str | None = None):
    w = dau_state(logs, order_cols, delay, ts=ts).writeStream.outputMode("update") \
        .foreachBatch(dau_state_writer(detail_path)).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (w.queryName(query_name) if query_name else w).start()


def dau_state_table(spark: SparkSession, detail_path: str, schema: T.StructType, dates: list[str] | None = None,
                    mid: str = "mid", date_col: str = "log_date") -> DataFrame:
    """One row per device-day of the table (of ``dates``): its last version, which holds the earliest record."""
    t = spark.read.schema(schema).parquet(detail_path)
    if dates:
        t = t.where(F.col(date_col).isin(dates))
    return first_per_key(t, [mid, date_col], [F.col("_batch_id").desc()]).drop("_batch_id")


# --- first day of each device -------------------------------------------------------

FIRST_SEEN_TABLE = T.StructType([
    T.StructField("mid", T.StringType()), T.StructField("delta", T.IntegerType()),
    T.StructField("first_date", T.StringType()), T.StructField("_batch_id", T.LongType()),
])


def first_seen(logs: DataFrame, mid: str = "mid", date_col: str = "log_date") -> DataFrame:
    """First day of each device as keyed state, never evicted: a device is new only once."""
    rows = logs.where(F.col(mid).isNotNull() & F.col(date_col).isNotNull())
    return earliest_per_key(rows, [F.col(mid).cast("string").alias("mid")], [date_col], [date_col])


def first_seen_writer(spark: SparkSession, path: str, date_col: str = "log_date"):
    """``foreachBatch``: +1 for a device in the folder of its first day. A device that an old record moves to an earlier day also
    gets -1 in the folder it leaves; only for such devices, and only in the folders after the new day, is the table read."""
    def process(batch: DataFrame, batch_id: int) -> None:
        won = of_this_batch(batch).select("mid", F.col(f"_first.{date_col}").alias("first_date"), (F.col("_since") < F.col("_last")).alias("moved")) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = won.select("mid", F.lit(1).alias("delta"), "first_date")
            moved = won.where("moved")
            lowest = moved.agg(F.min("first_date")).first()[0]
            if lowest is not None:
                held = spark.read.schema(FIRST_SEEN_TABLE).parquet(path) \
                    .where((F.col("first_date") > F.lit(lowest)) & (F.col("_batch_id") < F.lit(int(batch_id)))) \
                    .join(moved.select("mid"), "mid", "left_semi") \
                    .groupBy("mid", "first_date").agg(F.sum("delta").alias("n")).where("n > 0")
                rows = rows.unionByName(held.select("mid", F.lit(-1).alias("delta"), "first_date"))
            write_batch_partition(rows, path, batch_id, ["first_date"])
        finally:
            won.unpersist()
    return process


def start_first_seen_stream(spark: SparkSession, logs: DataFrame, path: str, checkpoint: str, trigger: dict, query_name: str | None = None):
    """The first-seen table as a maintained view of the startup logs; run it beside the DAU job, on the same records."""
    w = first_seen(logs).writeStream.outputMode("update").foreachBatch(first_seen_writer(spark, path)) \
        .option("checkpointLocation", checkpoint).trigger(**trigger)
    return (w.queryName(query_name) if query_name else w).start()


def new_devices_of_day(spark: SparkSession, path: str, date: str) -> DataFrame:
    """One row ``new_mid``, from the one folder of the day: what came minus what left, without resolving a device."""
    day = spark.read.schema(FIRST_SEEN_TABLE).parquet(path).where(F.col("first_date") == F.lit(date))
    return day.agg(F.coalesce(F.sum("delta"), F.lit(0)).cast("bigint").alias("new_mid"))


def first_seen_table(spark: SparkSession, path: str) -> DataFrame:
    """(mid, first_date) of every device."""
    t = spark.read.schema(FIRST_SEEN_TABLE).parquet(path)
    return t.groupBy("mid", "first_date").agg(F.sum("delta").alias("n")).where("n > 0").select("mid", "first_date")
