"""Daily-active-device operators: first record per device-day, seen-set filter, new devices.

Plans (checked with ``explain``):

* :func:`first_per_key` is ``row_number() = 1`` over ``(keys)`` ordered by
  ``order_cols``. Catalyst turns it into a partial ``WindowGroupLimit``
  *before* the hash exchange and a final one after it, so every map task
  already keeps only one row per key: a device holding a third of all rows
  ships one row per map task, not its whole history.
* :func:`drop_seen` is a left-anti join on ``(mid, log_date)``. No hint:
  AQE broadcasts the seen side only when its measured size is under
  ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a sort-merge
  anti join, so a large seen set never has to fit in one executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str | Column]) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_cols`` (ties broken by later columns)."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_device_day(logs: DataFrame, mid: str = "mid", date_col: str = "log_date",
                     order_cols: list[str] | None = None) -> DataFrame:
    """In-batch dedup: per (mid, log_date) keep the earliest record.

    ``order_cols`` defaults to ``ts`` then ``event_id`` when present, so equal
    timestamps resolve deterministically.
    """
    if order_cols is None:
        order_cols = ["ts"] + (["event_id"] if "event_id" in logs.columns else [])
    return first_per_key(logs, [mid, date_col], order_cols)


def drop_seen(batch: DataFrame, seen: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Cross-batch filter: drop batch rows whose key is already in ``seen``."""
    keys = keys or ["mid", "log_date"]
    return batch.join(seen.select(*keys), on=keys, how="left_anti")


def first_seen_dates(logs: DataFrame, mid: str = "mid", date_col: str = "log_date", ts: str | None = None) -> DataFrame:
    """(mid, first_date): the first day each device appears (partial-aggregated min).

    With ``ts`` the minimum is taken of the timestamp and formatted afterwards: a fixed-width minimum is a hash
    aggregate, a minimum of text sorts the whole input.
    """
    if ts is not None:
        return logs.groupBy(mid).agg(F.min(ts).alias("_t")).select(mid, F.date_format("_t", "yyyy-MM-dd").alias("first_date"))
    return logs.groupBy(mid).agg(F.min(date_col).alias("first_date"))


def extend_first_seen(known: DataFrame, batch: DataFrame, mid: str = "mid", date_col: str = "log_date") -> DataFrame:
    """The (mid, first_date) table with a batch of device-days added; a card then reads this table and not the history."""
    days = batch.select(F.col(mid), F.col(date_col).cast("date").alias("_d"))
    both = known.select(F.col(mid), F.col("first_date").cast("date").alias("_d")).unionByName(days)
    return both.groupBy(mid).agg(F.min("_d").alias("_d")).select(mid, F.date_format("_d", "yyyy-MM-dd").alias("first_date"))


def new_devices_count(logs: DataFrame, date: str, mid: str = "mid", date_col: str = "log_date", ts: str | None = None) -> DataFrame:
    """One row ``new_mid``: devices whose first active day is ``date``.

    Callers should pre-filter ``logs`` to records before ``date + 1 day``:
    later records cannot change the answer and the filter reaches the scan.
    """
    return first_seen_dates(logs, mid, date_col, ts) \
        .agg(F.count_if(F.col("first_date") == F.lit(date)).cast("bigint").alias("new_mid"))
