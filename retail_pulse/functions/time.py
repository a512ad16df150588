"""Date and hour derivation as JVM-side column expressions.

Dates stay strings (``yyyy-MM-dd``) and hours zero-padded strings (``HH``),
as in the detail tables. Epoch-millisecond inputs are rendered in the
session time zone, so jobs pin ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Epoch milliseconds of 1970-01-01 and of 10000-01-01: four-digit years.
MIN_MS, MAX_MS = 0, 253402300800000


def ms_in_range(ts_ms) -> Column:
    """Whether epoch milliseconds fall in the years 1970 to 9999."""
    return (_c(ts_ms) >= F.lit(MIN_MS)) & (_c(ts_ms) < F.lit(MAX_MS))


def ms_to_timestamp(ts_ms) -> Column:
    """Epoch milliseconds (BIGINT) -> TIMESTAMP; NULL outside the years 1970 to 9999."""
    return F.when(ms_in_range(ts_ms), F.timestamp_millis(F.when(ms_in_range(ts_ms), _c(ts_ms))))


def create_time_ok(create_time) -> Column:
    """Whether text has the shape ``yyyy-MM-dd HH:...`` that date and hour are cut from."""
    return _c(create_time).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:")


def to_millis(ts) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> epoch milliseconds (BIGINT)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def log_date(ts) -> Column:
    """Timestamp -> ``yyyy-MM-dd`` string."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def log_hour(ts) -> Column:
    """Timestamp -> zero-padded hour ``HH`` string."""
    return F.date_format(_c(ts), "HH")


def with_log_date_hour(df, ts_col: str = "ts", epoch_ms: bool = False,
                       date_col: str = "log_date", hour_col: str = "log_hour"):
    """Add ``log_date`` / ``log_hour`` from a timestamp or an epoch-ms column."""
    t = ms_to_timestamp(ts_col) if epoch_ms else F.col(ts_col)
    return df.withColumn(date_col, log_date(t)).withColumn(hour_col, log_hour(t))


def create_date(create_time) -> Column:
    """``'yyyy-MM-dd HH:mm:ss'`` -> date part (text before the space)."""
    return F.split_part(_c(create_time), F.lit(" "), F.lit(1))


def create_hour(create_time) -> Column:
    """``'yyyy-MM-dd HH:mm:ss'`` -> hour part (text before the first colon of the time)."""
    return F.split_part(F.split_part(_c(create_time), F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def day_bounds(date: str, days: int = 1) -> tuple[_dt.datetime, _dt.datetime]:
    start = _dt.datetime.strptime(date, "%Y-%m-%d")
    return start, start + _dt.timedelta(days=days)


def on_days(ts_col: str, date: str, days: int = 1, ntz: bool = True) -> Column:
    """Predicate ``ts`` within ``[date, date + days)``.

    Written as a range on the raw timestamp column (not on a derived string)
    so that it reaches the Parquet scan as a pushed filter and prunes row
    groups; on a date-partitioned table the same bounds prune partitions.
    """
    lo, hi = day_bounds(date, days)
    typ = "timestamp_ntz" if ntz else "timestamp"
    lo_l = F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast(typ)
    hi_l = F.lit(hi.strftime("%Y-%m-%d %H:%M:%S")).cast(typ)
    return (F.col(ts_col) >= lo_l) & (F.col(ts_col) < hi_l)


def current_day() -> str:
    """Today in UTC as ``yyyy-MM-dd`` (the default day of the dashboard)."""
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")


def previous_day(date: str) -> str:
    return (_dt.datetime.strptime(date, "%Y-%m-%d") - _dt.timedelta(days=1)).strftime("%Y-%m-%d")


def minute_of(ts_ms) -> Column:
    """Epoch ms -> whole minutes since the epoch (integer division)."""
    return F.floor(_c(ts_ms) / F.lit(60000)).cast("bigint")
