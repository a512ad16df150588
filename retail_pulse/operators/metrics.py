"""Serving aggregates over the detail tables: daily totals and hourly series.

Each takes an already date-filtered detail DataFrame (the filter is a range
on the raw timestamp, or a partition predicate, so it reaches the scan) and
returns a small aggregate. Hash aggregation runs partial-then-final, so only
one partial row per key and map task crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_total(detail: DataFrame, alias: str = "dau") -> DataFrame:
    """One row: number of detail rows (0 when empty)."""
    return detail.agg(F.count(F.lit(1)).cast("bigint").alias(alias))


def count_by_hour(detail: DataFrame, hour_col: str = "log_hour", alias: str = "dau") -> DataFrame:
    """(hour, count) for the hours that have rows (sparse)."""
    return detail.groupBy(F.col(hour_col).alias("hour")).agg(F.count(F.lit(1)).cast("bigint").alias(alias))


def sum_total(detail: DataFrame, amount_col: str = "total_amount", alias: str = "order_amount",
              digits: int | None = 2) -> DataFrame:
    """One row: sum of the amount column (NULL when there are no rows)."""
    s = F.sum(F.col(amount_col)).cast("double")
    return detail.agg((F.round(s, digits) if digits is not None else s).alias(alias))


def sum_by_hour(detail: DataFrame, hour_col: str = "create_hour", amount_col: str = "total_amount",
                alias: str = "order_amount", digits: int | None = 2) -> DataFrame:
    """(hour, sum as double) for the hours that have rows (sparse)."""
    s = F.sum(F.col(amount_col)).cast("double")
    return detail.groupBy(F.col(hour_col).alias("hour")) \
        .agg((F.round(s, digits) if digits is not None else s).alias(alias))
