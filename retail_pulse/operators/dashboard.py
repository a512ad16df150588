"""Dashboard result shapes: metric cards and today-vs-yesterday hour series.

Both metrics of the hour comparison are computed from **one** scan of the
two days (a range predicate covering yesterday and today), with a
conditional aggregate per hour; the fixed 24-hour spine (24 rows, bounded
by definition) is broadcast and left-joined so missing hours become 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Metric card ids and display names.
METRIC_CARDS = [
    ("dau", "新增日活"),
    ("new_mid", "新增设备"),
    ("order_amount", "新增交易额"),
]
HOUR_METRICS = ("dau", "order_amount")


def hour_spine(spark: SparkSession) -> DataFrame:
    """24 rows ``hour`` = '00'..'23'."""
    return spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def hour_compare(spark: SparkSession, detail: DataFrame, today: str, yesterday: str,
                 date_col: str, hour_col: str, amount_col: str | None = None,
                 fill_zero: bool = True, digits: int = 2) -> DataFrame:
    """(hour, today, yesterday) over both days of ``detail`` in one pass.

    ``amount_col`` None counts rows (DAU); otherwise sums the amount (GMV).
    ``fill_zero`` returns the 24-hour spine with zeros; otherwise only hours
    present on either day (sparse maps).
    """
    is_t = F.col(date_col) == F.lit(today)
    is_y = F.col(date_col) == F.lit(yesterday)
    if amount_col is None:
        agg_t = F.count_if(is_t).cast("bigint")
        agg_y = F.count_if(is_y).cast("bigint")
        zero = F.lit(0).cast("bigint")
    else:
        agg_t = F.round(F.sum(F.when(is_t, F.col(amount_col))).cast("double"), digits)
        agg_y = F.round(F.sum(F.when(is_y, F.col(amount_col))).cast("double"), digits)
        zero = F.lit(0.0)
    per_hour = detail.where(is_t | is_y).groupBy(F.col(hour_col).alias("hour")) \
        .agg(agg_t.alias("today"), agg_y.alias("yesterday"))
    if not fill_zero:
        return per_hour
    spine = F.broadcast(hour_spine(spark))
    return spine.join(per_hour, "hour", "left").select(
        "hour", F.coalesce("today", zero).alias("today"), F.coalesce("yesterday", zero).alias("yesterday"))


def metric_cards(dau_total: DataFrame, new_mid: DataFrame, gmv_total: DataFrame,
                 keep_order: bool = False) -> DataFrame:
    """Three rows (id, name, value as double) from three one-row aggregates.

    ``keep_order`` keeps ``_pos`` (card position) and ``_card`` (its JSON object) for the JSON shape.
    """
    parts = []
    for pos, ((mid, name), df) in enumerate(zip(METRIC_CARDS, [dau_total, new_mid, gmv_total])):
        col = df.columns[0]
        # the JSON form keeps each value's own type: counts are whole numbers there
        card = F.to_json(F.struct(F.lit(mid).alias("id"), F.lit(name).alias("name"), F.col(col).alias("value")))
        parts.append(df.select(F.lit(mid).alias("id"), F.lit(name).alias("name"),
                               F.col(col).cast("double").alias("value"), F.lit(pos).alias("_pos"), card.alias("_card")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_pos", "_card") if not keep_order else out


def check_metric(metric_id: str) -> str:
    """Unknown metric ids are an error, not empty maps."""
    if metric_id not in HOUR_METRICS:
        raise ValueError(f"unknown metric id {metric_id!r}; expected one of {HOUR_METRICS}")
    return metric_id


def hour_maps_json(per_hour: DataFrame, today_col: str = "today", yesterday_col: str = "yesterday",
                   zero_is_missing: bool = True) -> DataFrame:
    """(hour, today, yesterday) rows -> one JSON string ``{"today":{HH:v},"yesterday":{HH:v}}``.

    Maps are sparse (hours without rows are absent, zero-fill is the
    client's job) and keys are sorted; NULL values are left out. A count of 0 only says
    that the other day has the hour; for sums pass ``zero_is_missing=False``: NULL
    says that, and a sum of 0.0 is a value.
    """
    def hour_map(col):
        there = F.col(col).isNotNull()
        if zero_is_missing:
            there = there & (F.col(col) != 0)
        entries = F.collect_list(F.when(there, F.struct(F.col("hour").alias("k"), F.col(col).alias("v"))))
        return F.map_from_entries(F.array_sort(entries))
    return per_hour.agg(F.to_json(F.struct(hour_map(today_col).alias("today"),
                                           hour_map(yesterday_col).alias("yesterday"))).alias("json"))


def metric_cards_json(cards: DataFrame) -> DataFrame:
    """Card rows (with ``_pos``, ``_card``) -> one JSON list ``[{"id","name","value"}]`` in card order.

    The list has exactly one element per card (three rows), so gathering it
    into one value is bounded; a NULL value is left out of its object.
    """
    entries = F.array_sort(F.collect_list(F.struct("_pos", "_card")))
    return cards.agg(F.concat(F.lit("["), F.array_join(F.transform(entries, lambda e: e["_card"]), ","), F.lit("]")).alias("json"))
