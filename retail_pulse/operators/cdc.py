"""Change-feed operators: keep INSERTs of one table and flatten rows to JSON messages.

A change entry is ``(table, entry_type, event_type, rows)`` where each row is
the list of its after-image columns ``[(name, value)]`` with every value as
text. The binlog client itself is not rebuilt; any source that lands
entries in this shape (Kafka topic, JSON files) feeds these functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_pulse.schemas import CDC_DATABASE

# Entry and event type names of the change feed.
ROWDATA = "ROWDATA"
INSERT = "INSERT"
UPDATE = "UPDATE"


def rows_of(changes: DataFrame, table: str = "order_info", event_type: str = INSERT,
            entry_type: str = ROWDATA, table_pattern: str | None = None) -> DataFrame:
    """Filter entries and explode their rows: one output row per changed row (``cols``)."""
    cond = (F.col("entry_type") == F.lit(entry_type)) & (F.col("event_type") == F.lit(event_type))
    cond = cond & (F.col("table").rlike(table_pattern) if table_pattern else F.col("table") == F.lit(table))
    return changes.where(cond).select(F.explode(F.col("rows")).alias("cols"))


def rows_to_messages(rows: DataFrame) -> DataFrame:
    """``cols`` array of (name, value) -> flat JSON object string in ``value``.

    Of a column that comes twice the last value stays; columns without a name are left out.
    """
    def is_last(c, i):
        later = F.slice(F.col("cols"), i + F.lit(2), F.greatest(F.size("cols"), F.lit(1)))
        return c["name"].isNotNull() & ~F.exists(later, lambda x: x["name"].eqNullSafe(c["name"]))
    return rows.select(F.to_json(F.map_from_entries(F.filter(F.col("cols"), is_last))).alias("value"))


def change_feed_messages(changes: DataFrame, table: str = "order_info", event_type: str = INSERT) -> DataFrame:
    """The whole CDC step: filter + explode + JSON (what is sent to the order topic)."""
    return rows_to_messages(rows_of(changes, table, event_type))


def as_change_entries(df: DataFrame, table: str, event_type, entry_type: str = ROWDATA,
                      columns: list[str] | None = None, execute_time=None, database: str = CDC_DATABASE) -> DataFrame:
    """Wrap each row of ``df`` as a one-row change entry (values rendered as text).

    ``event_type`` is a literal or a Column (e.g. derived from a status);
    ``execute_time`` a Column giving the entry's commit time (NULL if absent).
    """
    columns = columns or df.columns
    cols = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    et = event_type if not isinstance(event_type, str) else F.lit(event_type)
    xt = (execute_time if execute_time is not None else F.lit(None)).cast("timestamp")
    return df.select(xt.alias("execute_time"), F.lit(database).alias("database"), F.lit(table).alias("table"), F.lit(entry_type).alias("entry_type"),
                     et.alias("event_type"), F.array(cols).alias("rows"))
