"""Record schemas of the retail streams and the source registry.

Stream payloads are JSON strings. Every field is declared as STRING first and
cast afterwards with ``try_cast``: change-feed rows carry numbers as quoted
text, and a ``double`` field in ``from_json`` turns ``"12.5"`` into NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the messages, in the order of the detail tables' columns.
STARTUP_FIELDS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts"]
EVENT_FIELDS = ["mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid", "ts"]
ORDER_FIELDS = [
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
]


def all_string(fields: list[str]) -> T.StructType:
    """Parse schema: every field STRING (casts happen after parsing)."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


# Typed targets after parsing: {field: spark type name}; unspecified = string.
STARTUP_TYPES = {"ts": "bigint"}
EVENT_TYPES = {"ts": "bigint"}
ORDER_TYPES = {"total_amount": "double"}

STARTUP_LOG = all_string(STARTUP_FIELDS)
EVENT_LOG = all_string(EVENT_FIELDS)
ORDER_INFO = all_string(ORDER_FIELDS)

COUPON_ALERT = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("uids", T.ArrayType(T.StringType())),
    T.StructField("itemIds", T.ArrayType(T.StringType())),
    T.StructField("events", T.ArrayType(T.StringType())),
    T.StructField("ts", T.LongType()),
])

CHANGE_COLUMN = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])
CHANGE_EVENT = T.StructType([
    T.StructField("execute_time", T.TimestampType()),
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("entry_type", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("rows", T.ArrayType(T.ArrayType(CHANGE_COLUMN))),
])

# Upper-case column lists of the two detail tables (positional rename on write).
DAU_TABLE_COLUMNS = ["MID", "UID", "APPID", "AREA", "OS", "CH", "TYPE", "VS", "LOGDATE", "LOGHOUR", "TS"]
ORDER_TABLE_COLUMNS = [c.upper() for c in ORDER_FIELDS] + ["CREATE_DATE", "CREATE_HOUR"]

# Stream topics and index names used by the pipeline.
TOPIC_STARTUP = "GMALL_STARTUP"
TOPIC_ORDER = "GMALL_ORDER"
TOPIC_EVENT = "GMALL_EVENT"
TOPIC_ORDER_DETAIL = "TOPIC_ORDER_DETAIL"
TOPIC_USER_INFO = "TOPIC_USER_INFO"
CDC_DATABASE = "gmall"
ES_ALERT_INDEX = "gmall_coupon_alert"
ES_SALE_DETAIL_INDEX = "gmall2021_sale_detail"
ES_SALE_DETAIL_QUERY = "gmall2021_sale_detail-query"
ALERT_INDEX_SUFFIX = "0726"

# Source registry: logical stream -> (topic, parse schema, typed casts).
SOURCES = {
    "startup": (TOPIC_STARTUP, STARTUP_LOG, STARTUP_TYPES),
    "event": (TOPIC_EVENT, EVENT_LOG, EVENT_TYPES),
    "order": (TOPIC_ORDER, ORDER_INFO, ORDER_TYPES),
    # reserved, no consumer yet
    "order_detail": (TOPIC_ORDER_DETAIL, None, {}),
    "user": (TOPIC_USER_INFO, None, {}),
    # the change feed has no fixed topic: the application names it
    "cdc": (None, CHANGE_EVENT, {}),
}
