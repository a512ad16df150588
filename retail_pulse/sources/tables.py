"""Table scans and adapters from the warehouse tables to the pipeline's record shapes.

Adapters only rename and derive columns; Catalyst prunes every column a
query does not use, so an adapter costs nothing at the scan.

Column mapping used by the registered queries:

* startup log: ``mid`` = ``uid`` = ``events.user_id``
* event log:   ``mid`` = ``props.$.k``, ``uid`` = ``user_id``, ``evid`` = ``event_type``;
               the table has no item column, so ``itemid`` is NULL (an id unique per
               row would make the per-device item set grow with the row count);
               coupon = ``purchase``, click = ``click``
* order info:  ``orders`` with ``create_time`` rendered from ``o_orderdate`` and a
               synthetic 11-digit phone ``'1' || lpad(o_custkey, 10, '0')``
* user:        ``customer`` with a gender (even key F, odd M) and an age (16 + key mod 30) made from the key
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_pulse.functions.time import log_date, log_hour, to_millis

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Event-name mapping of the events table onto the alert rule.
EVENTS_COUPON = "purchase"
EVENTS_CLICK = "click"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet`` (vectorized reader, pushdown, pruning)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def balanced(df: DataFrame) -> DataFrame:
    """Spread a scan over the cluster's cores before CPU-heavy per-row work.

    A file written as a single row group is read by one task however many
    cores there are. The hint only marks the plan (nothing runs and nothing is probed while
    the query is built); rows are dealt round robin and AQE sizes the partitions.
    """
    return df.hint("repartition", df.sparkSession.sparkContext.defaultParallelism)


def startup_logs(events: DataFrame) -> DataFrame:
    """events -> startup-log shape: mid, uid, event_id, ts, ts_ms, log_date, log_hour."""
    return events.select(
        F.col("user_id").alias("mid"), F.col("user_id").alias("uid"), "event_id", "event_type",
        "value", "ts", to_millis("ts").alias("ts_ms"),
        log_date("ts").alias("log_date"), log_hour("ts").alias("log_hour"))


def event_logs(events: DataFrame) -> DataFrame:
    """events -> event-log shape: mid, uid, evid, itemid, event_id, ts, log_date, log_hour."""
    return events.select(
        F.get_json_object("props", "$.k").alias("mid"), F.col("user_id").cast("string").alias("uid"),
        F.col("event_type").alias("evid"), F.lit(None).cast("string").alias("itemid"),
        "event_id", "ts", log_date("ts").alias("log_date"), log_hour("ts").alias("log_hour"))


def order_info(orders: DataFrame) -> DataFrame:
    """orders -> order-info shape with every value as text (as the change feed sends it)."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_comment"),
        F.concat(F.lit("1"), F.lpad(F.col("o_custkey").cast("string"), 10, "0")).alias("consignee_tel"),
        F.col("o_totalprice").cast("string").alias("total_amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"))


def users(customer: DataFrame) -> DataFrame:
    """customer -> user columns of a sale row. The table has neither gender nor age: both are made from the key."""
    return customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"), F.col("c_mktsegment").alias("user_level"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("user_gender"),
        (F.lit(16) + F.col("c_custkey") % 30).cast("int").alias("user_age"))


def sale_detail(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Wide sale row: order line x order x SKU (inner joins on keys)."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = part.select("p_partkey", "p_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("sku_id"),
        F.col("p_name").alias("sku_name"), F.col("l_quantity").alias("sku_num"),
        F.col("l_extendedprice").alias("sku_price"), F.col("o_orderdate").alias("order_ts"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"))
