"""Named queries over the warehouse tables: ``(spark, sf_dir) -> DataFrame``.

Each query wires sources -> adapters -> operators. Parameters (dates,
search text, page) are fixed here so that every query has a DuckDB oracle
in :mod:`retail_pulse.plans.oracle`; column names match it exactly.
All queries read whole tables; date predicates are the query semantics
(the serving queries are per day) and are written as ranges on the raw
timestamp so they reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_pulse.functions.jsonparse import parse_records, to_json_messages
from retail_pulse.functions.mask import mask_phone
from retail_pulse.functions.time import create_date, create_hour, on_days, previous_day
from retail_pulse.operators import alert as A
from retail_pulse.operators import cdc, dashboard, dedup, metrics, sales, search, search_index
from retail_pulse.schemas import ORDER_INFO, ORDER_TYPES
from retail_pulse.session import shared_dir
from retail_pulse.sources import readers, sinks
from retail_pulse.sources import tables as tb

# Query parameters (shared with the oracle SQL).
DAU_DATE = "2024-01-15"
DAU_PREV = previous_day(DAU_DATE)
NEW_DEVICE_DATE = "2024-01-02"
GMV_DATE = "1998-10-03"
BATCH_CUTOFF = "2024-01-15 12:00:00"
ALERT_WINDOW = "1 day"
ALERT_SLIDE = "12 hours"
SEARCH_TEXT = "the and"
SEARCH_LANG = "en"
SALES_MONTH_START = "1998-10-01"
SALES_MONTH_DAYS = 31
SALES_KEYWORD = "ring"
SALES_PAGE, SALES_PAGE_SIZE = 2, 5
BALANCE_BANDS = [(None, 0, "negative"), (0, 5000, "0-5000"), (5000, None, "5000+")]
REGION_BAND_WIDTH = 4.0e7
DOC_BUCKETS = 16
USER_CHANGE = "1995-06-01 00:00:00"


def _events(spark, sf):
    return tb.table(spark, sf, "events")


# --- daily active devices -------------------------------------------------

def dau_first_of_day(spark: SparkSession, sf: str) -> DataFrame:
    """First startup record per device and day (in-batch dedup over the whole log)."""
    d = dedup.dedup_device_day(tb.startup_logs(_events(spark, sf)))
    return d.select("mid", "log_date", "log_hour", "event_id", "ts_ms")


def _dau_day(spark, sf, date, days=1):
    logs = tb.startup_logs(_events(spark, sf).where(on_days("ts", date, days)))
    return dedup.dedup_device_day(logs)


def dau_total(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.count_total(_dau_day(spark, sf, DAU_DATE), "dau")


def dau_hour(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.count_by_hour(_dau_day(spark, sf, DAU_DATE), "log_hour", "dau")


def new_devices(spark: SparkSession, sf: str) -> DataFrame:
    ev = _events(spark, sf).where(F.col("ts") < F.lit(f"{_next_day(NEW_DEVICE_DATE)} 00:00:00").cast("timestamp_ntz"))
    return dedup.new_devices_count(tb.startup_logs(ev), NEW_DEVICE_DATE, ts="ts")


def seen_anti(spark: SparkSession, sf: str) -> DataFrame:
    """One DAU micro-batch against the detail table: records after the cutoff, deduped per
    device-day, minus device-days already seen before the cutoff."""
    cut = F.lit(BATCH_CUTOFF).cast("timestamp_ntz")
    logs = tb.startup_logs(_events(spark, sf))
    batch = dedup.dedup_device_day(logs.where(F.col("ts") >= cut))
    seen = logs.where(F.col("ts") < cut).select("mid", "log_date").distinct()
    return dedup.drop_seen(batch, seen, ["mid", "log_date"]).select("mid", "log_date", "event_id", "ts_ms")


# --- GMV --------------------------------------------------------------------

def _purchases(spark, sf, date, days=1):
    ev = _events(spark, sf).where(on_days("ts", date, days) & (F.col("event_type") == F.lit(tb.EVENTS_COUPON)))
    return tb.startup_logs(ev)


def gmv_total(spark: SparkSession, sf: str) -> DataFrame:
    orders = tb.table(spark, sf, "orders").where(on_days("o_orderdate", GMV_DATE))
    return metrics.sum_total(orders, "o_totalprice", "order_amount")


def gmv_hour(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.sum_by_hour(_purchases(spark, sf, DAU_DATE), "log_hour", "value", "order_amount")


def order_mask(spark: SparkSession, sf: str) -> DataFrame:
    o = tb.order_info(tb.table(spark, sf, "orders"))
    return o.select("id", mask_phone("consignee_tel").alias("consignee_tel"),
                    create_date("create_time").alias("create_date"), create_hour("create_time").alias("create_hour"))


def order_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as JSON messages with quoted numbers, parsed back with string schema + try_cast."""
    msgs = to_json_messages(tb.order_info(tb.balanced(tb.table(spark, sf, "orders"))))
    good, _bad = parse_records(msgs, ORDER_INFO, ORDER_TYPES)
    return good.select("id", "user_id", "order_status", "total_amount", "create_time")


def cdc_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Change feed built from orders (status F = INSERT, else UPDATE) and customers
    (user_info INSERTs) -> keep order_info INSERTs -> JSON -> typed, masked order rows."""
    oi = tb.order_info(tb.balanced(tb.table(spark, sf, "orders")))
    et = F.when(F.col("order_status") == F.lit("F"), F.lit(cdc.INSERT)).otherwise(F.lit(cdc.UPDATE))
    feed = cdc.as_change_entries(oi, "order_info", et).unionByName(
        cdc.as_change_entries(tb.table(spark, sf, "customer").select("c_custkey", "c_name"), "user_info", cdc.INSERT)) \
        .unionByName(cdc.as_change_entries(oi, "order_info", cdc.INSERT, database="archive"))
    msgs = cdc.change_feed_messages(readers.subscribed(feed), "order_info", cdc.INSERT)
    good, _bad = parse_records(msgs, ORDER_INFO, ORDER_TYPES)
    return good.select("id", "user_id", "total_amount", mask_phone("consignee_tel").alias("consignee_tel"),
                       create_date("create_time").alias("create_date"),
                       create_hour("create_time").alias("create_hour"))


# --- dashboard shapes -------------------------------------------------------

def hour_compare(spark: SparkSession, sf: str) -> DataFrame:
    """DAU per hour, today vs yesterday, 24-hour spine, from one scan of both days."""
    d = _dau_day(spark, sf, DAU_PREV, days=2)
    return dashboard.hour_compare(spark, d, DAU_DATE, DAU_PREV, "log_date", "log_hour")


def hour_compare_gmv(spark: SparkSession, sf: str) -> DataFrame:
    p = _purchases(spark, sf, DAU_PREV, days=2)
    return dashboard.hour_compare(spark, p, DAU_DATE, DAU_PREV, "log_date", "log_hour", amount_col="value")


def _cards(spark, sf, keep_order=False):
    dau = metrics.count_total(_dau_day(spark, sf, NEW_DEVICE_DATE), "dau")
    ev = _events(spark, sf).where(F.col("ts") < F.lit(f"{_next_day(NEW_DEVICE_DATE)} 00:00:00").cast("timestamp_ntz"))
    new = dedup.new_devices_count(tb.startup_logs(ev), NEW_DEVICE_DATE, ts="ts")
    gmv = metrics.sum_total(_purchases(spark, sf, NEW_DEVICE_DATE), "value", "order_amount")
    return dashboard.metric_cards(dau, new, gmv, keep_order)


def metric_cards(spark: SparkSession, sf: str) -> DataFrame:
    return _cards(spark, sf)


def metric_cards_json(spark: SparkSession, sf: str) -> DataFrame:
    """The metric cards in their JSON list shape."""
    return dashboard.metric_cards_json(_cards(spark, sf, keep_order=True))


# --- coupon alert -----------------------------------------------------------

def _alerts(spark, sf):
    ev = tb.event_logs(_events(spark, sf))
    return A.coupon_alerts(ev, ALERT_WINDOW, coupon=tb.EVENTS_COUPON, click=tb.EVENTS_CLICK)


def coupon_alert(spark: SparkSession, sf: str) -> DataFrame:
    a = _alerts(spark, sf)
    return a.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "mid",
                    F.size("uids").cast("bigint").alias("n_uids"), F.array_join("uids", ",").alias("uids"),
                    F.size("itemIds").cast("bigint").alias("n_items"), "n_events", A.hist_text(F.col("events_hist")).alias("events"))


def alert_doc(spark: SparkSession, sf: str) -> DataFrame:
    docs = A.alert_documents(_alerts(spark, sf))
    return docs.select("id", "mid", F.size("uids").cast("bigint").alias("n_uids"),
                       F.array_join("itemIds", ",").alias("item_ids"),
                       A.hist_text(F.col("events")).alias("events"), "ts")


# --- search -----------------------------------------------------------------

def _query():
    return search.BoolQuery("text", SEARCH_TEXT, {"lang": SEARCH_LANG})


def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    docs = tb.table(spark, sf, "documents")
    return search.hits_page(docs, _query(), "doc_id", ["lang", "source", "n_chars"], 0, 10)


def search_hits_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The hits page from a stored index: every document is indexed with another text first, then with its own."""
    path = shared_dir(spark, "search-index")
    docs = tb.table(spark, sf, "documents")
    fields = ["lang", "source", "n_chars"]
    before = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat_ws(" ", "text", F.lit("and the and"))).otherwise(F.lit("the and")))
    search_index.index_documents(before, path, 0, "doc_id", "text", fields)
    search_index.index_documents(docs, path, 1, "doc_id", "text", fields)
    return search_index.indexed_hits(spark, path, _query(), "doc_id", fields)


def search_terms_max(spark: SparkSession, sf: str) -> DataFrame:
    return search.terms_buckets(tb.table(spark, sf, "documents"), _query(), "source", "n_chars", 10)


def search_total(spark: SparkSession, sf: str) -> DataFrame:
    return search.total_hits(tb.table(spark, sf, "documents"), _query())


# --- sales detail -----------------------------------------------------------

def sale_detail_page(spark: SparkSession, sf: str) -> DataFrame:
    detail = tb.sale_detail(tb.table(spark, sf, "lineitem"), tb.table(spark, sf, "orders"), tb.table(spark, sf, "part"))
    cond = on_days("order_ts", SALES_MONTH_START, SALES_MONTH_DAYS) & sales.keyword_match("sku_name", SALES_KEYWORD)
    page = sales.detail_page(detail, cond, ["order_id", "line_no"], SALES_PAGE, SALES_PAGE_SIZE)
    return page.select("order_id", "line_no", "user_id", "sku_id", "sku_name", "sku_num", "sku_price", "dt", "total")


def stat_balance_shares(spark: SparkSession, sf: str) -> DataFrame:
    cust = tb.table(spark, sf, "customer")
    return sales.shares(cust, sales.bucket_by("c_acctbal", BALANCE_BANDS))


def stat_segment_shares(spark: SparkSession, sf: str) -> DataFrame:
    cust = tb.table(spark, sf, "customer")
    return sales.shares(cust, F.col("c_mktsegment"))


def province_sales(spark: SparkSession, sf: str) -> DataFrame:
    return sales.region_sales(tb.table(spark, sf, "orders"), tb.table(spark, sf, "customer"),
                              tb.table(spark, sf, "nation"), REGION_BAND_WIDTH)


# --- SQL views, document index, JSON source/sink -------------------------------

def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    """Temp view + SQL string (Catalyst plans it like the DataFrame form)."""
    view = readers.register_view(_events(spark, sf), "rp_events")
    return spark.sql(f"SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM {view} GROUP BY event_type")


def doc_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed document index: index every document (batch 0), re-index the labelled ones with
    their labels (batch 1, same ids replace), then scan the latest version per id."""
    path = f"{shared_dir(spark, 'doc-index')}/documents"
    docs = tb.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang", "source",
                                                   "n_chars")
    first = docs.select("*", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    sinks.upsert_documents(first, path, 0, order_col="n_chars")
    labels = tb.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality", "toxic")
    sinks.upsert_documents(docs.join(labels, "id"), path, 1, order_col="n_chars")
    return readers.document_index(spark, path).select("id", "lang", "source", "n_chars", "quality", "toxic")


def doc_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The document index in hash buckets of the id: indexed, compacted, then the labelled documents replaced in the compacted table."""
    path = f"{shared_dir(spark, 'doc-buckets')}/documents"
    docs = tb.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang", "source", "n_chars")
    labels = tb.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality", "toxic")
    for n in range(2):  # every document is indexed twice
        sinks.upsert_documents(docs.select("*", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic")),
                               path, n, order_col="n_chars", buckets=DOC_BUCKETS)
    sinks.compact_documents(spark, path, f"{path}-compact", buckets=DOC_BUCKETS)
    sinks.upsert_documents(docs.join(labels, "id"), f"{path}-compact", 2, order_col="n_chars", buckets=DOC_BUCKETS)
    return readers.document_index(spark, f"{path}-compact").select("id", "lang", "source", "n_chars", "quality", "toxic")


def bulk_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """What became of each item of the second of two bulk writes: parts with an even key were there, and some are broken on purpose."""
    path = f"{shared_dir(spark, 'bulk-outcome')}/parts"
    key = F.col("p_partkey")
    parts = tb.table(spark, sf, "part").select(
        F.when(key % 11 == 0, F.concat(key.cast("string"), F.repeat(F.lit("x"), 512))).otherwise(key.cast("string")).alias("id"),
        F.when(key % 7 != 0, F.col("p_name")).alias("p_name"), "p_brand", "p_partkey")
    sinks.upsert_with_outcome(parts.where(key % 2 == 0).drop("p_partkey"), path, 0, required=["p_name"], buckets=DOC_BUCKETS)
    out = sinks.upsert_with_outcome(parts.drop("p_partkey"), path, 1, required=["p_name"], buckets=DOC_BUCKETS)
    return out.select(F.regexp_replace("id", "x+$", "").alias("id"), "status", "reason")


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON messages to the offline message sink, read back with an inferred schema."""
    path = f"{shared_dir(spark, 'json-messages')}/events"
    sinks.write_messages(to_json_messages(_events(spark, sf)), path)
    back = readers.json_lines(spark, path)
    return back.select("event_id", "user_id", "event_type", "value", "props")


def dau_hours_json(spark: SparkSession, sf: str) -> DataFrame:
    """Hour comparison in its JSON shape: sparse today/yesterday hour maps."""
    dashboard.check_metric("dau")
    d = _dau_day(spark, sf, DAU_PREV, days=2)
    per_hour = dashboard.hour_compare(spark, d, DAU_DATE, DAU_PREV, "log_date", "log_hour", fill_zero=False)
    return dashboard.hour_maps_json(per_hour)


def gmv_hours_json(spark: SparkSession, sf: str) -> DataFrame:
    """Hour comparison of order value in its JSON shape (metric id ``order_amount``)."""
    dashboard.check_metric("order_amount")
    p = _purchases(spark, sf, DAU_PREV, days=2)
    per_hour = dashboard.hour_compare(spark, p, DAU_DATE, DAU_PREV, "log_date", "log_hour", amount_col="value",
                                      fill_zero=False)
    return dashboard.hour_maps_json(per_hour, zero_is_missing=False)


def sale_detail_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Share of matching sale rows per customer segment (the detail page's stat block)."""
    detail = tb.sale_detail(tb.table(spark, sf, "lineitem"), tb.table(spark, sf, "orders"), tb.table(spark, sf, "part"))
    cond = on_days("order_ts", SALES_MONTH_START, SALES_MONTH_DAYS) & sales.keyword_match("sku_name", SALES_KEYWORD)
    cust = tb.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return sales.shares(detail.where(cond).join(cust, "user_id"), F.col("c_mktsegment"))


def detail_report(spark: SparkSession, sf: str) -> DataFrame:
    """The sales-detail page as one row: total, the age and gender statistics, and the page's rows with user columns."""
    parts = _report(spark, sf)
    # the page has a fixed size: it becomes one JSON list
    page = parts["detail"].agg(F.array_sort(F.collect_list(F.struct("order_id", "line_no", "user_id", "user_name", "user_gender", "user_age", "user_level", "sku_id", "sku_name"))).alias("d"))
    row = sales.statistics_row(parts["stat"], {"age": sales.AGE_LABELS, "gender": ["F", "M"]})
    return row.select("total", "stat", page.select(F.to_json("d")).scalar().alias("detail"))


def detail_stats(spark: SparkSession, sf: str) -> DataFrame:
    """All statistics of the sales-detail page with their percentages, and the total, from one aggregate."""
    return _report(spark, sf)["stat"]


def _report(spark, sf):
    detail = tb.sale_detail(tb.table(spark, sf, "lineitem"), tb.table(spark, sf, "orders"), tb.table(spark, sf, "part"))
    cond = on_days("order_ts", SALES_MONTH_START, SALES_MONTH_DAYS) & sales.keyword_match("sku_name", SALES_KEYWORD)
    groups = {"age": sales.bucket_by("user_age", sales.AGE_BANDS), "gender": F.col("user_gender")}
    return sales.report_parts(detail.where(cond), tb.users(tb.table(spark, sf, "customer")), SALES_PAGE, SALES_PAGE_SIZE,
                              ["order_id", "line_no"], "user_id", groups)


def coupon_alert_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Coupon alerts of one-day windows that start every 12 hours."""
    a = A.coupon_alerts(tb.event_logs(_events(spark, sf)), ALERT_WINDOW, ALERT_SLIDE, coupon=tb.EVENTS_COUPON, click=tb.EVENTS_CLICK)
    return a.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "mid",
                    F.size("uids").cast("bigint").alias("n_uids"), F.array_join("uids", ",").alias("uids"),
                    "n_events", A.hist_text(F.col("events_hist")).alias("events"))


def json_doc_index(spark: SparkSession, sf: str) -> DataFrame:
    """Raw JSON documents indexed by the id inside them, some again in a second batch, and scanned."""
    path = f"{shared_dir(spark, 'json-index')}/parts"
    raw = to_json_messages(tb.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name", "p_brand"))
    sinks.index_json(raw, path, 0)
    again = tb.table(spark, sf, "part").where(F.col("p_partkey") % 2 == 0)
    sinks.index_json(to_json_messages(again.select(F.col("p_partkey").cast("string").alias("id"), F.upper("p_name").alias("p_name"), "p_brand")), path, 1)
    doc = F.from_json("doc", "p_name string, p_brand string")
    return readers.document_index(spark, path).select("id", doc["p_name"].alias("p_name"), doc["p_brand"].alias("p_brand"))


def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """The (mid, first_date) table: the days before the cutoff, then extended by the rest."""
    logs = tb.startup_logs(_events(spark, sf))
    cut = F.lit(BATCH_CUTOFF).cast("timestamp_ntz")
    known = dedup.first_seen_dates(logs.where(F.col("ts") < cut), ts="ts")
    return dedup.extend_first_seen(known, logs.where(F.col("ts") >= cut))


def view_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """A view that is created only if absent: a second registration of the name leaves it as it is."""
    spark.catalog.dropTempView("rp_orders_once")
    view = readers.register_view(tb.table(spark, sf, "orders"), "rp_orders_once", replace=False)
    readers.register_view(tb.table(spark, sf, "orders").limit(0), view, replace=False)
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {view} GROUP BY o_orderstatus")


def _next_day(date: str) -> str:
    from retail_pulse.functions.time import day_bounds
    return day_bounds(date)[1].strftime("%Y-%m-%d")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dau_first_of_day": dau_first_of_day,
    "dau_total": dau_total,
    "dau_hour": dau_hour,
    "new_devices": new_devices,
    "seen_anti": seen_anti,
    "gmv_total": gmv_total,
    "gmv_hour": gmv_hour,
    "order_mask": order_mask,
    "order_parse": order_parse,
    "cdc_orders": cdc_orders,
    "hour_compare": hour_compare,
    "hour_compare_gmv": hour_compare_gmv,
    "metric_cards": metric_cards,
    "metric_cards_json": metric_cards_json,
    "coupon_alert": coupon_alert,
    "alert_doc": alert_doc,
    "search_hits": search_hits,
    "search_hits_indexed": search_hits_indexed,
    "search_terms_max": search_terms_max,
    "search_total": search_total,
    "sale_detail_page": sale_detail_page,
    "stat_balance_shares": stat_balance_shares,
    "stat_segment_shares": stat_segment_shares,
    "province_sales": province_sales,
    "sale_detail_stats": sale_detail_stats,
    "sql_view": sql_view,
    "doc_upsert": doc_upsert,
    "doc_buckets": doc_buckets,
    "bulk_outcome": bulk_outcome,
    "json_roundtrip": json_roundtrip,
    "dau_hours_json": dau_hours_json,
    "gmv_hours_json": gmv_hours_json,
    "detail_report": detail_report,
    "detail_stats": detail_stats,
    "coupon_alert_sliding": coupon_alert_sliding,
    "json_doc_index": json_doc_index,
    "first_seen": first_seen,
    "view_if_absent": view_if_absent,
}
