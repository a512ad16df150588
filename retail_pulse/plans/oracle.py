"""DuckDB SQL equivalents of the named queries (same parameters, same column names).

Tables are the warehouse views ``events orders lineitem part customer nation
documents ...``. Timestamps are naive (UTC wall clock) on both sides.
"""

from __future__ import annotations

from retail_pulse.operators import sales
from retail_pulse.plans import queries as Q

_D = "strftime(ts, '%Y-%m-%d')"
_H = "strftime(ts, '%H')"
_TOK = ("list_filter(regexp_split_to_array(regexp_replace(lower(text), '(\\p{Han})', ' \\1 ', 'g'), "
        "'[^\\p{L}\\p{N}]+'), lambda x: x <> '')")


def _next(d: str) -> str:
    return Q._next_day(d)


def _day(col: str, d: str, days: int = 1) -> str:
    from retail_pulse.functions.time import day_bounds
    lo, hi = day_bounds(d, days)
    return f"{col} >= TIMESTAMP '{lo:%Y-%m-%d %H:%M:%S}' AND {col} < TIMESTAMP '{hi:%Y-%m-%d %H:%M:%S}'"


def _dedup(where: str = "TRUE") -> str:
    return f"""SELECT * FROM (
  SELECT user_id AS mid, {_D} AS log_date, {_H} AS log_hour, event_id, epoch_us(ts) // 1000 AS ts_ms, event_type, value,
         row_number() OVER (PARTITION BY user_id, {_D} ORDER BY ts, event_id) AS rn
  FROM events WHERE {where}) WHERE rn = 1"""


def _new_devices(d: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE f = '{d}')::BIGINT AS new_mid FROM (
  SELECT user_id, min({_D}) AS f FROM events WHERE ts < TIMESTAMP '{_next(d)} 00:00:00' GROUP BY user_id)"""


def _alert_base(windowed: str = "SELECT *, date_trunc('day', ts) AS ws FROM events") -> str:
    return f"""WITH e AS (
  SELECT json_extract_string(props, '$.k') AS mid, CAST(user_id AS VARCHAR) AS uid, event_type AS evid,
         CAST(NULL AS VARCHAR) AS itemid, ws FROM ({windowed})),
t AS (SELECT ws, mid, evid, count(*) AS n FROM e GROUP BY ws, mid, evid),
h AS (SELECT ws, mid, string_agg(evid || ':' || CAST(n AS VARCHAR), ',' ORDER BY evid) AS hist,
             sum(n)::BIGINT AS n_events, bool_or(evid = 'click') AS clicked FROM t GROUP BY ws, mid),
c AS (SELECT ws, mid, list_sort(coalesce(list(DISTINCT uid) FILTER (WHERE uid IS NOT NULL), []::VARCHAR[])) AS uids,
             list_sort(coalesce(list(DISTINCT itemid) FILTER (WHERE itemid IS NOT NULL), []::VARCHAR[])) AS items
      FROM e WHERE evid = 'purchase' GROUP BY ws, mid),
a AS (SELECT h.ws, h.mid, c.uids, c.items, h.hist, h.n_events
      FROM h JOIN c ON h.ws = c.ws AND h.mid IS NOT DISTINCT FROM c.mid
      WHERE len(c.uids) >= 3 AND NOT h.clicked)
"""


def _search_base() -> str:
    return f"""WITH d AS (SELECT doc_id, lang, source, n_chars, {_TOK} AS tok FROM documents),
s AS (SELECT doc_id, lang, source, n_chars, len(tok) AS dl,
             len(list_filter(tok, lambda x: x = 'the')) AS tf0, len(list_filter(tok, lambda x: x = 'and')) AS tf1 FROM d),
m AS (SELECT * FROM s WHERE lang = 'en' AND (tf0 > 0 OR tf1 > 0))
"""


def _sales_detail() -> str:
    return f"""SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_custkey AS user_id,
       l.l_partkey AS sku_id, p.p_name AS sku_name, l.l_quantity AS sku_num, l.l_extendedprice AS sku_price,
       strftime(o.o_orderdate, '%Y-%m-%d') AS dt
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE {_day('o.o_orderdate', Q.SALES_MONTH_START, Q.SALES_MONTH_DAYS)}
  AND list_contains(list_filter(regexp_split_to_array(lower(p.p_name), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''), '{Q.SALES_KEYWORD}')"""


def _report() -> str:
    young, middle, old = sales.AGE_LABELS
    return f"""d AS ({_sales_detail()}),
j AS (SELECT d.*, c_name AS user_name, c_mktsegment AS user_level, CASE WHEN c_custkey % 2 = 0 THEN 'F' WHEN c_custkey % 2 = 1 THEN 'M' END AS user_gender,
             CAST(16 + c_custkey % 30 AS INTEGER) AS user_age FROM d LEFT JOIN customer c ON d.user_id = c.c_custkey),
g AS (SELECT 'age' AS stat, name, min(pos) AS pos, count(*)::BIGINT AS value FROM (
        SELECT CASE WHEN user_age < 20 THEN '{young}' WHEN user_age < 30 THEN '{middle}' WHEN user_age >= 30 THEN '{old}' END AS name,
               CASE WHEN user_age < 20 THEN '0' WHEN user_age < 30 THEN '1' ELSE '2' END AS pos FROM j) GROUP BY name
      UNION ALL SELECT 'gender', user_gender, any_value(user_gender), count(*)::BIGINT FROM j GROUP BY user_gender)"""


def _shares(group_sql: str) -> str:
    return f"""WITH g AS (SELECT {group_sql} AS name, count(*)::BIGINT AS value FROM customer GROUP BY 1)
SELECT name, value, round(100.0::DOUBLE * value::DOUBLE / (SELECT count(*) FROM customer)::DOUBLE, 4) AS percent FROM g"""


def oracle_sql() -> dict[str, str]:
    bal_case = ("CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal >= 0 AND c_acctbal < 5000 THEN '0-5000' "
                "WHEN c_acctbal >= 5000 THEN '5000+' END")
    out = {
        "dau_first_of_day": f"SELECT mid, log_date, log_hour, event_id, ts_ms FROM ({_dedup()})",
        "dau_total": f"SELECT count(*)::BIGINT AS dau FROM ({_dedup(_day('ts', Q.DAU_DATE))})",
        "dau_hour": f"SELECT log_hour AS hour, count(*)::BIGINT AS dau FROM ({_dedup(_day('ts', Q.DAU_DATE))}) GROUP BY log_hour",
        "new_devices": _new_devices(Q.NEW_DEVICE_DATE),
        "seen_anti": f"""WITH b AS ({_dedup(f"ts >= TIMESTAMP '{Q.BATCH_CUTOFF}'")}),
h AS (SELECT DISTINCT user_id AS mid, {_D} AS log_date FROM events WHERE ts < TIMESTAMP '{Q.BATCH_CUTOFF}')
SELECT mid, log_date, event_id, ts_ms FROM b
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.mid = b.mid AND h.log_date = b.log_date)""",
        "gmv_total": f"SELECT round(sum(o_totalprice)::DOUBLE, 2) AS order_amount FROM orders WHERE {_day('o_orderdate', Q.GMV_DATE)}",
        "gmv_hour": f"""SELECT {_H} AS hour, round(sum(value)::DOUBLE, 2) AS order_amount FROM events
WHERE {_day('ts', Q.DAU_DATE)} AND event_type = 'purchase' GROUP BY 1""",
        "order_mask": """SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN length(t) >= 11 THEN substr(t, 1, 3) || '****' || substr(t, 8, 4) ELSE '****' END AS consignee_tel,
  strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour
FROM (SELECT *, '1' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS t FROM orders)""",
        "order_parse": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  o_orderstatus AS order_status, o_totalprice AS total_amount,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time FROM orders""",
        "cdc_orders": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  o_totalprice AS total_amount,
  CASE WHEN length(t) >= 11 THEN substr(t, 1, 3) || '****' || substr(t, 8, 4) ELSE '****' END AS consignee_tel,
  strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour
FROM (SELECT *, '1' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS t FROM orders) WHERE o_orderstatus = 'F'""",
        "hour_compare": f"""WITH d AS ({_dedup(_day('ts', Q.DAU_PREV, 2))}),
p AS (SELECT log_hour AS hour, count(*) FILTER (WHERE log_date = '{Q.DAU_DATE}') AS today,
             count(*) FILTER (WHERE log_date = '{Q.DAU_PREV}') AS yesterday FROM d GROUP BY log_hour),
s AS (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hour FROM range(24))
SELECT s.hour AS hour, coalesce(p.today, 0)::BIGINT AS today, coalesce(p.yesterday, 0)::BIGINT AS yesterday
FROM s LEFT JOIN p ON s.hour = p.hour""",
        "hour_compare_gmv": f"""WITH p AS (SELECT {_H} AS hour,
    round(sum(value) FILTER (WHERE {_D} = '{Q.DAU_DATE}')::DOUBLE, 2) AS today,
    round(sum(value) FILTER (WHERE {_D} = '{Q.DAU_PREV}')::DOUBLE, 2) AS yesterday
  FROM events WHERE {_day('ts', Q.DAU_PREV, 2)} AND event_type = 'purchase' GROUP BY 1),
s AS (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hour FROM range(24))
SELECT s.hour AS hour, coalesce(p.today, 0.0)::DOUBLE AS today, coalesce(p.yesterday, 0.0)::DOUBLE AS yesterday
FROM s LEFT JOIN p ON s.hour = p.hour""",
        "metric_cards": f"""SELECT 'dau' AS id, '新增日活' AS name,
  (SELECT count(*) FROM ({_dedup(_day('ts', Q.NEW_DEVICE_DATE))}))::DOUBLE AS value
UNION ALL SELECT 'new_mid', '新增设备', (SELECT new_mid FROM ({_new_devices(Q.NEW_DEVICE_DATE)}))::DOUBLE
UNION ALL SELECT 'order_amount', '新增交易额',
  (SELECT round(sum(value)::DOUBLE, 2) FROM events WHERE {_day('ts', Q.NEW_DEVICE_DATE)} AND event_type = 'purchase')::DOUBLE""",
        "metric_cards_json": f"""WITH v AS (
  SELECT (SELECT count(*) FROM ({_dedup(_day('ts', Q.NEW_DEVICE_DATE))})) AS dau,
         (SELECT new_mid FROM ({_new_devices(Q.NEW_DEVICE_DATE)})) AS new_mid,
         (SELECT round(sum(value)::DOUBLE, 2) FROM events
          WHERE {_day('ts', Q.NEW_DEVICE_DATE)} AND event_type = 'purchase')::DOUBLE AS gmv)
SELECT '[{{"id":"dau","name":"新增日活","value":' || CAST(dau AS VARCHAR)
    || '}},{{"id":"new_mid","name":"新增设备","value":' || CAST(new_mid AS VARCHAR)
    || '}},{{"id":"order_amount","name":"新增交易额"' || coalesce(',"value":' || CAST(gmv AS VARCHAR), '')
    || '}}]' AS json FROM v""",
        "coupon_alert": _alert_base() + """SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, mid,
  len(uids)::BIGINT AS n_uids, array_to_string(uids, ',') AS uids, len(items)::BIGINT AS n_items,
  n_events, hist AS events FROM a""",
        "alert_doc": _alert_base() + """SELECT mid || CAST((epoch_us(ws + INTERVAL 1 DAY) // 1000) // 60000 AS VARCHAR) AS id, mid,
  len(uids)::BIGINT AS n_uids, array_to_string(items, ',') AS item_ids, hist AS events,
  epoch_us(ws + INTERVAL 1 DAY) // 1000 AS ts FROM a""",
        "dau_stream": f"SELECT mid, log_date, log_hour, event_id, ts_ms FROM ({_dedup()})",
        "startup_stream": f"""SELECT DISTINCT mid, log_date, log_hour, ts_ms FROM (
  SELECT user_id AS mid, strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour,
         epoch_us(ts) // 1000 AS ts_ms,
         min(epoch_us(ts) // 1000) OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d')) AS first_ms
  FROM events) WHERE ts_ms = first_ms""",
        "alert_stream": _alert_base() + """SELECT mid || CAST((epoch_us(ws + INTERVAL 1 DAY) // 1000) // 60000 AS VARCHAR) AS id, mid,
  len(uids)::BIGINT AS n_uids, array_to_string(items, ',') AS item_ids, hist AS events,
  epoch_us(ws + INTERVAL 1 DAY) // 1000 AS ts FROM a""",
        "alert_live": _alert_base() + """SELECT mid || CAST((epoch_us(ws + INTERVAL 1 DAY) // 1000) // 60000 AS VARCHAR) AS id, mid,
  len(uids)::BIGINT AS n_uids, n_events, epoch_us(ws + INTERVAL 1 DAY) // 1000 AS ts FROM a""",
        "dau_table_total": f"SELECT count(*)::BIGINT AS dau FROM ({_dedup(_day('ts', Q.DAU_DATE))})",
        "dau_table_hour": f"SELECT log_hour AS hour, count(*)::BIGINT AS dau FROM ({_dedup(_day('ts', Q.DAU_DATE))}) GROUP BY log_hour",
        # the replay's batches are four time slices of equal width
        "dau_batch_counts": f"""WITH e AS (SELECT user_id, {_D} AS d, epoch_us(ts) AS us FROM events),
b AS (SELECT min(us) AS lo, (max(us) - min(us)) / 4.0::DOUBLE AS step FROM e),
s AS (SELECT user_id, d, (us >= CAST(floor(lo + step) AS BIGINT))::INT + (us >= CAST(floor(lo + 2 * step) AS BIGINT))::INT
             + (us >= CAST(floor(lo + 3 * step) AS BIGINT))::INT AS slice FROM e, b)
SELECT (SELECT count(*) FROM events)::BIGINT AS raw, (SELECT count(*) FROM (SELECT DISTINCT slice, user_id, d FROM s))::BIGINT AS in_batch,
  (SELECT count(*) FROM ({_dedup()}))::BIGINT AS new""",
        "startup_quarantine": """SELECT CASE event_id % 10 WHEN 1 THEN 'bad_number' WHEN 2 THEN 'bad_time' WHEN 3 THEN 'missing_ts'
  WHEN 4 THEN 'missing_mid' ELSE 'malformed_json' END AS reason, count(*)::BIGINT AS n
FROM events WHERE event_id % 10 BETWEEN 1 AND 5 GROUP BY 1""",
        "order_table_keyed": """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total_amount,
  strftime(o_orderdate, '%Y-%m-%d') AS create_date FROM orders""",
        "gmv_table_total": f"SELECT round(sum(o_totalprice)::DOUBLE, 2) AS order_amount FROM orders WHERE {_day('o_orderdate', Q.GMV_DATE)}",
        "gmv_table_hour": f"""SELECT strftime(o_orderdate, '%H') AS hour, round(sum(o_totalprice)::DOUBLE, 2) AS order_amount
FROM orders WHERE {_day('o_orderdate', Q.GMV_DATE)} GROUP BY 1""",
        "gmv_stream": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  o_totalprice AS total_amount,
  CASE WHEN length(t) >= 11 THEN substr(t, 1, 3) || '****' || substr(t, 8, 4) ELSE '****' END AS consignee_tel,
  strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour
FROM (SELECT *, '1' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS t FROM orders) WHERE o_orderstatus = 'F'""",
        "sale_detail_stream": f"""SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_custkey AS user_id,
  l.l_partkey AS sku_id, p.p_name AS sku_name, l.l_quantity AS sku_num, l.l_extendedprice AS sku_price,
  strftime(o.o_orderdate, '%Y-%m-%d') AS dt, c_name AS user_name,
  CASE WHEN c_custkey % 3 = 0 AND o_orderdate >= TIMESTAMP '{Q.USER_CHANGE}' THEN lower(c_mktsegment) ELSE c_mktsegment END AS user_level,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' WHEN c_custkey % 2 = 1 THEN 'M' END AS user_gender, CAST(16 + c_custkey % 30 AS INTEGER) AS user_age
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN customer ON o_custkey = c_custkey""",
        "sale_unmatched": """SELECT CASE WHEN l_orderkey % 7 = 0 THEN 'no_order' ELSE 'no_sku' END AS reason, count(*)::BIGINT AS n
FROM lineitem WHERE l_orderkey % 7 = 0 OR l_partkey % 5 = 0 GROUP BY 1""",
        "search_hits": _search_base() + """, st AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS avgdl,
  count(*) FILTER (WHERE tf0 > 0)::DOUBLE AS df0, count(*) FILTER (WHERE tf1 > 0)::DOUBLE AS df1 FROM s)
SELECT doc_id, round(
   ln(1 + (n - df0 + 0.5) / (df0 + 0.5)) * tf0 * 2.2 / (tf0 + 1.2 * (0.25 + 0.75 * dl / avgdl))
 + ln(1 + (n - df1 + 0.5) / (df1 + 0.5)) * tf1 * 2.2 / (tf1 + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score,
  lang, source, n_chars
FROM m, st ORDER BY score DESC, doc_id LIMIT 10""",
        "search_terms_max": _search_base() + """SELECT source, count(*)::BIGINT AS doc_count, max(n_chars) AS max_n_chars
FROM m GROUP BY source ORDER BY doc_count DESC, source LIMIT 10""",
        "search_total": _search_base() + "SELECT count(*)::BIGINT AS total FROM m",
        "sale_detail_page": f"""WITH d AS ({_sales_detail()})
SELECT *, (SELECT count(*) FROM d)::BIGINT AS total FROM d ORDER BY order_id, line_no
LIMIT {Q.SALES_PAGE_SIZE} OFFSET {(Q.SALES_PAGE - 1) * Q.SALES_PAGE_SIZE}""",
        "stat_balance_shares": _shares(bal_case),
        "stat_segment_shares": _shares("c_mktsegment"),
        "sale_detail_stats": f"""WITH d AS ({_sales_detail()}),
j AS (SELECT c.c_mktsegment FROM d JOIN customer c ON d.user_id = c.c_custkey),
g AS (SELECT c_mktsegment AS name, count(*)::BIGINT AS value FROM j GROUP BY 1)
SELECT name, value, round(100.0::DOUBLE * value::DOUBLE / (SELECT count(*) FROM j)::DOUBLE, 4) AS percent FROM g""",
        "sql_view": "SELECT event_type, count(*)::BIGINT AS n, round(sum(value), 2) AS value FROM events GROUP BY event_type",
        "doc_upsert": """SELECT CAST(d.doc_id AS VARCHAR) AS id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "bulk_outcome": """SELECT CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_partkey % 11 = 0 OR p_partkey % 7 = 0 THEN 'rejected' WHEN p_partkey % 2 = 0 THEN 'replaced' ELSE 'created' END AS status,
  CASE WHEN p_partkey % 11 = 0 THEN 'id_too_long' WHEN p_partkey % 7 = 0 THEN 'missing_p_name' END AS reason FROM part""",
        "json_roundtrip": "SELECT event_id, user_id, event_type, value, props FROM events",
        "dau_hours_json": f"""WITH d AS ({_dedup(_day('ts', Q.DAU_PREV, 2))}),
p AS (SELECT log_hour AS hour, count(*) FILTER (WHERE log_date = '{Q.DAU_DATE}') AS today,
             count(*) FILTER (WHERE log_date = '{Q.DAU_PREV}') AS yesterday FROM d GROUP BY log_hour)
SELECT '{{"today":' || coalesce((SELECT '{{' || string_agg('"' || hour || '":' || today, ',' ORDER BY hour) || '}}'
                                 FROM p WHERE today <> 0), '{{}}')
    || ',"yesterday":' || coalesce((SELECT '{{' || string_agg('"' || hour || '":' || yesterday, ',' ORDER BY hour) || '}}'
                                 FROM p WHERE yesterday <> 0), '{{}}') || '}}' AS json""",
        "gmv_hours_json": f"""WITH p AS (SELECT {_H} AS hour,
    round(sum(value) FILTER (WHERE {_D} = '{Q.DAU_DATE}')::DOUBLE, 2) AS today,
    round(sum(value) FILTER (WHERE {_D} = '{Q.DAU_PREV}')::DOUBLE, 2) AS yesterday
  FROM events WHERE {_day('ts', Q.DAU_PREV, 2)} AND event_type = 'purchase' GROUP BY 1)
SELECT '{{"today":' || coalesce((SELECT '{{' || string_agg('"' || hour || '":' || CAST(today AS VARCHAR), ',' ORDER BY hour) || '}}'
                                 FROM p WHERE today IS NOT NULL), '{{}}')
    || ',"yesterday":' || coalesce((SELECT '{{' || string_agg('"' || hour || '":' || CAST(yesterday AS VARCHAR), ',' ORDER BY hour) || '}}'
                                 FROM p WHERE yesterday IS NOT NULL), '{{}}') || '}}' AS json""",
        "detail_report": f"""WITH {_report()},
pg AS (SELECT * FROM j ORDER BY order_id, line_no LIMIT {Q.SALES_PAGE_SIZE} OFFSET {(Q.SALES_PAGE - 1) * Q.SALES_PAGE_SIZE})
SELECT (SELECT count(*) FROM j)::BIGINT AS total,
  (SELECT CAST(to_json(list({{'group': stat, 'options': options}} ORDER BY stat)) AS VARCHAR) FROM (
     SELECT s.stat, coalesce(list({{'name': name, 'value': value}} ORDER BY pos) FILTER (WHERE value IS NOT NULL), []) AS options
     FROM (VALUES ('age'), ('gender')) s(stat) LEFT JOIN g ON g.stat = s.stat AND g.name IS NOT NULL GROUP BY s.stat)) AS stat,
  coalesce((SELECT CAST(to_json(list({{'order_id': order_id, 'line_no': line_no, 'user_id': user_id, 'user_name': user_name,
                                       'user_gender': user_gender, 'user_age': user_age,
                                       'user_level': user_level, 'sku_id': sku_id, 'sku_name': sku_name}} ORDER BY order_id, line_no)) AS VARCHAR)
            FROM pg), '[]') AS detail""",
        "detail_stats": f"""WITH {_report()}
SELECT stat, name, value, round(100.0::DOUBLE * value::DOUBLE / (SELECT count(*) FROM j)::DOUBLE, 4) AS percent FROM g
UNION ALL SELECT NULL, NULL, count(*)::BIGINT, 100.0::DOUBLE FROM j HAVING count(*) > 0""",
        "coupon_alert_sliding": _alert_base("""SELECT unnest([s, s - INTERVAL 12 HOUR]) AS ws, * FROM (
    SELECT *, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01') AS s FROM events)""") + """SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, mid,
  len(uids)::BIGINT AS n_uids, array_to_string(uids, ',') AS uids, n_events, hist AS events FROM a""",
        "json_doc_index": """SELECT CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS p_name, p_brand FROM part""",
        "first_seen": f"SELECT user_id AS mid, min({_D}) AS first_date FROM events GROUP BY user_id",
        "view_if_absent": "SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders GROUP BY o_orderstatus",
        "province_sales": f"""WITH c AS (SELECT c_nationkey AS n_nationkey, sum(o_totalprice) AS amt, count(*)::BIGINT AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
SELECT c.n_nationkey, n.n_name, round(amt, 2) AS order_amount, n_orders,
  least(floor(amt / {Q.REGION_BAND_WIDTH}), 5)::BIGINT AS band
FROM c JOIN nation n ON c.n_nationkey = n.n_nationkey""",
    }
    # the same answers, kept up by streaming jobs
    for job, batch in {"dau_state_stream": "dau_first_of_day", "first_seen_stream": "first_seen", "metric_cards_table": "metric_cards",
                       "alert_sliding_stream": "coupon_alert_sliding", "sale_recovered": "sale_detail_stream", "doc_buckets": "doc_upsert",
                       "search_hits_indexed": "search_hits"}.items():
        out[job] = out[batch]
    return out
