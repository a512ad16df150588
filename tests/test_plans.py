"""Plan-shape checks for the scale properties the operators rely on."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from retail_pulse.streaming.jobs import STREAM_QUERIES
from retail_pulse.plans import queries as Q

SF = "/root/testdata/sf0.001"


def plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_dedup_limits_rows_before_the_shuffle(spark):
    p = plan(Q.dau_first_of_day(spark, SF))
    partial = p.index("WindowGroupLimit")
    assert "Partial" in p and "Final" in p
    # the last (lowest) WindowGroupLimit in the tree is the partial one, below the exchange
    lines = p.splitlines()
    wgl = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l]
    exch = [i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l]
    assert partial >= 0 and "Partial" in lines[wgl[-1]] and wgl[-1] > exch[0]


def test_day_filter_reaches_the_scan(spark):
    p = plan(Q.dau_total(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_json_parsed_once_per_message(spark):
    p = plan(Q.order_parse(spark, SF))
    assert p.count("from_json(") == 1


def test_orders_pre_aggregated_before_customer_join(spark):
    p = plan(Q.province_sales(spark, SF))
    lines = p.splitlines()
    join = next(i for i, l in enumerate(lines) if "Join" in l and "c_custkey" in l)
    agg = next(i for i, l in enumerate(lines) if "HashAggregate(keys=[o_custkey#" in l)
    assert agg > join  # below the join in the tree


def test_tokenizer_runs_after_the_spreading_exchange(spark):
    p = plan(Q.search_total(spark, SF))
    lines = p.splitlines()
    tok = max(i for i, l in enumerate(lines) if "regexp_replace" in l)
    rr = [i for i, l in enumerate(lines) if "RoundRobinPartitioning" in l]
    if rr:  # present when the scan has fewer splits than cores
        assert tok < rr[0]


Q_SCHEMA = "mid string, log_date string, _batch_id long"


def test_alert_profile_is_partially_aggregated(spark):
    p = plan(Q.coupon_alert(spark, SF))
    assert "partial_collect_set" in p and "partial_count" in p
    assert "collect_list(evid" not in p  # no per-row event list
    assert "array_repeat" not in plan(Q.alert_doc(spark, SF))  # documents keep the bounded histogram


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if n not in STREAM_QUERIES])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_sales_filters_reach_their_scans(spark):
    from retail_pulse.functions.time import on_days
    from retail_pulse.operators import sales
    detail = Q.tb.sale_detail(*(Q.tb.table(spark, SF, t) for t in ("lineitem", "orders", "part")))
    cond = on_days("order_ts", Q.SALES_MONTH_START, Q.SALES_MONTH_DAYS) & sales.keyword_match("sku_name", Q.SALES_KEYWORD)
    p = plan(sales.detail_page(detail, cond, ["order_id", "line_no"], with_total=False))
    assert p.count("l_orderkey") and sum("FileScan parquet" in line and "l_orderkey" in line for line in p.splitlines()) == 1
    orders_scan = next(line for line in p.splitlines() if "FileScan parquet" in line and "o_orderdate" in line)
    assert "GreaterThanOrEqual(o_orderdate" in orders_scan  # month range pushed into the orders scan
    part_scan = next(line for line in p.splitlines() if "FileScan parquet" in line and "p_name" in line)
    assert "array_contains" in part_scan  # keyword match evaluated at the part scan, before the join
    assert "TakeOrderedAndProject" in p  # the page is a top-k, not a full sort


def test_totals_do_not_read_the_input_again(spark):
    def scans(p, col):
        return sum("FileScan parquet" in line and col in line for line in p.splitlines())
    assert scans(plan(Q.stat_segment_shares(spark, SF)), "c_mktsegment") == 1
    assert scans(plan(Q.sale_detail_page(spark, SF)), "l_extendedprice") == 0  # page and total read the written rows
    assert "SortAggregate" not in plan(Q.new_devices(spark, SF))


def test_alert_rule_comes_before_the_lists(spark):
    p = plan(Q.coupon_alert(spark, SF))
    first_join = min(i for i, line in enumerate(p.splitlines()) if "LeftSemi" in line)
    lists = [i for i, line in enumerate(p.splitlines()) if "collect_set" in line]
    assert lists and max(lists) < first_join or all("collect_set" not in line for line in p.splitlines()[first_join:])


def test_served_days_prune_folders(spark, tmp_dir):
    from retail_pulse.sources.readers import detail_table
    from retail_pulse.sources.sinks import write_batch_partition
    df = spark.createDataFrame([("m", f"2024-01-0{d}") for d in range(1, 5)], "mid string, log_date string")
    write_batch_partition(df, f"{tmp_dir}/d", 0, ["log_date"])
    t = detail_table(spark, f"{tmp_dir}/d", "log_date", ["2024-01-02"], Q_SCHEMA)
    assert "log_date" in plan(t).split("PartitionFilters")[1][:120] and dict(t.dtypes)["log_date"] == "string" and t.count() == 1


def test_search_page_is_top_k(spark):
    p = plan(Q.search_hits(spark, SF))
    assert "TakeOrderedAndProject" in p
