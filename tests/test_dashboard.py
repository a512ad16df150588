import pytest

from retail_pulse.operators.dashboard import check_metric, hour_compare, metric_cards
from retail_pulse.operators.metrics import count_by_hour, sum_by_hour, sum_total


def test_missing_hours_sparse_and_spine(spark):
    df = spark.createDataFrame([("2024-01-02", "09", 5.0)], "create_date string, create_hour string, amt double")
    assert sum_by_hour(df, "create_hour", "amt").count() == 1
    rows = hour_compare(spark, df, "2024-01-02", "2024-01-01", "create_date", "create_hour", "amt").collect()
    assert len(rows) == 24
    assert sum(1 for r in rows if r.today == 0.0) == 23
    assert [r.today for r in rows if r.hour == "09"] == [5.0]
    assert all(r.yesterday == 0.0 for r in rows)


def test_no_orders_sum_null_count_zero(spark):
    df = spark.createDataFrame([], "total_amount double, log_hour string")
    assert sum_total(df).first().order_amount is None
    assert count_by_hour(df).count() == 0


def test_unknown_metric_raises():
    with pytest.raises(ValueError):
        check_metric("foo")
    assert check_metric("dau") == "dau"


def test_metric_cards_shape(spark):
    one = spark.createDataFrame([(3,)], "v long")
    none = spark.createDataFrame([(None,)], "v double")
    rows = metric_cards(one, one, none).collect()
    assert [(r.id, r.value) for r in rows] == [("dau", 3.0), ("new_mid", 3.0), ("order_amount", None)]
    assert rows[0].name == "新增日活"


def test_detail_report_parts(spark):
    from pyspark.sql import functions as F

    from retail_pulse.operators.sales import AGE_BANDS, bucket_by, detail_report
    detail = spark.createDataFrame(
        [(1, 1, 10, "small ring", "2019-03-04"), (2, 1, 11, "red ring", "2019-03-04"),
         (3, 1, 10, "blue bolt", "2019-03-04"), (4, 1, 12, "old ring", "2019-03-05")],
        "order_id long, line_no int, user_id long, sku_name string, dt string")
    users = spark.createDataFrame([(10, "M", 19), (11, "F", 33), (12, "F", 25)],
                                  "user_id long, gender string, age int")
    age = AGE_BANDS
    rep = detail_report(detail, users, keyword="ring", page=1, size=1, order_cols=["order_id"],
                        stat_groups={"gender": F.col("gender"), "age": bucket_by("age", age)})
    assert rep["total"].first().total == 2
    assert [r.order_id for r in rep["detail"].collect()] == [1]
    stat = {(r.stat, r.name): (r.value, r.percent) for r in rep["stat"].collect()}
    assert stat == {(None, None): (2, 100.0), ("age", "20岁以下"): (1, 50.0), ("age", "30岁以上"): (1, 50.0), ("gender", "M"): (1, 50.0), ("gender", "F"): (1, 50.0)}


def test_statistics_come_from_one_aggregate(spark):
    import json

    from pyspark.sql import functions as F

    from retail_pulse.operators.sales import AGE_BANDS, AGE_LABELS, bucket_by, statistics, statistics_row
    rows = spark.createDataFrame([("M", 19), ("M", 19), ("F", 33), (None, 25), ("F", None)], "gender string, age int")
    groups = {"age": bucket_by("age", AGE_BANDS), "gender": F.col("gender")}
    stats = statistics(rows, groups)
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate ") == 1 and plan.count("Expand ") == 1 and "collect_list" not in plan
    got = {(r.stat, r.name): (r.value, r.percent) for r in stats.collect()}
    # a NULL value of a group is a row of that group, not the total
    assert got == {(None, None): (5, 100.0), ("age", AGE_LABELS[0]): (2, 40.0), ("age", AGE_LABELS[1]): (1, 20.0), ("age", AGE_LABELS[2]): (1, 20.0),
                   ("age", None): (1, 20.0), ("gender", "M"): (2, 40.0), ("gender", "F"): (2, 40.0), ("gender", None): (1, 20.0)}
    row = statistics_row(stats, {"age": AGE_LABELS, "gender": ["F", "M", "X"]}).first()
    assert row.total == 5 and json.loads(row.stat) == [
        {"group": "age", "options": [{"name": n, "value": v} for n, v in zip(AGE_LABELS, (2, 1, 1))]},
        {"group": "gender", "options": [{"name": "F", "value": 2}, {"name": "M", "value": 2}]}]
    none = statistics(rows.limit(0), groups)
    assert none.collect() == [] and statistics_row(none, {"gender": ["F"]}).first().total == 0


def test_metric_cards_json_omits_null_values(spark):
    import json

    from retail_pulse.operators.dashboard import metric_cards_json
    one = spark.createDataFrame([(3,)], "v long")
    none = spark.createDataFrame([(None,)], "v double")
    out = json.loads(metric_cards_json(metric_cards(one, one, none, keep_order=True)).first().json)
    assert [c["id"] for c in out] == ["dau", "new_mid", "order_amount"]
    assert out[0]["value"] == 3.0 and "value" not in out[2]  # no orders that day: the key is absent
