from pyspark.sql import functions as F

from retail_pulse.functions.jsonparse import parse_json_column, parse_records
from retail_pulse.functions.mask import mask_phone
from retail_pulse.functions.text import analyze, tokens
from retail_pulse.functions.time import create_date, create_hour, with_log_date_hour
from retail_pulse.schemas import ORDER_INFO, ORDER_TYPES


def test_epoch_ms_to_date_hour(spark):
    df = spark.createDataFrame([(1704070799999,), (1704070800000,)], "ts bigint")
    rows = with_log_date_hour(df, "ts", epoch_ms=True).orderBy("ts").collect()
    assert [(r.log_date, r.log_hour) for r in rows] == [("2024-01-01", "00"), ("2024-01-01", "01")]


def test_create_time_split(spark):
    df = spark.createDataFrame([("2024-01-01 09:05:06",)], "create_time string")
    r = df.select(create_date("create_time").alias("d"), create_hour("create_time").alias("h")).first()
    assert (r.d, r.h) == ("2024-01-01", "09")


def test_phone_mask(spark):
    df = spark.createDataFrame([("13812345678",), ("123",), (None,)], "tel string")
    got = [r.m for r in df.select(mask_phone("tel").alias("m")).collect()]
    assert got == ["138****5678", "****", None]


def test_quoted_amount_parses_with_string_schema(spark):
    df = spark.createDataFrame([('{"id":"1","total_amount":"12.5"}',)], "value string")
    good, bad = parse_records(df, ORDER_INFO, ORDER_TYPES)
    assert good.select("total_amount").first()[0] == 12.5
    assert bad.count() == 0


def test_plain_double_schema_would_lose_quoted_amount(spark):
    # the trap the string-first schema avoids
    df = spark.createDataFrame([('{"total_amount":"12.5"}',)], "value string")
    v = df.select(F.from_json("value", "total_amount double").alias("r")).first().r
    assert v is None or v.total_amount is None


def test_bad_json_is_quarantined(spark):
    df = spark.createDataFrame([('bad{',), ('{"id":"2","total_amount":"3"}',), ('{"id":"3","total_amount":"x"}',)],
                               "value string")
    parsed = parse_json_column(df, ORDER_INFO, ORDER_TYPES)
    reasons = {r._raw: r._reject_reason for r in parsed.collect()}
    assert reasons['bad{'] == "malformed_json"
    assert reasons['{"id":"3","total_amount":"x"}'] == "bad_number"
    assert reasons['{"id":"2","total_amount":"3"}'] is None
    good, bad = parse_records(df, ORDER_INFO, ORDER_TYPES)
    assert [r.id for r in good.collect()] == ["2"]
    assert bad.count() == 2


def test_tokenizer_matches_driver_side_analyzer(spark):
    texts = ["Hello, World! It's 2024.", "打羽毛球 and tennis", "Élan déjà-vu  NAÏVE"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [list(r.t) for r in df.select(tokens("text").alias("t")).collect()]
    assert got == [analyze(t) for t in texts]
    assert got[1] == ["打", "羽", "毛", "球", "and", "tennis"]
    assert got[0] == ["hello", "world", "it", "s", "2024"]
