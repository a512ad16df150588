import json

from retail_pulse.operators import cdc
from retail_pulse.schemas import CHANGE_EVENT


def test_only_order_info_inserts_become_messages(spark):
    def row(**kv):
        return [{"name": k, "value": v} for k, v in kv.items()]
    entries = [
        (None, "gmall", "order_info", "ROWDATA", "INSERT", [row(id="1", total_amount="10.5"), row(id="2", total_amount="3")]),
        (None, "gmall", "order_info", "ROWDATA", "UPDATE", [row(id="1", total_amount="11")]),
        (None, "gmall", "user_info", "ROWDATA", "INSERT", [row(id="7", name="x")]),
        (None, "gmall", "order_info", "TRANSACTIONBEGIN", "INSERT", [row(id="9")]),
    ]
    df = spark.createDataFrame(entries, CHANGE_EVENT)
    msgs = [json.loads(r.value) for r in cdc.change_feed_messages(df).collect()]
    assert sorted(msgs, key=lambda m: m["id"]) == [{"id": "1", "total_amount": "10.5"},
                                                   {"id": "2", "total_amount": "3"}]


def test_subscription_pattern(spark):
    from retail_pulse.sources.readers import CDC_TABLE_PATTERN, subscribed
    db = CDC_TABLE_PATTERN.split(".")[0]
    df = spark.createDataFrame([(db, "order_info"), ("other", "order_info"), ("other", f"{db}.x"), (None, "order_info")], "database string, table string")
    assert [(r.database, r.table) for r in subscribed(df).collect()] == [(db, "order_info")]
    entries = cdc.as_change_entries(spark.createDataFrame([("1",)], "id string"), "order_info", cdc.INSERT)
    assert subscribed(entries).count() == 1  # the default pattern keeps entries built here


def test_last_value_of_a_repeated_column_wins(spark):
    cols = [[{"name": "id", "value": "1"}, {"name": "a", "value": "old"}, {"name": None, "value": "x"}, {"name": "a", "value": "new"}], []]
    rows = spark.createDataFrame([(c,) for c in cols], "cols array<struct<name string, value string>>")
    assert sorted(json.loads(r.value) == {"id": "1", "a": "new"} for r in cdc.rows_to_messages(rows).collect()) == [False, True]


def test_change_entries_from_json_messages(spark):
    from retail_pulse.sources.readers import change_feed_messages
    entry = {"database": "gmall", "table": "order_info", "entry_type": "ROWDATA", "event_type": "INSERT", "rows": [[{"name": "id", "value": "5"}]]}
    df = spark.createDataFrame([(json.dumps(entry),), ("{broken",), (None,)], "value string")
    got = change_feed_messages(df)
    assert got.schema.simpleString() == CHANGE_EVENT.simpleString() and [r.value for r in cdc.change_feed_messages(got).collect()] == ['{"id":"5"}']
