import json
import os

from retail_pulse.sources import readers


def test_kafka_options():
    o = readers.kafka_options("b:9092", "GMALL_STARTUP")
    assert o["subscribe"] == "GMALL_STARTUP"
    assert o["kafka.group.id"] == "bigdata2021"
    assert o["startingOffsets"] == "latest"


def test_json_lines_inferred_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "people.json")
    with open(p, "w") as f:
        for name, age in [("ann", 31), ("bo", 19), ("cy", 25)]:
            f.write(json.dumps({"age": age, "name": name}) + "\n")
    df = readers.json_lines(spark, p)
    assert dict(df.dtypes) == {"age": "bigint", "name": "string"}
    df.createOrReplaceTempView("stu")
    assert spark.sql("select name from stu where age > 20 order by name").collect()[0].name == "ann"


def test_register_view_create_only_if_absent(spark):
    first = spark.createDataFrame([(1,)], "x int")
    second = spark.createDataFrame([(2,)], "x int")
    readers.register_view(first, "rp_once", replace=False)
    readers.register_view(second, "rp_once", replace=False)  # exists: kept
    assert spark.sql("select x from rp_once").first().x == 1
    readers.register_view(second, "rp_once")  # create-or-replace
    assert spark.sql("select x from rp_once").first().x == 2


def test_connector_readers_are_wired(spark):
    """Kafka is not on this image's classpath: the readers must reach the data source lookup."""
    import pytest
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.kafka_batch(spark, "localhost:1", "GMALL_ORDER").collect()
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.kafka_stream(spark, "localhost:1", "startup")
