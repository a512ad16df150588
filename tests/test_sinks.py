import os

from pyspark.sql import functions as F

from retail_pulse.sources.sinks import latest_documents, upsert_documents, write_batch_partition

DOC = "id string, name string"


def test_bulk_upsert_replace_autoid_and_empty(spark, tmp_dir):
    path = os.path.join(tmp_dir, "movies")
    upsert_documents(spark.createDataFrame([("1", "a"), ("2", "b")], DOC), path, 0)
    upsert_documents(spark.createDataFrame([("1", "a2"), (None, "c")], DOC), path, 1)
    upsert_documents(spark.createDataFrame([], DOC), path, 2)  # empty list: no-op
    got = {r.id: r.name for r in latest_documents(spark.read.parquet(path)).collect()}
    assert got["1"] == "a2" and got["2"] == "b"
    auto = [k for k in got if k.startswith("auto-")]
    assert len(auto) == 1 and got[auto[0]] == "c"
    assert len(got) == 3


def test_same_id_twice_in_one_batch_last_by_order_col(spark, tmp_dir):
    path = os.path.join(tmp_dir, "alerts")
    df = spark.createDataFrame([("m1-1", "old", 1), ("m1-1", "new", 2)], "id string, name string, ts bigint")
    upsert_documents(df, path, 0, order_col="ts")
    assert [r.name for r in latest_documents(spark.read.parquet(path)).collect()] == ["new"]


def test_batch_partition_write_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "detail")
    df = spark.createDataFrame([("m1", "2024-01-01"), ("m2", "2024-01-02")], "mid string, log_date string")
    write_batch_partition(df, path, 0, ["log_date"])
    write_batch_partition(df.where(F.col("mid") == "m1"), path, 1, ["log_date"])
    write_batch_partition(df.where(F.col("mid") == "m1"), path, 1, ["log_date"])  # replay of batch 1
    t = spark.read.parquet(path)
    assert t.count() == 3
    assert t.where("_batch_id = 1").count() == 1


def test_compaction_keeps_latest_versions(spark, tmp_dir):
    from retail_pulse.sources.sinks import compact_documents
    path, out = os.path.join(tmp_dir, "docs"), os.path.join(tmp_dir, "docs_compact")
    upsert_documents(spark.createDataFrame([("1", "a"), ("2", "b")], DOC), path, 0)
    upsert_documents(spark.createDataFrame([("1", "a2")], DOC), path, 1)
    compact_documents(spark, path, out)
    compacted = spark.read.parquet(out)
    assert compacted.count() == 2
    assert {r.id: r.name for r in latest_documents(compacted).collect()} == {"1": "a2", "2": "b"}
    upsert_documents(spark.createDataFrame([("2", "b2")], DOC), out, 2)  # later upserts still win
    assert {r.id: r.name for r in latest_documents(spark.read.parquet(out)).collect()} == {"1": "a2", "2": "b2"}


def test_compact_batches_keeps_every_row(spark, tmp_dir):
    from pyspark.sql import types as T

    from retail_pulse.sources.sinks import compact_batches
    path, out = os.path.join(tmp_dir, "detail"), os.path.join(tmp_dir, "detail_compact")
    for b in range(3):
        df = spark.createDataFrame([(f"m{b}", "2024-01-01"), (f"n{b}", "2024-01-02")], "mid string, log_date string")
        write_batch_partition(df, path, b, ["log_date"])
    schema = T.StructType([T.StructField("mid", T.StringType()), T.StructField("log_date", T.StringType()),
                           T.StructField("_batch_id", T.LongType())])
    compact_batches(spark, path, out, ["log_date"], schema)
    before = sorted((r.mid, r.log_date) for r in spark.read.schema(schema).parquet(path).collect())
    after = spark.read.schema(schema).parquet(out)
    assert sorted((r.mid, r.log_date) for r in after.collect()) == before
    assert [r._batch_id for r in after.select("_batch_id").distinct().collect()] == [-1]
