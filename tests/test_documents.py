"""Document tables in buckets, and the outcome of each item of a bulk write."""

from retail_pulse.sources import sinks

DOC = "id string, name string, v int"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_a_lookup_reads_one_folder_and_the_latest_version(spark, tmp_dir):
    live, compact = f"{tmp_dir}/live", f"{tmp_dir}/compact"
    sinks.upsert_documents(docs(spark, [(str(i), "a", 1) for i in range(200)]), live, 0, order_col="v", buckets=8)
    sinks.upsert_documents(docs(spark, [(str(i), "b", 2) for i in range(0, 200, 3)]), live, 1, order_col="v", buckets=8)
    sinks.compact_documents(spark, live, compact, buckets=8)
    sinks.upsert_documents(docs(spark, [("6", "c", 3)]), compact, 2, order_col="v", buckets=8)
    for path, six in ((live, "b"), (compact, "c")):
        got = sinks.documents_by_id(spark, path, ["6", "7", "none"], 8)
        assert got.columns == ["id", "name", "v"] and {(r.id, r.name) for r in got.collect()} == {("6", six), ("7", "a")}
        one = sinks.documents_by_id(spark, path, ["6"], 8)
        plan = one._jdf.queryExecution().executedPlan().toString()
        filters = next(x for x in plan.splitlines() if "PartitionFilters" in x)
        assert "_bucket#" in filters and "xxhash64" not in filters  # a constant: the folder is chosen before anything is read
        assert sinks.latest_documents(spark.read.parquet(path)).count() == 200


def test_outcome_of_each_item(spark, tmp_dir):
    path = f"{tmp_dir}/docs"
    first = docs(spark, [("1", "a", 1), ("2", "b", 1), ("x" * 600, "c", 1), ("3", None, 1)])
    got = {(r.id[:5], r.status, r.reason) for r in sinks.upsert_with_outcome(first, path, 0, order_col="v", required=["name"]).collect()}
    assert got == {("1", "created", None), ("2", "created", None), ("xxxxx", "rejected", "id_too_long"), ("3", "rejected", "missing_name")}
    second = docs(spark, [("2", "b2", 2), ("3", "d", 1), ("4", "e", 1), ("4", "e2", 2), (None, "n", 1), (None, "n", 1)])
    for _ in range(2):  # a replay gives the same outcomes
        got = sorted((r.id if not r.id.startswith("auto") else "auto", r.status) for r in sinks.upsert_with_outcome(second, path, 1, order_col="v").collect())
        assert got == [("2", "replaced"), ("3", "created"), ("4", "created"), ("4", "replaced"), ("auto", "created"), ("auto", "created")]
    latest = sorted((r.id if not r.id.startswith("auto") else "auto", r.name) for r in sinks.latest_documents(spark.read.parquet(path)).collect())
    assert latest == [("1", "a"), ("2", "b2"), ("3", "d"), ("4", "e2"), ("auto", "n"), ("auto", "n")]
    assert sinks.upsert_with_outcome(docs(spark, []), f"{tmp_dir}/none", 0).count() == 0
