"""Sinks: replay-safe partitioned appends, keyed-upsert document tables, message and console sinks.

Exactly-once on plain Parquet (no table-format jar on this image):

* every micro-batch writes under its own ``_batch_id=<n>`` partition with
  *dynamic* partition overwrite, so replaying batch ``n`` after a crash
  rewrites exactly that partition and nothing else;
* readers that must not see a batch twice read ``_batch_id < n``.

A keyed-upsert table appends versions ``(id, doc..., _batch_id, _seq)`` and
resolves the latest per id on read (last write wins). Compaction is the
same read written back.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_pulse.operators.dedup import first_per_key


def write_batch_partition(df: DataFrame, path: str, batch_id: int, partition_cols: list[str] | None = None,
                          fmt: str = "parquet", sort_cols: list[str] | None = None) -> None:
    """Idempotent append of one micro-batch: overwrite only ``(partition_cols..., _batch_id=n)``.

    With partition columns the output is ``REBALANCE``d on them first: AQE
    packs each folder's rows into few tasks (few files per folder and batch)
    and still splits a folder that holds a hot share of the rows.
    """
    parts = list(partition_cols or [])
    out = df.withColumn("_batch_id", F.lit(int(batch_id)).cast("bigint"))
    if parts:
        out = out.hint("rebalance", *parts)
    if sort_cols:
        out = out.sortWithinPartitions(*(parts + sort_cols))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*(parts + ["_batch_id"])).format(fmt).save(path)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared work folder and return the table.

    Cuts the lineage for frames read by several jobs (one computation
    instead of one per job) and survives executor loss, unlike a cache or a
    local checkpoint. ``DataFrame.checkpoint`` is not used because without a
    persisted input it computes the frame a second time to write it.
    """
    from retail_pulse.session import shared_dir
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def upper_case_columns(df: DataFrame, columns: list[str], targets: list[str]) -> DataFrame:
    """Positional projection of ``columns`` to the sink's upper-case ``targets``."""
    return df.select(*[F.col(c).alias(t) for c, t in zip(columns, targets)])


# Batch id of compacted rows: below every live batch, so a replayed batch never overwrites them.
COMPACTED_BATCH = -1


def with_auto_ids(docs: DataFrame, batch_id: int, id_col: str = "id") -> DataFrame:
    """Give each document without an id one of its own: batch id, content hash and its number among
    equal documents of the batch. A replay of the batch gives the same ids; equal documents stay
    apart. Equal documents are counted first, so many of them cost one row in the shuffle."""
    fields = [c for c in docs.columns if c != id_col]
    doc = F.struct(*[F.col(c) for c in fields])
    given = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias(id_col), *fields)
    nameless = docs.where(F.col(id_col).isNull()).groupBy(F.sha2(F.to_json(doc), 256).alias("_content")) \
        .agg(F.first(doc).alias("_doc"), F.count(F.lit(1)).alias("_n")) \
        .select("_content", "_doc", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_k"))
    named = F.concat(F.lit(f"auto-{int(batch_id)}-"), F.col("_content"), F.lit("-"), F.col("_k").cast("string"))
    return given.unionByName(nameless.select(named.alias(id_col), *[F.col(f"_doc.{c}").alias(c) for c in fields]))


def bucket_of(id_col, buckets: int):
    """The hash bucket of a document id (0 .. buckets - 1)."""
    return F.pmod(F.xxhash64(F.col(id_col) if isinstance(id_col, str) else id_col), F.lit(buckets)).cast("int")


def upsert_documents(docs: DataFrame, path: str, batch_id: int, id_col: str = "id",
                     order_col: str | None = None, partition_cols: list[str] | None = None, buckets: int | None = None) -> None:
    """Bulk upsert of ``(id, fields...)`` rows as one version batch.

    NULL ids get one of their own (:func:`with_auto_ids`); ``order_col`` orders versions
    of the same id inside the batch (later wins), otherwise row content does.
    An empty input writes an empty partition (a no-op for readers).
    ``partition_cols`` (derived from the id, e.g. a date) let readers prune; ``buckets`` adds the hash bucket of the id as
    a partition, so that :func:`documents_by_id` reads one folder per id (the number belongs to the table and must stay the same).
    """
    docs = docs.persist(StorageLevel.MEMORY_AND_DISK)  # the input is computed once
    try:
        if docs.where(F.col(id_col).isNull()).isEmpty():
            named = docs.withColumn(id_col, F.col(id_col).cast("string"))
        else:
            named = with_auto_ids(docs, batch_id, id_col)
        _write_versions(named, path, batch_id, id_col, order_col, partition_cols, buckets)
    finally:
        docs.unpersist()


def _write_versions(named: DataFrame, path: str, batch_id: int, id_col: str, order_col: str | None, partition_cols: list[str] | None, buckets: int | None) -> None:
    out = named.withColumn("_seq", _version_order(named, id_col, order_col))
    parts = list(partition_cols or [])
    if buckets:
        out, parts = out.withColumn("_bucket", bucket_of(id_col, buckets)), [*parts, "_bucket"]
    write_batch_partition(out, path, batch_id, parts)


def _version_order(docs: DataFrame, id_col: str, order_col: str | None):
    fields = [c for c in docs.columns if c != id_col]
    return (F.col(order_col) if order_col else F.xxhash64(*[F.col(c) for c in fields])).cast("bigint")


def documents_by_id(spark, path: str, ids: list[str], buckets: int, id_col: str = "id") -> DataFrame:
    """Latest versions of a few ids of a bucketed table: a filter on constant buckets, so only their folders are read."""
    t = spark.read.parquet(path)
    where = F.lit(False)
    for i in ids:
        where = where | ((F.col("_bucket") == bucket_of(F.lit(str(i)), buckets)) & (F.col(id_col) == F.lit(str(i))))
    return latest_documents(t.where(where), id_col)


# Longest document id in bytes (a limit of the document store whose interface this follows).
MAX_ID_BYTES = 512

OUTCOME = "id string, status string, reason string"


def upsert_with_outcome(docs: DataFrame, path: str, batch_id: int, id_col: str = "id", order_col: str | None = None,
                        required: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """:func:`upsert_documents` that says what became of each item: rows (id, status, reason), written beside the table.

    ``created``: the id was not there; ``replaced``: it was, or an earlier version of this batch created it; ``rejected``: nothing is written, and
    ``reason`` says why (``id_too_long``, ``missing_<field>``). Existing ids are looked up in the versions below ``batch_id`` by an
    executor-side join, so a replayed batch gives the same outcomes.
    """
    spark, out_path = docs.sparkSession, path.rstrip("/") + "_outcome"
    docs = docs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        named = with_auto_ids(docs, batch_id, id_col)
        reason = F.when(F.octet_length(F.col(id_col)) > MAX_ID_BYTES, F.lit("id_too_long"))
        for c in required or []:
            reason = reason.when(F.col(c).isNull(), F.lit(f"missing_{c}"))
        judged = named.withColumn("_reason", reason).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = judged.where("_reason IS NULL").drop("_reason")
            known = _ids_below(spark, path, batch_id, id_col)
            nth = F.row_number().over(Window.partitionBy("id").orderBy("_seq"))
            mine = good.select(F.col(id_col).alias("id"), _version_order(good, id_col, order_col).alias("_seq")).withColumn("_n", nth)
            if known is None:
                there = mine.withColumn("_there", F.lit(False))
            else:
                there = mine.join(known.withColumn("_there", F.lit(True)), "id", "left")
            status = F.when(F.coalesce("_there", F.lit(False)) | (F.col("_n") > 1), F.lit("replaced")).otherwise(F.lit("created"))
            outcome = there.select("id", status.alias("status"), F.lit(None).cast("string").alias("reason")).unionByName(
                judged.where("_reason IS NOT NULL").select(F.col(id_col).alias("id"), F.lit("rejected").alias("status"), F.col("_reason").alias("reason")))
            write_batch_partition(outcome, out_path, batch_id)
            _write_versions(good, path, batch_id, id_col, order_col, None, buckets)
        finally:
            judged.unpersist()
    finally:
        docs.unpersist()
    return spark.read.schema(OUTCOME + ", _batch_id long").parquet(out_path).where(F.col("_batch_id") == F.lit(int(batch_id))).drop("_batch_id")


def _ids_below(spark, path: str, batch_id: int, id_col: str) -> DataFrame | None:
    try:
        t = spark.read.schema(f"`{id_col}` string, _batch_id long").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return t.where(F.col("_batch_id") < F.lit(int(batch_id))).select(F.col(id_col).alias("id")).distinct()


def index_json(messages: DataFrame, path: str, batch_id: int, id_field: str = "id", value_col: str = "value") -> None:
    """Index raw JSON documents as they are (column ``doc``), keyed by the text of ``id_field`` in
    them; a document without it gets an id of its own."""
    docs = messages.select(F.get_json_object(value_col, f"$.{id_field}").alias("id"), F.col(value_col).alias("doc"))
    upsert_documents(docs, path, batch_id)


def latest_documents(versions: DataFrame, id_col: str = "id") -> DataFrame:
    """Latest version per id (largest ``(_batch_id, _seq)``), bookkeeping columns dropped."""
    latest = first_per_key(versions, [id_col], [F.col("_batch_id").desc(), F.col("_seq").desc()])
    return latest.drop("_batch_id", "_seq", "_bucket")


def compact_documents(spark, path: str, out_path: str, id_col: str = "id", buckets: int | None = None) -> None:
    """Rewrite a keyed-upsert table as a single version (the latest per id) at ``out_path``.

    Readers switch to the compacted folder; the source stays untouched, so a
    failed compaction never loses versions. The compacted rows are stored under
    ``COMPACTED_BATCH``: any live batch, replayed ones too, is above it. A bucketed table keeps its buckets.
    """
    latest = latest_documents(spark.read.parquet(path), id_col).withColumn("_seq", F.lit(0).cast("bigint")) \
        .withColumn("_batch_id", F.lit(COMPACTED_BATCH).cast("bigint"))
    parts = ["_batch_id"]
    if buckets:
        latest, parts = latest.withColumn("_bucket", bucket_of(id_col, buckets)).hint("rebalance", "_bucket"), ["_bucket", "_batch_id"]
    latest.write.mode("overwrite").partitionBy(*parts).parquet(out_path)


def compact_batches(spark, path: str, out_path: str, partition_cols: list[str] | None = None,
                    schema=None) -> None:
    """Rewrite an append-by-batch table (e.g. the DAU detail) with all its rows under one batch id.

    Months of micro-batches leave one small folder per batch and partition;
    the compacted copy holds the same rows, ``REBALANCE``d per partition into
    few files, under ``COMPACTED_BATCH``: readers that exclude ``_batch_id >= n`` still see
    them, and a batch replayed after a restart rewrites its own folder only. (The DAU writer drops
    device-days it has stored already, so replaying a compacted batch adds nothing.) The source
    stays untouched; pass ``schema`` when partition values are date strings.
    """
    r = spark.read.schema(schema) if schema is not None else spark.read
    rows = r.parquet(path)
    write_batch_partition(rows.drop("_batch_id"), out_path, COMPACTED_BATCH, partition_cols)


def index_name(prefix: str, suffix: str) -> str:
    """Date- or release-suffixed index (table folder) name."""
    return f"{prefix}{suffix}"


def kafka_sink_options(brokers: str, topic: str) -> dict:
    """Options for ``write[Stream].format("kafka")``: one JSON message per row, no key."""
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def write_kafka(messages: DataFrame, brokers: str, topic: str) -> None:
    """Batch write of ``value`` messages to a topic (needs the Kafka connector on the classpath)."""
    messages.select("value").write.format("kafka").options(**kafka_sink_options(brokers, topic)).save()


def write_kafka_stream(messages: DataFrame, brokers: str, topic: str, checkpoint: str, trigger: dict):
    """Streaming write of ``value`` messages to a topic; offsets and progress in ``checkpoint``."""
    return messages.select("value").writeStream.format("kafka") \
        .options(**kafka_sink_options(brokers, topic)).option("checkpointLocation", checkpoint) \
        .trigger(**trigger).start()


def write_messages(messages: DataFrame, path: str) -> None:
    """Offline message sink: one JSON message per line (``value`` column) as text files."""
    messages.select("value").write.mode("append").text(path)


def console(df: DataFrame, n: int = 20) -> None:
    """Print rows (batch DataFrame) like the reference's debug print."""
    df.show(n, truncate=False)


def console_stream(df: DataFrame, trigger: dict, output_mode: str = "append", n: int = 20):
    """Print each micro-batch's rows (streaming DataFrame)."""
    return df.writeStream.format("console").outputMode(output_mode).option("numRows", n) \
        .option("truncate", "false").trigger(**trigger).start()
