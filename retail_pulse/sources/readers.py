"""Stream and batch readers.

The Kafka connector jar is not on this image's classpath; the Kafka readers
build the exact option maps and call ``format("kafka")`` so they work
unchanged where the connector is installed, and tests check the options.
Offline, the same JSON messages are read from files with ``readStream``
(``maxFilesPerTrigger`` plays the role of the poll size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.schemas import CHANGE_EVENT, SOURCES

# Consumer group and start position of the stream sources.
CONSUMER_GROUP = "bigdata2021"
STARTING_OFFSETS = "latest"
# Fixed value: change-feed subscription pattern.
CDC_TABLE_PATTERN = "gmall.*"


def kafka_options(brokers: str, topic: str, group: str = CONSUMER_GROUP,
                  starting_offsets: str = STARTING_OFFSETS, max_offsets_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True) -> dict:
    """Options for ``format("kafka")``: one topic, string values, offsets kept in the checkpoint.

    Offsets that have expired stop the query; ``fail_on_data_loss=False`` goes on without them
    (Spark logs a warning for each lost range).
    """
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true" if fail_on_data_loss else "false",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_stream(spark: SparkSession, brokers: str, source: str, topic: str | None = None, **kw) -> DataFrame:
    """Streaming DataFrame ``(value STRING, topic, partition, offset, timestamp)`` of one source;
    ``topic`` overrides the registered one."""
    topic = topic or SOURCES[source][0]
    return spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **kw)).load() \
        .select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp")


def kafka_batch(spark: SparkSession, brokers: str, topic: str, starting: str = "earliest",
                ending: str = "latest") -> DataFrame:
    """Bounded read of a topic (offset range) as ``value STRING``."""
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic,
            "startingOffsets": starting, "endingOffsets": ending}
    return spark.read.format("kafka").options(**opts).load().select(F.col("value").cast("string").alias("value"))


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, driver: str | None = None) -> dict:
    """Options for ``format("jdbc")``; a partition column needs its bounds."""
    opts = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partition column needs lower and upper bounds")
        opts |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                 "numPartitions": str(num_partitions or 8)}
    return {k: v for k, v in opts.items() if v is not None}


def jdbc_table(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """JDBC table read; with a partition column the scan is split into parallel ranges."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()


def json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None,
               sampling_ratio: float | None = None) -> DataFrame:
    """JSON-lines files; inferred schema unless one is given.

    Inference reads every file once before the query runs; on large inputs
    pass a ``schema`` or a ``sampling_ratio`` (fraction of rows inspected).
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    elif sampling_ratio is not None:
        r = r.option("samplingRatio", str(sampling_ratio))
    return r.json(path)


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Offline stand-in for a topic: text files, one JSON message per line, as ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def change_feed_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                       max_files_per_trigger: int | None = 1) -> DataFrame:
    """Change entries (``CHANGE_EVENT`` schema) landed as files, read as a stream."""
    r = spark.readStream.format(fmt).schema(CHANGE_EVENT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def change_feed_messages(messages: DataFrame) -> DataFrame:
    """Change entries sent as JSON (``value``) -> ``CHANGE_EVENT`` columns; text that is no entry is left out."""
    entry = F.from_json(F.col("value"), CHANGE_EVENT)
    return messages.select(F.inline(F.array(entry))).where(F.col("table").isNotNull())


def subscribed(changes: DataFrame, pattern: str = CDC_TABLE_PATTERN, schema_col: str = "database") -> DataFrame:
    """Keep entries of subscribed tables (``database.table`` matched by regex from its start)."""
    return changes.where(F.concat_ws(".", F.col(schema_col), F.col("table")).rlike(f"^(?:{pattern})"))


def detail_table(spark: SparkSession, path: str, date_col: str, dates: list[str] | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """Serving scan of a date-partitioned detail table; ``dates`` prune partitions.

    Pass the table's ``schema``: without one Spark guesses the type of the date folders (DATE, not STRING).
    """
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if dates:
        df = df.where(F.col(date_col).isin(dates))
    return df


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """Scan of a keyed document table written by :func:`retail_pulse.sources.sinks.upsert_documents`:
    latest version per id."""
    from retail_pulse.sources.sinks import latest_documents
    return latest_documents(spark.read.parquet(path))


def register_view(df: DataFrame, name: str, replace: bool = True) -> str:
    """Expose ``df`` to SQL as a temp view: create-or-replace, or create only if absent."""
    if replace:
        df.createOrReplaceTempView(name)
    elif not df.sparkSession.catalog.tableExists(name):
        df.createTempView(name)
    return name
