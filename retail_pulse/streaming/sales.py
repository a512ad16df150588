"""Sale-detail stream: order stream x order-line stream (watermarked interval join) x SKU table.

Orders and their lines arrive on two change streams, each carrying its
commit time ``ts``. The inner join matches a line to its order when the
line is committed within ``max_delay`` after the order:

    line.orderkey = order.orderkey AND line.ts BETWEEN order.ts AND order.ts + max_delay

Each micro-batch is joined as a batch (``foreachBatch`` on both streams as one feed): its rows meet each other and the
rows that earlier batches left open. A row stays open only until the other side's watermark makes a match
impossible, so what is kept between batches is bounded by ``max_delay + watermark delay`` worth of orders and lines, not
by the history, and a row that is matched in its own batch and closed by its watermark never enters a state store.

The SKU enrichment is an ordinary batch join of
the micro-batch's joined lines with the SKU table: there AQE plans it
(broadcast only when the SKU side is measured small, never by the size of its files, otherwise a
sort-merge join with hot SKUs split), which a stream-static join inside
the streaming plan would not get. Each micro-batch appends its rows under
``_batch_id`` (idempotent on replay), in folders by month and sorted by day inside, so that a
day's page reads one folder and few row groups.

The join is a left outer one: a line whose order did not come in time, or
whose SKU is not in the table, is parked in a table beside the sales, whole and with a reason, and
:func:`recover_parked` re-injects it once order and SKU are there. Rows that arrive behind the
watermark are dropped before the join; :func:`late_rows` counts them.

User columns come from a table of user versions that a change stream extends
(:func:`start_user_stream`): a sale row has the version that was valid when the order was made.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.sources.sinks import write_batch_partition
from retail_pulse.streaming.runner import measured, measured_broadcasts


_ORDER = ["o_orderkey", "o_custkey", "o_ts"]
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_ts"]


def order_line_feed(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The two change streams (o_orderkey, o_custkey, ts) and (l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, ts)
    as one, so that a micro-batch holds what is new of both."""
    o = orders.select("o_orderkey", "o_custkey", F.col("ts").cast("timestamp").alias("o_ts"), F.lit(False).alias("is_line"))
    li = lines.select(*_LINE[:-1], F.col("ts").cast("timestamp").alias("l_ts"), F.lit(True).alias("is_line"))
    return li.unionByName(o, allowMissingColumns=True)


def order_line_writer(write, state_path: str, max_delay: str = "1 hour", watermark: str = "10 minutes"):
    """``foreachBatch`` on :func:`order_line_feed`: an interval left join, handed to ``write(joined, batch_id)``.

    The pairs of a batch are those of which the line or the order is new. A line without an order goes out, with NULL order columns,
    in the batch whose watermark rules a match out. Rows behind the watermark of the batch before are dropped and counted.
    What may still meet a later row is kept for the next batch, in one of two folders in turn: a batch that is run again finds the rows it had.
    """
    delay = F.expr(f"INTERVAL {max_delay}")
    cond = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_ts") >= F.col("o_ts")) & (F.col("l_ts") <= F.col("o_ts") + delay)

    @measured
    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = _marks(spark, state_path, batch_id - 1) if batch_id else None
            late = F.lit(False)
            if before and before.mark is not None:
                late = F.coalesce(F.coalesce("l_ts", "o_ts") <= F.timestamp_micros(F.lit(before.mark)), F.lit(False))
            top = batch.agg(F.max("o_ts").alias("o"), F.max("l_ts").alias("l"), F.count_if(late).alias("late"))
            if before:
                top = top.select(F.greatest("o", F.timestamp_micros(F.lit(before.o).cast("long"))).alias("o"),
                                 F.greatest("l", F.timestamp_micros(F.lit(before.l).cast("long"))).alias("l"), (F.col("late") + before.late).alias("late"))
            # the watermark of both streams: there is none until both have a row
            mark = F.when(F.col("o").isNotNull() & F.col("l").isNotNull(), F.least("o", "l") - F.expr(f"INTERVAL {watermark}"))
            now = top.select(*[F.unix_micros(c).alias(n) for n, c in (("o", F.col("o")), ("l", F.col("l")), ("mark", mark))], "late").first()
            rows = batch.where(~late).withColumn("is_new", F.lit(True)).withColumn("matched", F.lit(False))
            if before:
                rows = rows.unionByName(spark.read.schema(rows.schema).parquet(_slot(state_path, "rows", batch_id - 1)).withColumn("is_new", F.lit(False)))
            li = rows.where("is_line").select(*_LINE, "matched", F.col("is_new").alias("l_new"))
            o = rows.where("NOT is_line AND o_orderkey IS NOT NULL AND o_ts IS NOT NULL").select(*_ORDER, F.col("is_new").alias("o_new"))
            if now.mark is None:
                closed = order_closed = F.lit(False)
            else:
                passed = F.timestamp_micros(F.lit(now.mark))
                closed, order_closed = F.coalesce(F.col("l_ts") <= passed, F.lit(False)), F.col("o_ts") + delay <= passed
            pair = F.col("o_orderkey").isNotNull()
            joined = li.join(o, cond, "left").where((pair & (F.col("l_new") | F.col("o_new"))) | (~pair & ~F.col("matched") & closed))
            write(joined.select(*_LINE, *_ORDER), batch_id)
            waiting = li.where(~closed)
            once = waiting.where(~F.col("matched"))
            kept = waiting.where("matched").select(*_LINE, "matched") \
                .unionByName(once.join(o, cond, "left_semi").select(*_LINE, F.lit(True).alias("matched"))) \
                .unionByName(once.join(o, cond, "left_anti").select(*_LINE, "matched")).withColumn("is_line", F.lit(True)) \
                .unionByName(o.where(~order_closed).select(*_ORDER, F.lit(False).alias("matched"), F.lit(False).alias("is_line")), allowMissingColumns=True)
            kept.write.mode("overwrite").parquet(_slot(state_path, "rows", batch_id))
            spark.createDataFrame([now], _MARKS).coalesce(1).write.mode("overwrite").parquet(_slot(state_path, "marks", batch_id))
        finally:
            batch.unpersist()
    return process


#: per batch: the latest times seen of both streams, their watermark (microseconds), and all rows that came behind it
_MARKS = "o long, l long, mark long, late long"


def _slot(state_path: str, what: str, batch_id: int) -> str:
    return f"{state_path}/{what}-{batch_id % 2}"


def _marks(spark: SparkSession, state_path: str, batch_id: int):
    return spark.read.schema(_MARKS).parquet(_slot(state_path, "marks", batch_id)).first()


def open_beside(checkpoint: str) -> str:
    """Where the rows are kept that later ones may meet."""
    return checkpoint.rstrip("/") + "_open"


def enrich_with_sku(order_lines: DataFrame, part: DataFrame) -> DataFrame:
    """Joined order lines x SKU table -> wide sale rows (a batch join)."""
    p = part.select("p_partkey", "p_name")
    return order_lines.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("sku_id"),
        F.col("p_name").alias("sku_name"), F.col("l_quantity").alias("sku_num"),
        F.col("l_extendedprice").alias("sku_price"), F.date_format("o_ts", "yyyy-MM-dd").alias("dt"), F.col("o_ts").alias("order_ts"))


def unmatched_lines(order_lines: DataFrame, part: DataFrame) -> DataFrame:
    """Lines that no sale row is made of, with the reason ``no_order`` or ``no_sku``."""
    columns = [F.col("l_orderkey").cast("long").alias("order_id"), F.col("l_linenumber").cast("int").alias("line_no"), F.col("l_partkey").cast("long").alias("sku_id"),
               F.col("l_quantity").cast("double").alias("sku_num"), F.col("l_extendedprice").cast("double").alias("sku_price"), F.col("l_ts").alias("line_ts")]
    lost = order_lines.where(F.col("o_orderkey").isNull()).select(*columns, F.lit("no_order").alias("reason"))
    known = part.select(F.col("p_partkey").alias("l_partkey"))
    return lost.unionByName(order_lines.where(F.col("o_orderkey").isNotNull()).join(known, "l_partkey", "left_anti")
                            .select(*columns, F.lit("no_sku").alias("reason")))


def late_rows(spark: SparkSession, checkpoint: str) -> int:
    """Rows that the job with this checkpoint dropped because they came behind the watermark."""
    found = []
    for batch_id in range(2):  # the folders are written in turn; the count only grows
        try:
            found.append(_marks(spark, open_beside(checkpoint), batch_id).late)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return max(found, default=0)


# --- users: a dimension with versions -------------------------------------------

USER_COLUMNS = ["user_name", "user_level", "user_gender", "user_age"]
USER_VERSIONS = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("valid_from", T.TimestampType()), T.StructField("user_name", T.StringType()),
    T.StructField("user_level", T.StringType()), T.StructField("user_gender", T.StringType()), T.StructField("user_age", T.IntegerType()),
    T.StructField("_batch_id", T.LongType())])


def user_version_writer(path: str):
    """``foreachBatch`` on a change stream of users: every change is a version, valid from its commit time on."""
    def process(batch: DataFrame, batch_id: int) -> None:
        good = batch.where(F.col("user_id").isNotNull() & F.col("valid_from").isNotNull())
        write_batch_partition(good.select("user_id", "valid_from", *USER_COLUMNS), path, batch_id)
    return process


def start_user_stream(users: DataFrame, path: str, checkpoint: str, trigger: dict):
    return users.writeStream.foreachBatch(user_version_writer(path)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def user_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(USER_VERSIONS).parquet(path)


def with_user(rows: DataFrame, versions: DataFrame, user_id: str = "user_id", at: str = "order_ts") -> DataFrame:
    """``rows`` with the user columns of the version that was valid at the time ``at`` (NULL where there is none).

    An as-of join: the distinct (user, time) pairs of the rows meet the user's versions up to that time, and the last one wins by a
    partial aggregate; a user with many rows costs one row per time.
    """
    keys = rows.select(F.col(user_id).alias("_u"), F.col(at).alias("_t")).distinct()
    seen = keys.join(versions, (F.col("_u") == versions["user_id"]) & (versions["valid_from"] <= F.col("_t")))
    last = seen.groupBy("_u", "_t").agg(F.max_by(F.struct(*USER_COLUMNS), F.struct("valid_from", "_batch_id")).alias("_v"))
    found = last.select("_u", "_t", *[F.col(f"_v.{c}").alias(c) for c in USER_COLUMNS])
    return rows.join(found, (F.col(user_id) == F.col("_u")) & (F.col(at) == F.col("_t")), "left").drop("_u", "_t")


# --- the job ----------------------------------------------------------------------

def sale_writer(spark: SparkSession, part: DataFrame, table_path: str, parked_path: str, users_path: str | None = None):
    """``foreachBatch`` of the joined lines: sale rows to the table, lines without an order or SKU to ``parked_path``."""
    @measured
    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_sales(spark, batch.where(F.col("o_orderkey").isNotNull()), part, table_path, batch_id, users_path)
            write_batch_partition(unmatched_lines(batch, part), parked_path, batch_id)
        finally:
            batch.unpersist()
    return process


def write_sales(spark: SparkSession, order_lines: DataFrame, part: DataFrame, table_path: str, batch_id: int, users_path: str | None) -> None:
    rows = enrich_with_sku(order_lines, part)
    if users_path:
        rows = with_user(rows, user_versions(spark, users_path))
    out = rows.drop("order_ts").withColumn("dt_month", F.substring("dt", 1, 7))
    write_batch_partition(out, table_path, batch_id, ["dt_month"], sort_cols=["dt"])


def start_sale_detail_stream(spark: SparkSession, orders: DataFrame, lines: DataFrame, part: DataFrame,
                             table_path: str, checkpoint: str, trigger: dict, unmatched_path: str | None = None,
                             users_path: str | None = None, **kw):
    """Lines that make no sale row are parked beside the table (``<table>_parked``) unless a path is given: none is dropped."""
    writer = sale_writer(spark, part, table_path, unmatched_path or parked_beside(table_path), users_path)
    return order_line_feed(orders, lines).writeStream.outputMode("append") \
        .foreachBatch(order_line_writer(writer, open_beside(checkpoint), **kw)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def parked_beside(table_path: str) -> str:
    return table_path.rstrip("/") + "_parked"


# --- parked lines -------------------------------------------------------------------

#: recovered rows lie above every batch of the stream, so neither overwrites the other's folders
RECOVERED_BATCH = 1 << 40

PARKED_LINES = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("line_no", T.IntegerType()), T.StructField("sku_id", T.LongType()),
    T.StructField("sku_num", T.DoubleType()), T.StructField("sku_price", T.DoubleType()), T.StructField("line_ts", T.TimestampType()),
    T.StructField("reason", T.StringType()), T.StructField("_batch_id", T.LongType())])


def recover_parked(spark: SparkSession, orders: DataFrame, part: DataFrame, table_path: str, round_id: int,
                   unmatched_path: str | None = None, users_path: str | None = None) -> None:
    """Re-inject parked lines whose order and SKU are there by now (a scheduled job; ``round_id`` counts its runs).

    The lines recovered in earlier rounds are listed in ``<parked>_recovered`` and left out; a round that is run again rewrites its own
    folders. ``orders`` (o_orderkey, o_custkey, ts) holds late orders too. The sale row is the one the stream would have written.
    """
    parked_path = unmatched_path or parked_beside(table_path)
    done_path = parked_path.rstrip("/") + "_recovered"
    batch_id = RECOVERED_BATCH + round_id
    with measured_broadcasts(spark):
        open_ = open_lines(spark, parked_path, before=batch_id)
        o = orders.select(F.col("o_orderkey").alias("_o"), F.col("o_custkey"), F.col("ts").cast("timestamp").alias("o_ts"))
        p = part.select(F.col("p_partkey").alias("_p"))
        ready = open_.join(o, F.col("order_id") == F.col("_o")).join(p, F.col("sku_id") == F.col("_p"), "left_semi").select("line_key",
            F.col("order_id").alias("l_orderkey"), F.col("line_no").alias("l_linenumber"), F.col("sku_id").alias("l_partkey"),
            F.col("sku_num").alias("l_quantity"), F.col("sku_price").alias("l_extendedprice"), F.col("order_id").alias("o_orderkey"), "o_custkey", "o_ts") \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_sales(spark, ready, part, table_path, batch_id, users_path)
            write_batch_partition(ready.select(F.col("l_orderkey").alias("order_id"), "line_key"), done_path, batch_id)
        finally:
            ready.unpersist()


def open_lines(spark: SparkSession, parked_path: str, before: int = 1 << 62) -> DataFrame:
    """The parked lines that no round below ``before`` has recovered."""
    # line numbers need not be unique in an order: a line is known by all that it holds
    held = [c for c in PARKED_LINES.fieldNames() if c not in ("reason", "_batch_id")]
    parked = spark.read.schema(PARKED_LINES).parquet(parked_path).withColumn("line_key", F.xxhash64(*held))
    schema = T.StructType([PARKED_LINES["order_id"], T.StructField("line_key", T.LongType()), PARKED_LINES["_batch_id"]])
    try:
        done = spark.read.schema(schema).parquet(parked_path.rstrip("/") + "_recovered").where(F.col("_batch_id") < F.lit(before))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return parked  # no round yet
    return parked.join(done.select("order_id", "line_key"), ["order_id", "line_key"], "left_anti")
