"""Trigger settings, start/await helpers, per-batch metrics and a replay driver.

Reference micro-batch clocks are kept as trigger presets; tests and replays
use ``availableNow`` (process what is there, then stop).
"""

from __future__ import annotations

import contextlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retail_pulse.sources.sinks import write_batch_partition

# Micro-batch intervals of the jobs.
TRIGGERS = {
    "dau": "3 seconds",
    "gmv": "3 seconds",
    "alert": "3 seconds",
    "alert_slow": "5 seconds",
}

#: the greatest side that is broadcast: by Spark's estimate, and as measured while the query runs (by default the same)
_ESTIMATED, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def trigger_kwargs(job: str | None = None, available_now: bool = False) -> dict:
    """``writeStream.trigger(**kwargs)`` for a job's clock, or availableNow."""
    if available_now or job is None:
        return {"availableNow": True}
    return {"processingTime": TRIGGERS[job]}


def run_until_done(writer, timeout_s: float = 600.0):
    """Start a (bounded, availableNow) query and block until it finishes."""
    q = writer.start()
    finished = q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


@contextlib.contextmanager
def stream_conf(spark: SparkSession, state_partitions: int | None = None):
    """Session settings for starting a stateful stream, restored afterwards.

    The number of state partitions is fixed when a checkpoint is first
    created (from ``spark.sql.shuffle.partitions``); size it to the
    cluster's cores rather than an arbitrary session default, and keep
    state in RocksDB with changelog checkpointing.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # the exact state row count is only a metric; tracking it costs a read before every write
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    }
    with _held(spark, wanted):
        yield


@contextlib.contextmanager
def measured_broadcasts(spark: SparkSession):
    """Within, a side of a join is broadcast only after Spark has measured its rows, up to the size that the session allows.

    Before it runs, Spark sizes a side by its files: millions of keys that take a few MB there would be hundreds in the driver.
    """
    limit = spark.conf.get(_MEASURED, None) or spark.conf.get(_ESTIMATED)
    with _held(spark, {_ESTIMATED: "-1", _MEASURED: limit}):
        yield


def measured(process):
    """A ``foreachBatch`` function under :func:`measured_broadcasts`."""
    def run(batch: DataFrame, batch_id: int) -> None:
        with measured_broadcasts(batch.sparkSession):
            process(batch, batch_id)
    return run


@contextlib.contextmanager
def _held(spark: SparkSession, wanted: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_partitions(spark: SparkSession, path: str, col: str, values: list[str], schema) -> DataFrame | None:
    """Read only the ``col=<value>`` folders of a partitioned table, or None if none exists.

    A path glob ``col={v1,v2}`` with ``basePath`` makes file listing touch
    just those folders, so a long-lived table with many batch folders is not
    listed in full for every micro-batch. ``schema`` types the partition columns.
    """
    values = [v for v in values if v is not None]
    if not values:
        return None
    pattern = f"{path.rstrip('/')}/{col}={{{','.join(sorted(values))}}}"
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(pattern)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # no folder for any of the values yet
            return None
        raise


class BatchCounts:
    """Row counts at named points of a micro-batch plan via ``DataFrame.observe``.

    The counts are computed by the batch's own write job (no extra action). With a ``table``
    they go to it as rows (point, n) under the batch id, so a replayed batch replaces its own;
    the driver keeps those of the last ``keep`` batches.
    """

    def __init__(self, printer=None, table: str | None = None, keep: int = 100):
        self.by_batch: dict[int, dict[str, int]] = {}
        self._table, self._keep = table, keep
        self._pending: dict[str, Observation] = {}
        self._printer = printer  # e.g. print or a logger method: one line per batch

    def tap(self, df: DataFrame, point: str) -> DataFrame:
        obs = Observation(f"{point}")
        self._pending[point] = obs
        return df.observe(obs, F.count(F.lit(1)).alias("n"))

    def collect(self, batch_id: int) -> dict[str, int]:
        out = {p: int(o.get.get("n", 0)) for p, o in self._pending.items()}
        self._pending = {}
        self.by_batch[int(batch_id)] = out
        for old in sorted(self.by_batch)[:-self._keep]:
            del self.by_batch[old]
        if self._table:
            spark = SparkSession.getActiveSession()
            rows = spark.createDataFrame([(p, n) for p, n in out.items()], "point string, n bigint").coalesce(1)
            write_batch_partition(rows, self._table, batch_id)
        if self._printer:
            self._printer(f"batch {batch_id}: " + ", ".join(f"{k}={v}" for k, v in out.items()))
        return out


def replay_chunks(spark: SparkSession, df: DataFrame, ts_col: str, n_chunks: int, dest: str,
                  fmt: str = "parquet", project=None):
    """Yield after appending each of ``n_chunks`` equal-width time slices of ``df`` to ``dest``.

    ``project`` maps a slice to what is written (e.g. one JSON ``value`` per
    row with ``fmt="text"``).

    Used to drive a file-source stream in event-time order: the caller runs
    its ``availableNow`` query after each yield, so every slice becomes one
    micro-batch. Bounds come from one min/max aggregate (a single row).
    """
    import datetime as _dt

    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    lo, hi = df.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    if lo is None:
        return
    typ = df.schema[ts_col].dataType.simpleString()
    epoch = _dt.datetime(1970, 1, 1)

    def bound(micros: int):
        # wall-clock literal in the column's own type, so the predicate is pushed to the scan
        t = epoch + _dt.timedelta(microseconds=int(micros))
        return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(typ)

    step = (hi - lo) / n_chunks
    for k in range(n_chunks):
        cond = F.col(ts_col) >= bound(lo + step * k) if k else F.lit(True)
        if k < n_chunks - 1:
            cond = cond & (F.col(ts_col) < bound(lo + step * (k + 1)))
        part = df.where(cond)
        (project(part) if project else part).write.mode("append").format(fmt).save(dest)
        yield k
