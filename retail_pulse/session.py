"""Session construction and the shared working folder.

On a cluster the working folder for streaming checkpoints, replayable tables
and lineage cuts is the shared one named by ``spark.checkpoint.dir``. We only
pick our own folder when the session has none (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings that every job here relies on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Streaming state (alert windows, join buffers) off the JVM heap, with small per-batch commits.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "retail_pulse", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ``shuffle_partitions`` defaults to the core count for local runs; on a
    cluster leave it unset and let AQE coalesce from the cluster default.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="retail-pulse-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        root = ensure_checkpoint_dir(spark)
    # named only: whoever writes there makes it, through Spark's own file systems (the scheme stays)
    return f"{root.rstrip('/')}/retail_pulse/{purpose}-{uuid.uuid4().hex[:12]}"
