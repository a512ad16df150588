"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a NULL document id where ids are ordered: NULL sorts after every id.
NULL_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``.

    Only a local session may lack that setting; it then gets a folder of its
    own. On a cluster a machine-local folder would lose the other executors'
    files, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="retail-pulse-llm-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/retail_pulse_llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_crc(col: str, mod: int) -> Column:
    """crc32 of a column's text form, modulo ``mod`` (NULL stays NULL)."""
    return F.crc32(F.col(col).cast("string")) % mod


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, or ``name`` with underscores before it, that clashes with no taken column (case-insensitively)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def small(batches, rows: int = 1000):
    """Arrow batches in slices of at most ``rows`` rows: what a worker makes of a batch of long texts stays small."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)


def give_back() -> None:
    """Return what Arrow and the C library hold but do not use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """An Arrow function whose worker gives memory back at the end of each task: workers live on, and several share an executor's memory."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


def table_of(cells: DataFrame, size: int, chunk: int = 1 << 14) -> np.ndarray:
    """An array of ``size`` longs from rows (place, value) of distinct places, zero elsewhere.

    The rows are packed into chunks on the executors, so the driver gets 8 bytes for each place and no rows.
    """
    def pack(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            place, value = (b.column(i).to_numpy() for i in (0, 1))
            for c in np.unique(place // chunk):
                at = place // chunk == c
                held.setdefault(int(c), np.zeros(chunk, dtype=np.int64))[place[at] % chunk] = value[at]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["chunk", "packed"])

    place, value = cells.columns
    packed = (cells.select(F.col(place).cast("long"), F.col(value).cast("long"))
              .repartition(max(1, min(64, size // chunk)), F.floor(F.col(place) / chunk)).mapInArrow(pack, "chunk long, packed binary"))
    out = np.zeros(-(-size // chunk) * chunk, dtype=np.int64)
    for r in packed.collect():
        out[r.chunk * chunk:(r.chunk + 1) * chunk] = np.frombuffer(r.packed, dtype=np.int64)
    return out[:size]
