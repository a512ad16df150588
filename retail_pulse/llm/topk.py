"""Exact top-k inner products by norm-bucketed retrieval.

1. Vectors are turned into integers, sorted by length with a range partitioning and packed into buckets of
   similar length; queries are packed into blocks.
2. Each query meets the bucket of the longest vectors first, which gives it a lower bound of its k-th score.
3. With that bound, a bucket has a local cosine threshold for each query: the cosine that its longest vector needs to
   reach the bound. Thresholds above 1 rule the whole bucket out; block and bucket pairs in which that holds for all queries are never sent. In what
   remains each bucket prunes by length (only the vectors long enough) if the thresholds are low, or by coordinate (only vectors whose
   values at the query's largest coordinates lie within the range that the threshold leaves) if they are high.
4. Whatever passes is verified by its exact integer product, and each query keeps its best k per bucket, then of all buckets.

Nothing is broadcast. Queries are a stated set against all rows, in blocks of ``query_block``; buckets hold at most ``bucket_bytes``.

Defined cases: vectors that are NULL, hold NULL or a component that is not finite, or have no id take no part, as query or
candidate; vectors of different dimension are never compared; repeated equal rows count once, and different vectors
of one id are one item whose score is the greatest; an item is never its own partner; ties go to the smaller id; products beyond
the range of a long are clipped to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retail_pulse.llm.common import written

_PACK = "dim int, n int, longest double, ids binary, norms binary, vectors binary"
_EXACT = 2.0**53


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(id, v): distinct vectors of floor(scale * x) per component; unusable vectors are left out."""
    v = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(usable).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("v")).distinct()


def _pack(rows: DataFrame, max_bytes: int, max_rows: int) -> DataFrame:
    """Rows (dim, norm, id, v) in their order, packed into matrices of one dimension."""
    def run(batches):
        held: list[tuple] = []

        def out():
            ids = np.array([r[2] for r in held], dtype=np.int64)
            norms = np.array([r[1] for r in held])
            values = np.array([r[3] for r in held], dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0][0]], pa.int32()), pa.array([len(held)], pa.int32()), pa.array([float(norms.max())]), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([norms.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())],
                names=["dim", "n", "longest", "ids", "norms", "vectors"])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if held and (held[0][0] != row[0] or len(held) >= max_rows or len(held) * 8 * max(1, row[0]) >= max_bytes):
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    return rows.select("dim", "norm", "id", "v").mapInArrow(run, _PACK)


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["norms"], dtype=np.float64),
            np.frombuffer(row["vectors"], dtype=np.int64).reshape(row["n"], row["dim"]))


def _products(q: np.ndarray, p: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products; floats are exact below 2**53, which the lengths bound."""
    if bound < _EXACT:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ p.astype(object).T
    return np.array([[max(-2**63, min(2**63 - 1, x)) for x in r] for r in exact], dtype=np.int64).reshape(len(q), len(p))


def _retrieve(q_ids, q_norms, q, floor, p_ids, p_norms, p, k: int, focus: int, switch: float):
    """Best k of one bucket for each query: (query row, candidate ids, scores). ``floor`` is the score that a query must reach."""
    longest = p_norms.max(initial=0.0)
    need = np.divide(floor, q_norms, out=np.where(floor > 0, np.inf, -np.inf), where=q_norms > 0) * (1 - 1e-12)
    local = np.where(need > 0, np.divide(need, longest, out=np.full(len(need), np.inf), where=longest > 0), -np.inf)
    alive = np.flatnonzero(local <= 1)
    if not len(alive):
        return
    by_coordinate = float(np.median(local[alive])) >= switch
    order = np.argsort(-p_norms, kind="stable")
    p_ids, p_norms, p = p_ids[order], p_norms[order], p[order]
    bound = float(q_norms.max(initial=0.0)) * longest
    if by_coordinate:
        unit = np.divide(p, p_norms[:, None], out=np.zeros(p.shape), where=p_norms[:, None] > 0)
    scores = None
    if not by_coordinate:
        # lengths fall, so the vectors that are long enough for any of the queries come first
        upto = int(np.searchsorted(-p_norms, -max(0.0, float(need[alive].min())), side="right"))
        scores = _products(q[alive], p[:upto], bound)
    for row, i in enumerate(alive):
        if by_coordinate:
            upto = int(np.searchsorted(-p_norms, -max(0.0, need[i]), side="right"))
            own = q[i] / q_norms[i] if q_norms[i] > 0 else np.zeros(q.shape[1])
            keep = np.ones(upto, dtype=bool)
            # without a positive threshold any direction may score
            for f in np.argsort(-np.abs(own))[:focus] if local[i] > 0 else ():
                spread = np.sqrt(max(0.0, (1 - local[i] ** 2) * (1 - own[f] ** 2))) + 1e-9
                keep &= (unit[:upto, f] >= own[f] * local[i] - spread) | (own[f] < 0)
                keep &= (unit[:upto, f] <= own[f] * local[i] + spread) | (own[f] > 0)
            at = np.flatnonzero(keep)
            s = _products(q[i:i + 1], p[at], bound)[0]
        else:
            at, s = np.arange(scores.shape[1]), scores[row]
        ok = (p_ids[at] != q_ids[i]) & (s >= floor[i])
        at, s = at[ok], s[ok]
        if len(s) > 4 * k:
            # every candidate that ties with the k-th stays until ids decide; ids may come several times
            cut = np.partition(s, len(s) - 2 * k)[len(s) - 2 * k]
            if len(np.unique(p_ids[at[s >= cut]])) >= k:
                at, s = at[s >= cut], s[s >= cut]
        best = np.lexsort((p_ids[at], -s))
        _, first = np.unique(p_ids[at[best]], return_index=True)
        best = best[np.sort(first)][:k]
        yield i, p_ids[at[best]], s[best]


def _search(pairs: DataFrame, k: int, focus: int, switch: float) -> DataFrame:
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                q_ids, q_norms, q = _matrix({x: r["q_" + x] for x in ("dim", "n", "ids", "norms", "vectors")})
                p_ids, p_norms, p = _matrix(r)
                floor = np.frombuffer(r["floor"], dtype=np.float64) if r["floor"] is not None else np.full(len(q_ids), -np.inf)
                found = list(_retrieve(q_ids, q_norms, q, floor, p_ids, p_norms, p, k, focus, switch))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([q_ids[i] for i, _, _ in found], [len(s) for _, s, _ in found])),
                         pa.array(np.concatenate([s for _, s, _ in found])), pa.array(np.concatenate([s for _, _, s in found]))],
                        names=["query_id", "id", "score"])

    columns = [f"q_{c}" for c in ("dim", "n", "ids", "norms", "vectors")]
    return pairs.select(*columns, "floor", "dim", "n", "ids", "norms", "vectors").mapInArrow(run, "query_id long, id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024,
          bucket_bytes: int = 8 << 20, bucket_rows: int = 8192, query_block: int = 1024, focus: int = 8, switch: float = 0.9) -> DataFrame:
    """(query_id, rank, ``id_col``, score): the ``k`` greatest integer products of every row for which ``is_query`` holds.

    ``switch`` is the median local cosine threshold from which on a bucket prunes by ``focus`` coordinates instead of by length.
    """
    spark = vectors.sparkSession
    ready = integers(vectors, id_col, vector_col, scale).withColumn("dim", F.size("v")).withColumn(
        "norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    ready = written(ready, "topk-vectors")
    stats = ready.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    rows = max(1, min(bucket_rows, bucket_bytes // (8 * max(1, stats.dim or 1))))
    parts = max(1, -(-stats.n // rows))
    buckets = _pack(ready.repartitionByRange(parts, "dim", F.desc("norm"), "id").sortWithinPartitions("dim", F.desc("norm"), "id"), bucket_bytes, bucket_rows)
    # buckets of each dimension are numbered from the longest vectors on
    keys = written(buckets.withColumn("key", F.xxhash64("ids", "vectors")), "topk-buckets")
    order = Window.partitionBy("dim").orderBy(F.desc("longest"), "key")
    numbered = keys.select("key", "dim", "longest").withColumn("bucket", F.row_number().over(order))
    asked = ready.withColumnRenamed("id", id_col).filter(is_query).withColumnRenamed(id_col, "id")
    blocks = _pack(asked.repartitionByRange(max(1, -(-stats.n // (100 * query_block))), "dim", "id").sortWithinPartitions("dim", "id"), bucket_bytes, query_block)
    blocks = written(blocks.select(F.xxhash64("ids", "vectors").alias("block"), *[F.col(c).alias(f"q_{c}") for c in ("dim", "n", "ids", "norms", "vectors")]), "topk-queries")

    first = numbered.filter("bucket = 1").join(keys, ["key", "dim", "longest"])
    start = written(_search(blocks.join(first, F.col("q_dim") == F.col("dim")).withColumn("floor", F.lit(None).cast("binary")), k, focus, switch), "topk-first")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    # several vectors of one id give it one score
    kth = start.groupBy("query_id", "id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))

    ids = blocks.mapInArrow(_block_ids, "block long, at int, query_id long, norm double")
    floors = (ids.join(kth, "query_id", "left").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("at", F.col("kth").cast("double").alias("kth")))).alias("kths"),
        # the shortest vector that may still help some query of the block
        F.min(F.when(F.col("kth").isNull() | (F.col("kth") <= 0), 0.0).otherwise(F.when(F.col("norm") > 0, F.col("kth") / F.col("norm")))).alias("need")))
    floors = floors.mapInArrow(_pack_floors, "block long, floor binary, need double")
    rest = numbered.filter("bucket > 1")
    meta = blocks.select("block", "q_dim").join(floors.select("block", "need"), "block").join(rest, F.col("q_dim") == F.col("dim"))
    pairs = meta.filter(F.col("longest") >= F.col("need") * (1 - 1e-9)).select("block", "key")
    work = pairs.join(blocks, "block").join(floors.select("block", "floor"), "block").join(keys, "key").repartition(max(parts, spark.sparkContext.defaultParallelism), "block", "key")
    found = start.union(_search(work, k, focus, switch))
    ranked = (found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
              .withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def _block_ids(batches):
    for b in batches:
        for r in b.to_pylist():
            ids = np.frombuffer(r["q_ids"], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), r["block"])), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids),
                 pa.array(np.frombuffer(r["q_norms"], dtype=np.float64))], names=["block", "at", "query_id", "norm"])


def _pack_floors(batches):
    for b in batches:
        for r in b.to_pylist():
            floor = np.array([-np.inf if x["kth"] is None else x["kth"] for x in r["kths"]], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([r["block"]]), pa.array([floor.tobytes()], pa.binary()), pa.array([r["need"]], pa.float64())],
                                             names=["block", "floor", "need"])
