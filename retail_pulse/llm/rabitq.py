"""Embedding near-duplicates: binary codes of randomly rotated vectors decide which pairs are computed exactly.

All pairs with a cosine of at least ``threshold`` are linked. Equal vectors are one item; then:

1. **Balls.** In a bucket of vectors whose rotated signs agree, vectors near a common centre become a ball (centre, radius) if the radius is at most half the angle
   of the threshold: by the triangle inequality all its members are linked with each other, whatever their number, without comparing them. Balls are merged again in
   buckets of other signs, with certified radii, until their number stays; a group of copies of any size ends as a few balls.
2. **Codes.** A random rotation turns a centre into a point whose signs are its code (one bit per dimension). Stored beside it are the correction factor (the
   product of the rotated vector with its own code) and the rotated values themselves, rounded at random to four bits. ``<code a, rounded b> / factor a`` is an unbiased
   estimate of the cosine of a and b, with an error that is below ``confidence`` standard deviations of the random rotation; where both directions rule a pair out by
   that bound, it is dropped, all other pairs are computed exactly.
3. **Candidates** share ``bits`` signs in one of several tables of further rotations. The number of tables follows from the number of items, so that a pair right at the threshold
   meets in at least one table with probability ``recall`` (nearer pairs much more often). A pair is judged only in the first table in which it meets, so nothing
   has to be made distinct. Only codes travel with the tables; the vectors join the surviving pairs.
4. **Exact.** The angle of two centres and their radii link all members, none, or leave the pair undecided (single vectors are always decided); the members of undecided pairs are
   compared in blocks, which emit counts, not pairs.

Buckets above ``block`` rows are split, and every two of their blocks meet in a task of their own; so no group is held by one task, and none is capped.

Defined cases: vectors that are NULL, empty, all zero, or hold a NULL or non-finite component link with nothing, like vectors of different dimensions; equal rows link with each other; a row
with a NULL id takes part but is never the smallest id of a class unless all ids of the class are NULL; ids may repeat; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_pulse.llm.common import written
from retail_pulse.llm.simhash import components
from retail_pulse.llm.vectors import usable

_BALL = "item long, dim int, centre binary, radius double, weight long"
_SLACK = 1e-6  # radians: angles are rounded, certified radii must not be too small
_LEVELS = 15


@lru_cache(maxsize=64)
def rotation(dim: int, number: int) -> np.ndarray:
    """The ``number``-th random rotation of a dimension; the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _signs(x: np.ndarray, first: int, count: int) -> np.ndarray:
    """``count`` sign bits of each row from number ``first`` on: those of rotation 1, then 2, ..."""
    dim, out = x.shape[1], []
    for number in range(first // dim, (first + count - 1) // dim + 1):
        out.append(x @ rotation(dim, number + 1).T > 0)
    skip = first - first // dim * dim
    return np.hstack(out)[:, skip:skip + count]


def _bands(x: np.ndarray, bits: int, tables: int, first: int = 0) -> np.ndarray:
    """(rows x tables) longs: ``bits`` signs for each table."""
    if not bits:
        return np.zeros((len(x), tables), dtype=np.int64)
    signs = _signs(x, first, bits * tables).reshape(len(x), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _centres(batch: pa.RecordBatch, name: str = "centre") -> np.ndarray:
    return np.frombuffer(b"".join(batch[name].to_pylist()), dtype=np.float64).reshape(batch.num_rows, -1)


def _by_dimension(batches, rows: int):
    """Record batches of rows of one dimension, at most ``rows`` each."""
    for b in batches:
        dims = b["dim"].to_numpy()
        for d in np.unique(dims):
            same = pa.Table.from_batches([b]).filter(pa.array(dims == d)).combine_chunks().to_batches() if (dims != d).any() else [b]
            for s in same:
                for at in range(0, s.num_rows, rows):
                    yield s.slice(at, rows)


def _groups(batches, keys: list[str]):
    """Tables of neighbouring rows with equal ``keys`` of partitions that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        columns = [b[k].to_numpy() for k in keys]
        change = np.zeros(b.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for s, e in zip(starts, starts[1:], strict=False):
            if s == e:
                continue
            key = tuple(c[s] for c in columns)
            if key != last and held:
                yield last, pa.Table.from_batches(held).combine_chunks()
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield last, pa.Table.from_batches(held).combine_chunks()


def _table_centres(t: pa.Table, name: str = "centre") -> np.ndarray:
    return np.frombuffer(b"".join(t[name].to_pylist()), dtype=np.float64).reshape(t.num_rows, -1)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


# ---- 1. balls ---------------------------------------------------------------

def _gather(centre: np.ndarray, radius: np.ndarray, weight: np.ndarray, most: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Groups of the rows that fit into one ball of radius ``most``: (rows, centre, radius), at least two rows each."""
    near = centre @ centre.T >= np.cos(most)
    np.fill_diagonal(near, False)
    degree = near.sum(axis=1)
    free = np.ones(len(centre), dtype=bool)
    out = []
    for lead in np.argsort(-degree, kind="stable"):
        if not degree[lead]:
            break
        if not free[lead]:
            continue
        rows = np.flatnonzero(free & near[lead])
        rows = np.append(rows, lead)
        if len(rows) < 2:
            continue
        mid = (centre[rows] * weight[rows, None]).sum(axis=0)
        length = np.linalg.norm(mid)
        if length == 0:
            continue
        mid /= length
        reach = _angle(centre[rows] @ mid) + radius[rows] + _SLACK
        rows, reach = rows[reach <= most], reach[reach <= most]
        if len(rows) >= 2:
            free[rows] = False
            out.append((rows, mid, float(reach.max())))
    return out


def _merge_round(balls: DataFrame, bits: int, number: int, most: float, block: int) -> DataFrame:
    """(item, into, centre, radius, weight): each ball with the ball that it became part of in a bucket of ``bits`` signs."""
    def key(batches):
        for b in _by_dimension(batches, 4096):
            band = _bands(_centres(b), bits, 1, first=number * bits)[:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(band)], names=[*b.schema.names, "band"])

    keyed = balls.mapInArrow(key, _BALL + ", band long")
    # a bucket that holds many rows is dealt out by its own size, so no task gets more than about ``block`` of a bucket
    sizes = keyed.groupBy("dim", "band").agg(F.ceil(F.count("*") / block).alias("cuts"))
    dealt = keyed.join(sizes, ["dim", "band"]).withColumn("cut", F.pmod(F.xxhash64("item", F.lit(number)), "cuts"))

    def merge(batches):
        for _, t in _groups(batches, ["dim", "band", "cut"]):
            for at in range(0, t.num_rows, 2 * block):
                s = t.slice(at, 2 * block)
                centre, radius, weight, item = _table_centres(s), s["radius"].to_numpy().copy(), s["weight"].to_numpy().copy(), s["item"].to_numpy()
                into, packed = item.copy(), s["centre"].to_pylist()
                for rows, mid, reach in _gather(centre, radius, weight.astype(np.float64), most):
                    into[rows], radius[rows], weight[rows] = item[rows].min(), reach, weight[rows].sum()
                    for r in rows:
                        packed[r] = mid.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(into), s["dim"].combine_chunks(), pa.array(packed, pa.binary()), pa.array(radius), pa.array(weight)],
                                                 names=["item", "into", "dim", "centre", "radius", "weight"])

    return (dealt.repartition("dim", "band", "cut").sortWithinPartitions("dim", "band", "cut")
            .select("item", "dim", "centre", "radius", "weight", "band", "cut").mapInArrow(merge, "item long, into long, dim int, centre binary, radius double, weight long"))


def gather_balls(items: DataFrame, most: float, block: int = 2048, rounds: int = 5) -> tuple[DataFrame, DataFrame, int]:
    """(balls, home, number): the balls, and (item, ball) for every item. More rounds only save comparisons; no result depends on them."""
    balls, home, n = items, items.select("item", F.col("item").alias("ball")), items.count()
    for number in range(rounds):
        merged = written(_merge_round(balls, _bits(n, block), number, most, block), "rabitq-merge")
        balls = merged.filter("item = into").select("item", "dim", "centre", "radius", "weight")
        moves = merged.select(F.col("item").alias("ball"), "into")
        home = written(home.join(moves, "ball").select("item", F.col("into").alias("ball")), "rabitq-home")
        before, n = n, balls.count()
        if n > 0.99 * before:
            break
    return balls, home, n


def _bits(n: int, block: int) -> int:
    """Signs of a bucket so that even buckets hold about half a block."""
    return min(48, max(0, ceil(log2(max(1, n) / (block / 2)))))


# ---- 2., 3. codes and candidates ----------------------------------------------

def tables_for(bits: int, threshold: float, recall: float) -> int:
    """Tables of ``bits`` signs in which a pair at the threshold meets at least once with probability ``recall``."""
    if not bits:
        return 1
    meet = (1 - acos(threshold) / pi) ** bits
    return ceil(log(1 - recall) / log(1 - meet))


def encode(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of unit vectors: packed signs, packed four-bit values, their offset and step, and the correction factor."""
    dim = x.shape[1]
    turned = x @ rotation(dim, 0).T
    signs = turned > 0
    factor = np.abs(turned).sum(axis=1) / np.sqrt(dim)
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / _LEVELS, np.finfo(np.float64).tiny)
    exact = (turned - low[:, None]) / step[:, None]
    # rounding at random keeps the estimate unbiased
    level = np.clip(np.floor(exact + np.random.default_rng(seed).random(exact.shape)), 0, _LEVELS).astype(np.uint8)
    if dim % 2:
        level = np.hstack([level, np.zeros((len(x), 1), np.uint8)])
    return np.packbits(signs, axis=1), level[:, ::2] | (level[:, 1::2] << 4), low, step, factor


def estimates(signs: np.ndarray, factor: np.ndarray, levels: np.ndarray, low: np.ndarray, step: np.ndarray, dim: int) -> np.ndarray:
    """Estimated cosine of every coded row (first two arguments) with every rounded row (the others)."""
    code = np.unpackbits(signs, axis=1)[:, :dim].astype(np.float32) * 2 - 1
    value = np.empty((len(levels), levels.shape[1] * 2), np.float32)
    value[:, ::2], value[:, 1::2] = levels & 15, levels >> 4
    value = value[:, :dim] * step[:, None].astype(np.float32) + low[:, None].astype(np.float32)
    return (code / (factor[:, None] * np.sqrt(dim)).astype(np.float32)) @ value.T


def error_bound(factor: np.ndarray, step: np.ndarray, dim: int, confidence: float) -> np.ndarray:
    """``confidence`` standard deviations of the estimates of coded rows (factor) with rounded rows (step)."""
    code = (1 / np.maximum(factor, 1e-9) ** 2 - 1) / max(1, dim - 1)
    return confidence * np.sqrt(np.maximum(code, 0)[:, None] + (step[None, :] / 2 / np.maximum(factor, 1e-9)[:, None]) ** 2)


_CODE = "item long, dim int, radius double, signs binary, levels binary, low double, step double, factor double, bands binary"


def _coded(balls: DataFrame, bits: int, tables: int) -> DataFrame:
    def run(batches):
        for b in _by_dimension(batches, 4096):
            x, item = _centres(b), b["item"].to_numpy()
            signs, levels, low, step, factor = encode(x, int(item[0]) & 0x7FFFFFFF)
            bands = _bands(x, bits, tables, first=bits)
            yield pa.RecordBatch.from_arrays(
                [b["item"], b["dim"], b["radius"], *[pa.array([r.tobytes() for r in m], pa.binary()) for m in (signs, levels)],
                 pa.array(low), pa.array(step), pa.array(factor), pa.array([r.tobytes() for r in bands.astype("<i8")], pa.binary())],
                names=["item", "dim", "radius", "signs", "levels", "low", "step", "factor", "bands"])

    return balls.select("item", "dim", "centre", "radius").mapInArrow(run, _CODE)


def _one_per_table(coded: DataFrame, tables: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 2048):
                part = b.slice(s, 2048)
                bands = np.frombuffer(b"".join(part["bands"].to_pylist()), "<i8").reshape(part.num_rows, tables)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, t, np.int32)), pa.array(bands[:, t])],
                                                     names=[*part.schema.names, "nth", "band"])

    return coded.mapInArrow(run, _CODE + ", nth int, band long")


def candidates(balls: DataFrame, n: int, threshold: float, recall: float, confidence: float, block: int) -> DataFrame:
    """(a, b): pairs of items that share a bucket and that the codes cannot rule out, each once."""
    bits = _bits(n, block)
    tables = tables_for(bits, threshold, recall)
    angle = acos(threshold)
    coded = written(_coded(balls, bits, tables), "rabitq-codes")
    rows = _one_per_table(coded, tables)
    sizes = rows.select("dim", "nth", "band").groupBy("dim", "nth", "band").agg(F.ceil(F.count("*") / block).alias("cuts"))
    dealt = rows.join(sizes, ["dim", "nth", "band"]).withColumn("own", F.pmod(F.xxhash64("item"), "cuts"))
    # two blocks of a bucket meet under the key (lower, higher)
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))).withColumn(
        "lower", F.least("own", "other")).withColumn("higher", F.greatest("own", "other"))
    keys = ["dim", "nth", "band", "lower", "higher"]

    def judge(batches):
        for (dim, nth, _, lower, higher), t in _groups(batches, keys):
            item, own = t["item"].to_numpy(), t["own"].to_numpy()
            signs, levels = (np.frombuffer(b"".join(t[c].to_pylist()), np.uint8).reshape(t.num_rows, -1) for c in ("signs", "levels"))
            low, step, factor, radius = (t[c].to_numpy() for c in ("low", "step", "factor", "radius"))
            bands = np.frombuffer(b"".join(t["bands"].to_pylist()), "<i8").reshape(t.num_rows, tables)
            left = np.flatnonzero(own == lower)
            right = np.flatnonzero(own == higher)
            for s in range(0, len(left), 512):
                i = left[s:s + 512]
                for r in range(0, len(right), 4096):
                    j = right[r:r + 4096]
                    reach = np.cos(np.minimum(pi, angle + radius[i][:, None] + radius[j][None, :]))
                    there = estimates(signs[i], factor[i], levels[j], low[j], step[j], dim) + error_bound(factor[i], step[j], dim, confidence) >= reach
                    back = (estimates(signs[j], factor[j], levels[i], low[i], step[i], dim) + error_bound(factor[j], step[i], dim, confidence)).T >= reach
                    x, y = np.nonzero(there | back)
                    x, y = i[x], j[y]
                    ok = item[x] < item[y] if lower == higher else item[x] != item[y]
                    # a pair that already met in an earlier table was judged there
                    ok &= ~(bands[x, :nth] == bands[y, :nth]).any(axis=1)
                    if ok.any():
                        x, y = item[x[ok]], item[y[ok]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return met.select(*_names(_CODE), "nth", "band", "own", "lower", "higher").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(judge, "a long, b long")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


# ---- 4. exact -------------------------------------------------------------------

def _decided(pairs: DataFrame, balls: DataFrame, threshold: float) -> DataFrame:
    """(a, b, weight_a, weight_b, all): pairs of balls of which all members are linked, or (all = false) some may be."""
    angle = acos(threshold)

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 4096):
                p = b.slice(s, 4096)
                cosine = np.fromiter((np.dot(np.frombuffer(u), np.frombuffer(v)) for u, v in zip(p["centre_a"].to_pylist(), p["centre_b"].to_pylist(), strict=True)), np.float64, p.num_rows)
                spread = p["radius_a"].to_numpy() + p["radius_b"].to_numpy()
                between = _angle(cosine)
                single = spread == 0
                linked = np.where(single, cosine >= threshold, between + spread + _SLACK <= angle)
                maybe = ~single & ~linked & (between - spread - _SLACK <= angle)
                keep = pa.array(linked | maybe)
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (p["a"], p["b"], p["weight_a"], p["weight_b"], pa.array(linked))], names=["a", "b", "weight_a", "weight_b", "all"])

    def side(x: str) -> DataFrame:
        return balls.select(F.col("item").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("centre", "radius", "weight")])

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    columns = ["a", "b", *[f"{c}_{x}" for x in "ab" for c in ("centre", "radius", "weight")]]
    return joined.select(*columns).mapInArrow(run, "a long, b long, weight_a long, weight_b long, all boolean")


def _compared(open_: DataFrame, members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a, b, item, n): the members of undecided pairs of balls with what they are linked to on the other side."""
    sizes = members.groupBy("ball").agg(F.ceil(F.count("*") / block).alias("cuts"))
    a, b = (sizes.select(F.col("ball").alias(x), F.col("cuts").alias(f"cuts_{x}")) for x in "ab")
    wanted = open_.select("a", "b").join(a, "a").join(b, "b")

    def side(own: str, other: str) -> DataFrame:
        m = members.select(F.col("ball").alias(own), "item", "vector", "weight")
        cut = F.pmod(F.xxhash64("item"), F.col(f"cuts_{own}")).alias(f"at_{own}")
        return (wanted.join(m, own).select("a", "b", "item", "vector", "weight", cut, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"cuts_{other}") - 1)).alias(f"at_{other}"),
                                           F.lit(own == "a").alias("first")).select("a", "b", "at_a", "at_b", "first", "item", "vector", "weight"))

    keys = ["a", "b", "at_a", "at_b"]

    def run(batches):
        for (a, b, _, _), t in _groups(batches, keys):
            x, first = _table_centres(t, "vector"), t["first"].to_numpy(zero_copy_only=False)
            item, weight = t["item"].to_numpy(), t["weight"].to_numpy()
            i, j = np.flatnonzero(first), np.flatnonzero(~first)
            if not len(i) or not len(j):
                continue
            linked = x[i] @ x[j].T >= threshold
            got = np.concatenate([linked @ weight[j], linked.T @ weight[i]])
            hit = np.flatnonzero(got)
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), a)), pa.array(np.full(len(hit), b)), pa.array(np.concatenate([item[i], item[j]])[hit]), pa.array(got[hit])],
                                                 names=["a", "b", "item", "n"])

    both = side("a", "b").unionByName(side("b", "a"))
    return both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long, item long, n long")


def _unit(rows: DataFrame) -> DataFrame:
    """(item, dim, centre, radius, weight) of distinct vectors (item, v, weight): unit vectors as packed doubles."""
    def run(batches):
        for b in _by_dimension(batches, 4096):
            x = b["v"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays([b["item"], b["dim"], pa.array([r.tobytes() for r in x], pa.binary()), pa.array(np.zeros(len(x))), b["weight"]],
                                             names=["item", "dim", "centre", "radius", "weight"])

    return rows.select("item", F.size("v").alias("dim"), "v", "weight").mapInArrow(run, _BALL)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = 0.99,
                    confidence: float = 3.0, block: int = 2048) -> DataFrame:
    """One row per row of ``vectors``: ``id_col``, ``n_links``, ``component_id`` (the smallest id reachable by links) and ``kept``."""
    if not 0 < threshold < 1:
        raise ValueError("threshold must be between 0 and 1")
    v = F.col(vector_col)
    part: Column = usable(v) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are one value
    key = F.when(part, F.transform(v, lambda x: x.cast("double") + F.lit(0.0)))
    rows = written(vectors.select(F.col(id_col).cast("long").alias("id"), key.alias("v")).withColumn("sig", F.xxhash64("v")), "rabitq-rows")
    distinct = written(rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
                       .withColumn("item", F.monotonically_increasing_id()), "rabitq-items")
    items = written(_unit(distinct), "rabitq-units")
    balls, home, n = gather_balls(items, acos(threshold) / 2 - _SLACK, block)
    pairs = written(candidates(balls, n, threshold, recall, confidence, block), "rabitq-pairs")
    decided = written(_decided(pairs, balls, threshold), "rabitq-decided")
    open_ = decided.filter(~F.col("all"))
    asked = open_.select(F.explode(F.array("a", "b")).alias("ball")).distinct()
    members = home.join(asked, "ball", "left_semi").join(items.select("item", F.col("centre").alias("vector"), "weight"), "item")
    compared = written(_compared(open_, members, threshold, block), "rabitq-compared")

    edges = decided.filter("all").select("a", "b").union(compared.select("a", "b").distinct())
    roots = components(edges, "rabitq-cc")
    whole = decided.filter("all")
    by_ball = whole.select(F.col("a").alias("ball"), F.col("weight_b").alias("n")).union(whole.select(F.col("b").alias("ball"), F.col("weight_a").alias("n"))).groupBy("ball").agg(F.sum("n").alias("by_ball"))
    by_item = compared.groupBy("item").agg(F.sum("n").alias("by_item"))
    zero = F.lit(0).cast("long")
    per_ball = (balls.select(F.col("item").alias("ball"), F.col("weight").alias("own")).join(by_ball, "ball", "left").join(roots.withColumnRenamed("node", "ball"), "ball", "left")
                .select("ball", (F.col("own") - 1 + F.coalesce("by_ball", zero)).alias("links"), F.coalesce("root", "ball").alias("root")))
    per_item = written(home.join(per_ball, "ball").join(by_item, "item", "left").join(distinct.select("item", "least", "v"), "item")
                       .select("v", F.xxhash64("v").alias("sig"), "least", "root", (F.col("links") + F.coalesce("by_item", zero)).alias("n_links")), "rabitq-result")
    least = per_item.groupBy("root").agg(F.min("least").alias("component"))
    found = per_item.join(least, "root").select(F.col("sig").alias("same_sig"), F.col("v").alias("same_v"), "n_links", "component")
    return rows.join(found, (rows["sig"] == found["same_sig"]) & (rows["v"] == found["same_v"]), "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", zero).alias("n_links"),
        F.when(F.col("same_sig").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id")).withColumn(
            "kept", F.col(id_col).eqNullSafe(F.col("component_id")))
