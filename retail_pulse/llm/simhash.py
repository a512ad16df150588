"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprints are computed per text (64 bits, one vote per shingle). Two fingerprints
are linked if they differ in at most ``max_distance`` bits. Candidates come from the pigeonring
principle: cut the 64 bits into ``SEGMENTS`` on a ring; if the whole distance is at most d,
there is a segment from which on every chain of l consecutive segments has differed
in at most ``floor(l * d / SEGMENTS)`` bits. The first two links of the chain make the join key
(first segment equal, second within its budget, by listing the few variants of it), the longer
chains are checked on the joined pair before the full Hamming distance.

Texts are reduced to distinct fingerprints before anything is joined, so that groups of copies
cost one row. Links between fingerprints become classes by alternating large-star
and small-star steps, each written to the shared folder; nothing but counts reaches the
driver.

Defined cases: NULL and empty texts have fingerprint zero and are linked like any other; repeated
rows come out as often as they came in; a NULL id stays NULL and takes part, but is never the
smallest id of a class unless all ids of the class are NULL; very long texts are voted in blocks;
an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_pulse.llm.common import lean, written

SEED = 42
SEGMENTS = 4
_WIDTH = 64 // SEGMENTS
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the lower-cased words' shingles; a bit is set if over half the shingles set it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    h = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        hashes = np.fromiter((h(joined[s:e], SEED) for s, e in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK], strict=True)),
                             dtype="<u8", count=min(_BLOCK, n - at))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, with_sig: bool = False) -> DataFrame:
    """One row per input row: the id, the xxhash64 ``sig`` of the text if asked for, and the fingerprint as a signed long ``fp``."""
    sig = ["sig"] if with_sig else []

    @lean
    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(fps.view(np.int64))], names=["id", *sig, "fp"])

    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *(F.xxhash64(text).alias(c) for c in sig))
    return src.mapInArrow(run, ", ".join(f"{c} long" for c in ("id", *sig, "fp")))


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, _WIDTH * (i % SEGMENTS)).bitwiseAND((1 << _WIDTH) - 1)


def _flips(budget: int) -> list[int]:
    """All masks of at most ``budget`` bits of one segment."""
    return [sum(1 << b for b in bits) for k in range(budget + 1) for bits in combinations(range(_WIDTH), k)]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """Distinct pairs (a < b) of different fingerprints ``fp`` within ``max_distance`` bits.

    The first segment of a chain must be equal, so ``max_distance`` must be below the number of segments.
    """
    if not 0 <= max_distance < SEGMENTS:
        raise ValueError(f"max_distance must be from 0 to {SEGMENTS - 1}")
    budget = [(k * max_distance) // SEGMENTS for k in range(SEGMENTS + 1)]

    def key(i: int, second: Column) -> Column:
        return F.shiftleft(F.lit(i).cast("long"), 2 * _WIDTH).bitwiseOR(
            F.shiftleft(_segment(F.col("fp"), i), _WIDTH)).bitwiseOR(second)

    probe = fps.select(F.col("fp").alias("a"), F.explode(F.array(*[key(i, _segment(F.col("fp"), i + 1)) for i in range(SEGMENTS)])).alias("key"))
    flips = F.array(*[F.lit(m).cast("long") for m in _flips(budget[2])])

    def variants(i: int) -> Column:
        return F.transform(flips, lambda m: key(i, _segment(F.col("fp"), i + 1).bitwiseXOR(m)))

    stored = fps.select(F.col("fp").alias("b"), F.explode(F.flatten(F.array(*map(variants, range(SEGMENTS))))).alias("key"))
    # Spark sizes a side as the file it comes from, without the explode: left to it, tens of copies of each fingerprint would be broadcast
    pairs = probe.join(stored.hint("merge"), "key").filter(F.col("a") < F.col("b"))
    start = F.shiftrightunsigned(F.col("key"), 2 * _WIDTH)
    x = F.col("a").bitwiseXOR(F.col("b"))
    chains = F.lit(False)
    for i in range(SEGMENTS):
        fits = start == i
        run = F.lit(0)
        for k in range(SEGMENTS):
            run = run + F.bit_count(_segment(x, i + k))
            if k >= 2:
                fits = fits & (run <= budget[k + 1])
        chains = chains | fits
    return (pairs.filter(chains).filter(_distance(F.col("a"), F.col("b")) <= max_distance)
            .select("a", "b").distinct())


def components(edges: DataFrame, purpose: str = "simhash-cc") -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the least node of its component."""
    def size(df):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r.n, r.h

    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), purpose)
    seen = size(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .filter("u <> v").distinct())
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        star = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(star.union(least.select("u", F.col("m").alias("v"))).distinct(), purpose)
        now = size(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _classes(distinct: DataFrame, max_distance: int) -> DataFrame:
    """The rows (fp, least) of distinct fingerprints with the ``root`` of their class."""
    roots = components(links(distinct, max_distance))
    return distinct.join(roots.hint("merge"), distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """(id, sig): one row for each near-duplicate class, its least id (NULL ids last) and, of that id, the least xxhash64 of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(fingerprints(docs.withColumn(text_col, text), id_col, text_col, shingle, with_sig=True), "simhash-keys")
    key = F.struct(F.col("id").isNull().alias("none"), "id", "sig")
    distinct = written(rows.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    return _classes(distinct, max_distance).groupBy("root").agg(F.min("least").alias("least")).select("least.id", "least.sig")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_distance: int = 3) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest id of its class)."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    linked = _classes(distinct, max_distance)
    first = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.join(first, "root").select("fp", "component_id")
    return rows.join(classes.hint("merge"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
