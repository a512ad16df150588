"""Vector code compression: product quantisation whose nearest-entry search intersects sorted slices.

Vectors become integers and are cut into equal consecutive parts; each part position has a codebook. The codebooks start
from the vectors with the smallest ids and are refined by rounds of "assign every part to its nearest entry, replace each entry by
the mean of its parts". A round is one pass over the vectors: tasks sum the parts of each entry, Spark adds the sums up, and the driver
gets one row per entry.

Nearest entry by slice and intersect: for every dimension the entries are sorted by their coordinate, and each place in that order carries
the mask of all entries before it (``entries`` bits in uint64 words). A part first gets a radius: its distance to the best of its
neighbours in the sorted orders. An entry at most that far away lies, in every dimension, within the radius of the part's coordinate; these
entries are a slice of the sorted order, and the masks at the slice's two ends differ in exactly its entries. ANDed over the dimensions the slices
give every entry that can be as near as the radius; only those are measured. The result is exact, with ties to the lower index.

Defined cases: vectors that are NULL, empty, shorter than the longest, or that hold a NULL or non-finite component take no part and have no row; the greatest dimension
must be a multiple of ``parts`` (ValueError otherwise). Rows with a NULL id are encoded but seed a codebook only after all other
rows; repeated rows count as often as they come; rows of one id are ordered by their vectors. With fewer rows than ``entries`` the codebooks are
that much shorter. Components beyond 2**24 or so are handled by exact, slower integers; an error above the range of a long is clipped to
it. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.llm.common import written
from retail_pulse.llm.vectors import dimension, fits, floors, matrix, slices, usable

_LONG = 2**63 - 1
_WORD = 64


class Slices:
    """Nearest entry of one codebook (entries x width, longs)."""

    def __init__(self, book: np.ndarray):
        self.book = book
        n, width = book.shape
        words = -(-n // _WORD)
        own = np.zeros((n, words), dtype=np.uint64)
        own[np.arange(n), np.arange(n) // _WORD] = np.uint64(1) << (np.arange(n) % _WORD).astype(np.uint64)
        self.order = [np.argsort(book[:, d], kind="stable") for d in range(width)]
        self.sorted = [book[o, d] for d, o in enumerate(self.order)]
        # prefix[d][r] holds the first r entries in the order of dimension d
        self.prefix = [np.vstack([np.zeros((1, words), np.uint64), np.bitwise_or.accumulate(own[o], axis=0)]) for o in self.order]
        self.squares = (book.astype(np.float64) ** 2).sum(axis=1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """Squared distance of each row to the best of its neighbours in the sorted orders: no nearest entry is farther."""
        best = np.full(len(x), _LONG)
        for d, (values, order) in enumerate(zip(self.sorted, self.order, strict=True)):
            near = order[np.minimum(np.searchsorted(values, x[:, d]), len(order) - 1)]
            best = np.minimum(best, ((x - self.book[near]) ** 2).sum(axis=1))
        return best

    def candidates(self, x: np.ndarray, squared: np.ndarray) -> np.ndarray:
        """Masks of the entries that lie, in every dimension, within the radius of the row."""
        r = np.sqrt(squared.astype(np.float64)).astype(np.int64) + 1
        mask = None
        for d, (values, prefix) in enumerate(zip(self.sorted, self.prefix, strict=True)):
            part = prefix[np.searchsorted(values, x[:, d] + r, side="right")] ^ prefix[np.searchsorted(values, x[:, d] - r, side="left")]
            mask = part if mask is None else mask & part
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row."""
        if not fits(x, self.book):
            return self._plain(x)
        mask = self.candidates(x, self.radius(x))
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little")[:, :len(self.book)]
        at = np.ascontiguousarray(bits.T)
        values = x.astype(np.float64)
        own = (values ** 2).sum(axis=1)
        index, best = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)
        for e in range(len(self.book)):
            rows = np.flatnonzero(at[e])
            if len(rows):
                # integers below 2**52: every operation is exact
                found = own[rows] - 2 * (values[rows] @ self.book[e].astype(np.float64)) + self.squares[e]
                better = found < best[rows]
                best[rows[better]], index[rows[better]] = found[better], e
        return index, best.astype(np.int64)

    def _plain(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Components too large for 64-bit squares: the same slices, with Python's integers."""
        index, best = [], []
        for row in x.tolist():
            entries = range(len(self.book))
            dist = [sum((a - b) ** 2 for a, b in zip(row, self.book[e].tolist(), strict=True)) for e in (entries[0],)]
            r = isqrt(dist[0])
            near = [e for e in entries if all(abs(a - b) <= r for a, b in zip(row, self.book[e].tolist(), strict=True))]
            d, e = min((sum((a - b) ** 2 for a, b in zip(row, self.book[e].tolist(), strict=True)), e) for e in near)
            index.append(e)
            best.append(min(d, _LONG))
        return np.array(index, dtype=np.int64), np.array(best, dtype=np.int64)


def _parts(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(x, parts, axis=1)]


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, s): the parts nearest to each entry, added up per task."""
    parts, entries, width = books.shape

    def run(batches):
        search = [Slices(b) for b in books]
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, width), dtype=object)
        for b in slices(batches):
            x = matrix(b.column(0), parts * width)
            for p, part in enumerate(_parts(x, parts)):
                index = search[p].nearest(part)[0]
                order = np.argsort(index, kind="stable")
                met, first = np.unique(index[order], return_index=True)
                big = not fits(part)
                total[p][met] += np.add.reduceat(part[order].astype(object) if big else part[order], first, axis=0).astype(object)
                count[p] += np.bincount(index, minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64()),
             pa.array([[Decimal(int(v)) for v in s] for s in total[p, e]], pa.list_(pa.decimal128(38, 0)))], names=["part", "entry", "n", "s"])

    return vectors.mapInArrow(run, "part int, entry int, n long, s array<decimal(38,0)>")


def refine(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every used entry becomes the componentwise floor of the mean of its parts."""
    width = books.shape[2]
    sums = _sums(vectors, books).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"))
    out = books.copy()
    for r in sums.collect():  # at most parts x entries rows
        out[r.part, r.entry] = [int(v) // r.n for v in r.s]
    return out


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codebooks(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> np.ndarray:
    """The codebooks (parts x entries x width) of rows (id, v) of one dimension."""
    seeds = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most ``entries`` rows
    books = np.array([r.v for r in seeds], dtype=np.int64)
    books = np.stack(_parts(books, parts))
    for _ in range(rounds):
        books = refine(vectors.select("v"), books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """The rows (id, v, label) as (id, label, code, error)."""
    parts, _, width = books.shape
    hexes = np.array([f"{e:02x}" for e in range(books.shape[1])], dtype=object)

    def run(batches):
        search = [Slices(b) for b in books]
        for b in slices(batches):
            x = matrix(b.column(1), parts * width)
            found = [s.nearest(p) for s, p in zip(search, _parts(x, parts), strict=True)]
            code = sum((hexes[i] for i, _ in found[1:]), hexes[found[0][0]])
            error = np.minimum(sum(d.astype(object) for _, d in found), _LONG).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(code.tolist(), pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    out = T.StructType([vectors.schema["id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return vectors.select("id", "v", "label").mapInArrow(run, out)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 1024,
             parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """(``id_col``, code, error, label_error, codebooks_sha256) of every usable vector; an index has two hex digits, so ``entries`` is 256 at most."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    ready = written(vectors.filter(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), floors(F.col(vector_col), scale).alias("v"), F.col(label_col).alias("label")), "pq-vectors")
    dim = dimension(ready, "v")
    if dim is None:
        return ready.select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    if dim % parts:
        raise ValueError(f"vectors of dimension {dim} cannot be cut into {parts} equal parts")
    ready = ready.filter(F.size("v") == dim)
    books = codebooks(ready, parts, entries, rounds)
    coded = written(encode(ready, books), "pq-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    by_label = coded.groupBy(F.col("label").alias("same")).agg(total.alias("label_error"))
    # one row per label; AQE broadcasts it if it measures small and otherwise splits the hot labels of the join
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["same"])).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
