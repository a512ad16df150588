"""Substring deduplication with prefix-partitioned suffix trees over words.

A *window* is ``window`` consecutive words of a document. A window is removed if its words also start earlier
(smaller document id, or the same document further left). Only the first ``window``
words of a suffix matter for that, so the trees are cut at that depth: an internal node at depth
``window`` with several leaves is a repeat, neighbouring ones make up the maximal repeats.

Prefixes split the suffixes into groups. The prefix of a suffix ends with its anchor, the run of
``anchor`` words with the least hash within the window, so prefixes are ``anchor`` to ``window``
words long, and neighbouring suffixes, which mostly share the anchor, travel as one row of
words instead of one row each. Groups are dealt by the anchor that ends their prefix.

1. Count the anchors of all documents (pre-aggregated in each task). An anchor that occurs once ends the
   prefix of no repeat. Those that occur more often are kept as a bitmap of ``2**filter_bits`` bits
   (8 MB, whatever the corpus): a bit too many lets more rows through, none is lost. Anchors with more
   than ``group_rows`` occurrences are listed (at most ``max_hot`` by choice of that number).
2. Each task resolves the repeats among its own documents, and sends on only the first
   occurrence of every window: a text with copies in half of all documents reaches its
   group once per block of documents. Suffixes of listed anchors get the whole window as their prefix, which
   splits their groups further.
3. Each group's subtree is built level by level (nodes at depth 1, 2, 4, ... ``window``, named by sorting pairs
   of nodes), and all leaves of a deep node but the first are removed. Groups are read in order of their prefix and
   handled some at a time, so memory follows the largest group.
4. Removed windows are gathered per document and joined to the texts.

Defined cases: NULL and empty texts have no words; a NULL id sorts after every other; rows with the same id are ordered by
a hash of their text, and rows with the same id and text are one document (their results are equal);
very long texts are cut into overlapping segments; extra columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.llm.common import NULL_ID, fresh, lean, small, table_of, written
from retail_pulse.llm.words import grams, mix, sliding_min, texts_words

_ROW = "gram long, doc long, sig long, start long, n long, words binary"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
                       F.xxhash64(text).alias("sig"), text.alias("text"))


def _blocks(batches, window: int, limit: int):
    """Blocks of about ``limit`` words: documents (doc, sig), word numbers, offsets, and the place of each piece's first word.

    A document of more words comes in pieces that overlap by ``window - 1`` words, so every window start is in one piece.
    """
    docs, pieces, bases, size = [], [], [], 0
    for b in small(batches):
        key, sig = b.column(0).to_numpy(), b.column(1).to_numpy()
        texts = b.column(2).cast(pa.binary()).to_pylist()
        at = 0
        while at < len(texts):
            end, length = at, 0
            while end < len(texts) and (end == at or length + len(texts[end]) < 1 << 20):
                length += len(texts[end]) + 1
                end += 1
            ids, off = texts_words(texts[at:end])
            for d in range(at, end):
                own = ids[off[d - at]:off[d - at + 1]]
                for s in range(0, max(0, len(own) - window + 1), limit):
                    piece = own[s:s + limit + window - 1]
                    docs.append((key[d], sig[d]))
                    pieces.append(piece)
                    bases.append(s)
                    size += len(piece)
                    if size >= limit:
                        yield docs, np.concatenate(pieces), np.cumsum([0, *map(len, pieces)]), np.array(bases)
                        docs, pieces, bases, size = [], [], [], 0
            at = end
    if pieces:
        yield docs, np.concatenate(pieces), np.cumsum([0, *map(len, pieces)]), np.array(bases)


def _anchored(ids: np.ndarray, off: np.ndarray, window: int, anchor: int, known: dict):
    """For every place: whether a window starts there, and the hash of the anchor that ends its prefix."""
    n = len(ids) - window + 1
    ok = np.ones(n, dtype=bool)
    for e in off[1:-1]:
        ok[max(0, e - window + 1):e] = False
    return ok, sliding_min(grams(ids, anchor, known), window - anchor + 1)[:n]


def _anchors(ok: np.ndarray, least: np.ndarray, anchor_hash: np.ndarray, width: int) -> np.ndarray:
    """Hash of every place that is the anchor of some window: the greatest of the minima around it is its own."""
    highest = np.full(len(ok) + 2 * (width - 1), ~np.uint64(0))
    highest[width - 1:width - 1 + len(ok)] = ~np.where(ok, least, np.uint64(0))
    return anchor_hash[~sliding_min(highest, width) == anchor_hash]


def _runs(ok: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of places that are ok and alike in all of ``same``."""
    if not len(ok):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = ok.copy()
    alike = ok[:-1].copy()
    for x in same:
        alike &= x[1:] == x[:-1]
    new[1:] &= ~alike
    starts = np.flatnonzero(new)
    last = ok.copy()
    last[:-1] &= ~(ok[1:] & ~new[1:])
    return starts, np.flatnonzero(last) - starts + 1


def _removed_rows(doc, sig, start, n, gram):
    return pa.RecordBatch.from_arrays(
        [pa.array(gram.astype(np.int64)), pa.array(doc), pa.array(sig), pa.array(start), pa.array(n), pa.nulls(len(doc), pa.binary())],
        names=["gram", "doc", "sig", "start", "n", "words"])


def _dealt(doc: np.ndarray, sig: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Group numbers of rows that need no group: spread, so that copies of one text do not meet in one task."""
    d, s, at = (x.astype(np.int64).view(np.uint64) for x in (doc, sig, start))
    return mix(mix(mix(d) ^ s) + at).view(np.int64)


def _subtrees(words: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Node at depth ``window`` of the suffix that starts at each of ``starts``: equal numbers, equal words."""
    nodes = {1: np.unique(words, return_inverse=True)[1]}

    def at(depth: int) -> np.ndarray:
        if depth not in nodes:
            half = 1 << ((depth - 1).bit_length() - 1)
            a, b = at(half), at(depth - half)
            n = len(words) - depth + 1
            pair = a[:n].astype(np.int64) * (int(b.max()) + 1) + b[half:half + n]
            nodes[depth] = np.unique(pair, return_inverse=True)[1]
        return nodes[depth]

    half = 1 << ((window - 1).bit_length() - 1)
    a, b = at(half), at(window - half)
    return np.unique(a[starts].astype(np.int64) * (int(b.max()) + 1) + b[starts + half], return_inverse=True)[1]


def _resolve(rows: list[tuple], window: int):
    """Removed windows of whole groups: rows are (doc, sig, start, n, words)."""
    doc = np.array([r[0] for r in rows], dtype=np.int64)
    sig = np.array([r[1] for r in rows], dtype=np.int64)
    start = np.array([r[2] for r in rows], dtype=np.int64)
    n = np.array([r[3] for r in rows], dtype=np.int64)
    words = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint64)
    off = np.concatenate(([0], np.cumsum(n + window - 1)[:-1]))
    row = np.repeat(np.arange(len(rows)), n)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    node = _subtrees(words, off[row] + inner, window)
    place = start[row] + inner
    rank = np.empty(len(rows), dtype=np.int64)
    order = np.lexsort((sig, doc))
    new = np.concatenate(([0], (np.diff(doc[order]) != 0) | (np.diff(sig[order]) != 0)))
    rank[order] = np.cumsum(new)
    order = np.lexsort((place, rank[row], node))
    first = np.concatenate(([True], np.diff(node[order]) != 0))
    lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    gone = np.zeros(len(order), dtype=bool)
    gone[order] = (rank[row][lead] != rank[row][order]) | (place[lead] != place[order])
    s, k = _runs(gone, row)
    return doc[row[s]], sig[row[s]], place[s], k


def removed_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, anchor: int = 8,
                    filter_bits: int = 26, group_rows: int = 1000, max_hot: int = 200_000, block_words: int = 1_000_000) -> DataFrame:
    """(doc, sig, spans): for each document with removed windows, the (start, n) runs of removed window starts."""
    if not 1 <= anchor < window:
        raise ValueError("anchor must be shorter than the window")
    sc, src = docs.sparkSession.sparkContext, _keyed(docs, id_col, text_col)
    width = window - anchor + 1

    @lean
    def count(batches):
        for _, ids, off, _ in _blocks(batches, window, block_words):
            ok, least = _anchored(ids, off, window, anchor, {})
            g, n = np.unique(_anchors(ok, least, grams(ids, anchor), width), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    counts = written(src.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1"),
                     "substring-anchors")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = np.array([r.gram for r in counts.filter(F.col("n") > max(group_rows, total // max_hot)).select("gram").collect()], dtype=np.int64)
    bit = F.col("gram").bitwiseAND((1 << filter_bits) - 1)
    bits = (counts.groupBy(F.shiftright(bit, 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(gram & 63 AS int))")).alias("bits")))
    bitmap = table_of(bits, max(1, 1 << (filter_bits - 6))).view(np.uint64)
    shared = sc.broadcast((bitmap, np.sort(hot)))

    @lean
    def suffixes(batches):
        bitmap, hot = shared.value
        low = np.uint64((1 << filter_bits) - 1)
        for keys, ids, off, bases in _blocks(batches, window, block_words):
            known = {}
            ok, least = _anchored(ids, off, window, anchor, known)
            ok &= ((bitmap[(least & low) >> np.uint64(6)] >> (least & np.uint64(63))) & np.uint64(1)).astype(bool)
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            whole = grams(ids, window, known)
            piece = np.searchsorted(off, at, side="right") - 1
            doc = np.array([k[0] for k in keys], dtype=np.int64)
            sig = np.array([k[1] for k in keys], dtype=np.int64)
            by = np.lexsort((sig, doc))
            rank = np.empty(len(keys), dtype=np.int64)
            rank[by] = np.cumsum(np.concatenate(([0], (np.diff(doc[by]) != 0) | (np.diff(sig[by]) != 0))))
            place = bases[piece] + at - off[piece]
            order = np.lexsort((place, rank[piece], whole[at]))
            w = whole[at][order]
            first = np.concatenate(([True], w[1:] != w[:-1]))
            lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            gone = np.zeros(len(at), dtype=bool)
            gone[order] = (rank[piece][lead] != rank[piece][order]) | (place[lead] != place[order])
            stays = np.zeros(len(at), dtype=bool)
            stays[order[first]] = True
            flag = np.zeros(len(ok), dtype=bool)
            flag[at[gone]] = True
            owner = np.zeros(len(ok), dtype=np.int32)
            owner[at] = piece
            s, n = _runs(flag, owner)
            p = owner[s]
            if len(s):
                yield _removed_rows(doc[p], sig[p], bases[p] + s - off[p], n, _dealt(doc[p], sig[p], bases[p] + s - off[p]))
            flag[:] = False
            flag[at[stays]] = True
            key = least.copy()
            if len(hot):
                spot = np.minimum(np.searchsorted(hot, least.view(np.int64)), len(hot) - 1)
                is_hot = hot[spot] == least.view(np.int64)
                key = np.where(is_hot, mix(least ^ whole[:len(least)]), least)
            s, n = _runs(flag, key, owner)
            p = owner[s]
            for i in range(0, len(s), 20_000):
                j = slice(i, i + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[s[j]].view(np.int64)), pa.array(doc[p[j]]), pa.array(sig[p[j]]), pa.array(bases[p[j]] + s[j] - off[p[j]]),
                     pa.array(n[j]), pa.array([ids[x:x + k + window - 1].tobytes() for x, k in zip(s[j], n[j], strict=True)], pa.binary())],
                    names=["gram", "doc", "sig", "start", "n", "words"])

    @lean
    def resolve(batches):
        rows, grams_seen, size = [], None, 0
        for b in batches:
            gram, start, n = (b.column(i).to_numpy() for i in (0, 3, 4))
            doc, sig = b.column(1).to_numpy(), b.column(2).to_numpy()
            none = b.column(5).is_null().to_numpy(zero_copy_only=False)
            if none.any():
                yield _removed_rows(doc[none], sig[none], start[none], n[none], gram[none])
            words = b.column(5).to_pylist()
            for i in np.flatnonzero(~none):
                if size >= 200_000 and gram[i] != grams_seen:
                    out = _resolve(rows, window)
                    if len(out[0]):
                        yield _removed_rows(*out, out[1])
                    rows, size = [], 0
                rows.append((doc[i], sig[i], start[i], n[i], words[i]))
                size += len(words[i]) // 8
                grams_seen = gram[i]
        if rows:
            out = _resolve(rows, window)
            if len(out[0]):
                yield _removed_rows(*out, out[1])

    found = (src.mapInArrow(suffixes, _ROW).repartition("gram").sortWithinPartitions("gram").mapInArrow(resolve, _ROW))
    return found.groupBy("doc", "sig").agg(F.collect_set(F.struct("start", "n")).alias("spans"))  # equal rows find the same spans


def _kept(words: list[bytes], spans, window: int) -> list[bytes]:
    """Words that no removed window covers."""
    if not spans.is_valid or not len(spans.values):
        return words
    s = spans.values.field("start").to_numpy()
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, s, 1)
    np.add.at(edge, s + spans.values.field("n").to_numpy() + window - 1, -1)
    return list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))


def _with_spans(docs: DataFrame, id_col: str, text_col: str, window: int, options: dict) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and the removed windows of each row in a column of the returned name."""
    removed = written(removed_windows(docs, id_col, text_col, window, **options), "substring-removed")
    spans = fresh(docs.columns, "spans")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    same = (F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)) == removed["doc"]) & (F.xxhash64(text) == removed["sig"])
    # the file holds lists packed far below their size in memory: by its size Spark would broadcast ten times as much
    return docs.join(removed.withColumnRenamed("spans", spans).hint("merge"), same, "left").drop(removed["doc"], removed["sig"]), spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, **options) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words joined by one space."""
    both, spans = _with_spans(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text", window, options)

    @lean
    def digest(batches):
        for b in batches:
            n_words, n_gone, sums = [], [], []
            for text, spans in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2), strict=True):
                words = (text or b"").split()
                kept = _kept(words, spans, window)
                n_words.append(len(words))
                n_gone.append(len(words) - len(kept))
                sums.append(sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(sums, pa.string())],
                names=["id", "n_words", "n_removed", "kept_sha256"])

    return both.select("id", "text", spans).mapInArrow(digest, "id long, n_words long, n_removed long, kept_sha256 string").withColumnRenamed("id", id_col)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", window: int = 20, **options) -> DataFrame:
    """The rows of ``docs`` with the repeats cut from their text; rows that lose all their words, or have none, go.

    Texts that lose nothing stay as they are, others keep their words joined by one space; ``length_col`` follows, if it is there.
    """
    both, spans = _with_spans(docs, id_col, text_col, window, options)
    columns = [*docs.columns, spans]
    at, length = columns.index(text_col), columns.index(length_col) if length_col in columns else None
    kinds = {f.name: f.dataType for f in docs.schema.fields}

    @lean
    def cut(batches):
        for b in batches:
            texts, keep = [], []
            for text, spans in zip(b.column(at).cast(pa.binary()).to_pylist(), b.column(len(columns) - 1), strict=True):
                words = (text or b"").split()
                kept = _kept(words, spans, window)
                keep.append(bool(kept))
                texts.append(text if len(kept) == len(words) else b" ".join(kept))
            cols = b.columns[:-1]
            cols[at] = pa.array(texts, pa.binary()).cast(pa.string())
            if length is not None:
                cols[length] = pc.utf8_length(cols[at]).cast(cols[length].type)
            yield pa.RecordBatch.from_arrays(cols, names=columns[:-1]).filter(pa.array(keep, pa.bool_()))

    if not isinstance(kinds[text_col], T.StringType):
        raise TypeError(f"{text_col} must be a string column")
    return both.select(columns).mapInArrow(cut, docs.schema)
