"""Token counts per document from the counts of distinct pre-tokens.

1. Each task splits a block of documents into pre-tokens and turns them around: for every distinct pre-token of the block, the
   block's documents that hold it and how often. These postings are dealt by pre-token.
2. Where a pre-token's postings meet, its pieces are counted once by the tokenizer library, joined to the postings and
   summed per document of each block. Ids are never kept.
3. The partial sums of a block meet the block's list of documents.

A pre-token that more than ``hot_share`` of a block's documents hold is dealt by block as well, so that a word of every
document does not meet in one task; its pieces are then counted in several tasks, with equal results.

Strings of special tokens inside a text are cut out first, as the library does by default, and count as pre-tokens of their own.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; rows come out as often as they came in, with their id as it was (NULL too);
a text of any length is counted whole; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

_ROW = "place long, block long, pieces array<string>, n_docs binary, docs binary, times binary, ids array<long>, n_bytes array<long>"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
_BLOCK_ROWS, _BLOCK_CHARS = 60_000, 24_000_000


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _splitter(path: str, pattern: str):
    """Pre-tokens of a text; special strings are cut out first."""
    with open(path, encoding="utf-8") as f:
        special = sorted((t["content"] for t in json.load(f).get("added_tokens", ())), key=len, reverse=True)
    find = regex.compile(pattern).findall
    if not special:
        return find
    cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")

    def split(text: str) -> list[str]:
        if not any(s in text for s in special):
            return find(text)
        out = []
        for k, part in enumerate(cut.split(text)):
            out += [part] if k % 2 else find(part)
        return out

    return split


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


def count_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512,
                 places: int | None = None, hot_share: float = 0.02) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``places`` is the number of groups that pre-tokens are dealt into (by default the session's shuffle partitions, 64 at least).
    """
    spark = docs.sparkSession
    places = places or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def turned(ids, texts):
        split = _splitter(tokenizer_path, pattern)
        number: dict[str, int] = {}
        piece, doc, times, n_bytes, digest = [], [], [], [], xxhash.xxh64()
        for d, (i, t) in enumerate(zip(ids, texts, strict=True)):
            raw = t.encode("utf-8", "surrogatepass")
            n_bytes.append(len(raw))
            digest.update(f"{i} {len(raw)} ".encode())
            digest.update(raw)
            counts = Counter(split(t))
            piece.append(np.fromiter((number.setdefault(p, len(number)) for p in counts), dtype=np.int32, count=len(counts)))
            times.append(np.fromiter(counts.values(), dtype=np.int32, count=len(counts)))
            doc.append(np.full(len(counts), d, dtype=np.uint16))
        block = digest.intdigest() - 2**63
        yield _rows([(block % places, block, None, None, None, None, ids, n_bytes)])
        piece, doc, times = np.concatenate(piece), np.concatenate(doc), np.concatenate(times)
        names = list(number)
        n_docs = np.bincount(piece, minlength=len(names))
        place = np.fromiter((xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) % places for p in names), dtype=np.int64, count=len(names))
        place = np.where(n_docs > max(100, hot_share * len(ids)), (place + block) % places, place)
        order = np.argsort(place[piece] * len(names) + piece, kind="stable") if len(piece) else piece
        by_place = np.argsort(place, kind="stable")
        upto = np.concatenate(([0], np.cumsum(n_docs[by_place])))
        edges = np.concatenate((np.flatnonzero(np.diff(place[by_place], prepend=-1)), [len(names)])) if names else np.zeros(1, np.int64)
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            at = order[upto[s]:upto[e]]
            own = np.sort(by_place[s:e])
            yield _rows([(int(place[own[0]]), block, [names[k] for k in own], n_docs[own].astype(np.int32).tobytes(), doc[at].tobytes(),
                          times[at].tobytes(), None, None)])

    def turn(batches):
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= _BLOCK_CHARS or len(ids) >= _BLOCK_ROWS:
                    yield from turned(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from turned(ids, texts)

    def count(batches):
        encode = _tokenizer(tokenizer_path).encode_batch_fast
        known: dict[str, int] = {}
        for b in batches:
            for r in b.to_pylist():
                if r["ids"] is not None:
                    yield _rows([tuple(r[k] for k in _NAMES)])
                    continue
                if len(known) > 1_000_000:
                    known.clear()
                new = [p for p in r["pieces"] if p not in known]
                for s in range(0, len(new), 20_000):
                    part = new[s:s + 20_000]
                    known.update((p, len(e.ids)) for p, e in zip(part, encode(part, add_special_tokens=False), strict=True))
                n = np.fromiter(map(known.__getitem__, r["pieces"]), dtype=np.int64, count=len(r["pieces"]))
                n = np.repeat(n, np.frombuffer(r["n_docs"], dtype=np.int32)) * np.frombuffer(r["times"], dtype=np.int32)
                sums = np.bincount(np.frombuffer(r["docs"], dtype=np.uint16), weights=n).astype(np.int64)
                at = np.flatnonzero(sums)
                yield _rows([(0, r["block"], None, None, at.astype(np.uint16).tobytes(), sums[at].tobytes(), None, None)])

    def gather(batches):
        sums: dict[int, np.ndarray] = {}
        heads: dict[int, list] = {}
        for b in batches:
            for r in b.to_pylist():
                if r["ids"] is not None:
                    heads.setdefault(r["block"], []).append((r["ids"], r["n_bytes"]))
                else:
                    total = sums.setdefault(r["block"], np.zeros(_BLOCK_ROWS, dtype=np.int64))
                    total[np.frombuffer(r["docs"], dtype=np.uint16)] += np.frombuffer(r["times"], dtype=np.int64)
        for block, found in heads.items():
            if block not in sums and any(any(b) for _, b in found):
                raise RuntimeError("the counts of a block are missing: a task that was run again read its rows in another order")
            for ids, n_bytes in found:
                # blocks of equal rows have added to the same sums
                n = sums[block][:len(ids)] // len(found) if block in sums else np.zeros(len(ids), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(n), pa.array(n > limit)],
                    names=["id", "n_bytes", "n_tokens", "over_limit"])

    postings = src.mapInArrow(turn, _ROW).repartition(places, "place")
    partial = postings.mapInArrow(count, _ROW).repartition("block")
    return partial.mapInArrow(gather, "id long, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
