"""Byte-level BPE encoding and decoding by merge replay.

Texts are split into pre-tokens by the tokenizer's pattern. A task gathers the distinct pre-tokens of a block of
documents that it has not met yet and encodes them together: an inverted index leads from each mergeable pair to
all places where it stands, merges are applied in rank order to all their places at once, and only the pairs of the
two touched neighbours are entered anew. Each document is then put together from its pre-tokens' ids.

No data moves between tasks and nothing is gathered: the vocabulary that a task remembers is emptied beyond
``remember`` pre-tokens, and a rank file has a fixed size.

The rank file's path is a parameter; it must be readable on every executor.

Defined cases: NULL and empty texts have no ids; special strings are ordinary text; unpaired surrogates cannot be in a Spark string;
texts of any length are encoded whole; rows come out as they came in, extra columns pass through ``encode`` unchanged.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.llm.common import lean, small

_END = -1


class MergeReplay:
    """Encoder and decoder of one rank file."""

    def __init__(self, rank_path: str, pattern: str, remember: int = 250_000, keep=None):
        with open(rank_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.single = [self.ranks[bytes([x])] for x in range(256)]
        #: rank of every pair of bytes
        self.first = [self.ranks.get(bytes([a, b]), _END) for a in range(256) for b in range(256)]
        self.pairs: dict[int, int] = {}
        self.known: dict[str, tuple] = {}
        self.remember = remember
        #: what is remembered of a pre-token's ids
        self.keep = keep or (lambda ids: ids)

    def _rank(self, a: int, b: int) -> int:
        """Rank of the token that two neighbours make together, or _END."""
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > 400_000:
                self.pairs.clear()
            got = self.pairs[key] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], _END)
        return got

    def replay(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece; all pieces are merged together, in rank order."""
        out: list[tuple[int, ...] | None] = [(self.ranks[p],) if p in self.ranks else None for p in pieces]
        token, pair, begins = [_END], [_END], []
        single, first = self.single, self.first
        for i, p in enumerate(pieces):
            if out[i] is None:
                begins.append((i, len(token), len(token) + len(p)))
                token += map(single.__getitem__, p)
                pair += [first[a << 8 | b] for a, b in zip(p, p[1:])]
                token.append(_END)
                pair += (_END, _END)
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        index: dict[int, list[int]] = {}
        for at, r in enumerate(pair):
            if r != _END:
                if r in index:
                    index[r].append(at)
                else:
                    index[r] = [at]
        heap = list(index)
        heapq.heapify(heap)
        met, rank = self.pairs.get, self._rank
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r, ())
            # places of one pair are found left to right, unless merges of several others have led to it
            for at in sorted(places):
                if pair[at] != r:
                    continue
                gone = after[at]
                nxt = after[gone]
                after[at] = nxt
                before[nxt] = at
                token[at] = r
                pair[gone] = _END
                prev = before[at]
                left = token[prev]
                if left != _END:
                    x = met(left << 32 | r)
                    if x is None:
                        x = rank(left, r)
                    pair[prev] = x
                    if x != _END:
                        if x in index:
                            index[x].append(prev)
                        else:
                            index[x] = [prev]
                            heapq.heappush(heap, x)
                right = token[nxt]
                if right != _END:
                    x = met(r << 32 | right)
                    if x is None:
                        x = rank(r, right)
                    pair[at] = x
                    if x != _END:
                        if x in index:
                            index[x].append(at)
                        else:
                            index[x] = [at]
                            heapq.heappush(heap, x)
                else:
                    pair[at] = _END
        for i, at, end in begins:
            ids = []
            while at < end:
                ids.append(token[at])
                at = after[at]
            out[i] = tuple(ids)
        return out

    def pieces(self, texts: list[str]) -> list[list[str]]:
        """Pre-tokens of each text of one block; afterwards all of them are known."""
        split = [self.split(t) for t in texts]
        if len(self.known) > self.remember:
            self.known.clear()
        known = self.known
        new = [p for p in set(chain.from_iterable(split)) if p not in known]
        for s in range(0, len(new), 50_000):
            part = new[s:s + 50_000]
            known.update(zip(part, map(self.keep, self.replay([p.encode("utf-8") for p in part])), strict=True))
        return split

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text of one block."""
        known = self.known
        return [list(chain.from_iterable(map(known.__getitem__, pieces))) for pieces in self.pieces(texts)]

    def forget(self) -> None:
        """Empty the memory at a task's end: workers live on and serve other stages."""
        self.known.clear()
        self.pairs.clear()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def _replay(rank_path: str, pattern: str) -> MergeReplay:
    return MergeReplay(rank_path, pattern)


@lru_cache(maxsize=1)
def _round_trips(rank_path: str, pattern: str) -> MergeReplay:
    """Remembers of each pre-token the number of its ids, the ids as text, and the bytes that they decode to."""
    bpe = MergeReplay(rank_path, pattern, remember=750_000)
    bpe.keep = lambda ids: (len(ids), " ".join(map(str, ids)), bpe.decode(ids))
    return bpe


def _blocks(texts: list[str], limit: int = 1_000_000):
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", ids_out: str = "token_ids") -> DataFrame:
    """Add the token ids (array<int>) of every row; an input column of that name is replaced."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == ids_out.lower()])
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_out, T.ArrayType(T.IntegerType(), False))])

    @lean
    def run(batches):
        bpe = _replay(rank_path, pattern)
        for b in small(batches):
            done = 0
            for texts in _blocks([t or "" for t in b.column(at).cast(pa.string()).to_pylist()]):
                part = b.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bpe.encode(texts), pa.list_(pa.int32()))], names=[*b.schema.names, ids_out])
        bpe.forget()

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, rank_path: str, pattern: str, ids_col: str = "token_ids", bytes_out: str = "decoded") -> DataFrame:
    """Add the decoded bytes of every row's token ids (NULL ids: no bytes)."""
    encoded = encoded.drop(*[c for c in encoded.columns if c.lower() == bytes_out.lower()])
    at = encoded.columns.index(ids_col)
    schema = T.StructType([*encoded.schema.fields, T.StructField(bytes_out, T.BinaryType())])

    def run(batches):
        bpe = _replay(rank_path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([bpe.decode(ids or []) for ids in b.column(at).to_pylist()], pa.binary())], names=[*b.schema.names, bytes_out])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_tokens``, ``ids_sha256`` of the ids joined by a space, ``decoded_sha256`` of the decoded bytes."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        bpe = _round_trips(rank_path, pattern)
        known = bpe.known
        for b in small(batches):
            n, ids_sums, text_sums = [], [], []
            for texts in _blocks([t or "" for t in b.column(1).to_pylist()]):
                for pieces in bpe.pieces(texts):
                    counts, ids, raw = zip(*map(known.__getitem__, pieces), strict=True) if pieces else ((), (), ())
                    n.append(sum(counts))
                    ids_sums.append(sha256(" ".join(ids).encode()).hexdigest())
                    text_sums.append(sha256(b"".join(raw)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sums, pa.string()), pa.array(text_sums, pa.string())],
                                             names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    return src.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
