"""Benchmark decontamination by latent semantic retrieval.

Passages are ``2 * cell`` words of a document, one from every ``cell`` words on. Only words
that the benchmark items hold matter to a cosine with an item and to a common subsequence, so each document
is reduced once to its *hits* (place and term of those words), written as Parquet; all later passes read the hits.

1. Term statistics over the passages' cells of all documents, those with a single hit included, give the inverse frequencies. Terms in more than
   ``max_df`` of the cells carry no weight, but the ``always`` rarest terms of each item do, and half as many of each ``cell`` of its words.
2. A randomised SVD of the TF-IDF passages, of all documents, that have ``min_terms`` weighted terms: Spark adds up A'A once, as products of pairs of terms of the same passage; each pass multiplies
   that table by the current basis in Spark, and the driver orthonormalises a (terms x rank) matrix. The items are rows
   too, each as heavy as ``item_weight`` passages beside ``weight_rows`` documents. The rank is ``rank_share`` of the number of pieces, so the space cannot hold every item by itself: what
   it keeps are the directions that items share with each other and with the passages.
3. Cosine search in the latent space, where items and passages are both projected and scaled to unit length: every passage of every document against all items of the
   block; an item of more than ``3 * cell`` words is cut into overlapping pieces of a passage's length, and a hit of any piece is verified for the
   whole item. Items of so few different words that a passage's cosine may miss them are looked up by their words instead.
4. Candidates are verified on the words themselves: the longest common subsequence of the item and the
   best-matching stretch of the document, and for paraphrases the words of the answer, which is the item's answer column if it has one
   and else its last quarter. No paraphrase is what shares ``dense_lcs`` of the item's words in order, or a verbatim run of ``exact_run`` of them.

Items are the stated query set: they are taken in blocks of about ``item_block`` pieces, so what is broadcast (the vocabulary of a block, and
its basis of terms x rank floats) does not grow with either table.

Defined cases: NULL and empty texts and items match nothing; a NULL document id stays NULL; an item of words that no document
has matches nothing; items of the same text each get their own rows; rows with the same id and text give one result;
very long texts are cut into overlapping pieces; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_pulse.llm.common import NULL_ID, lean, small, written
from retail_pulse.llm.words import texts_words

_PUNCT = bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
_TO_SPACE = bytes.maketrans(_PUNCT, b" " * len(_PUNCT))
_HITS = "doc long, sig long, base long, pos binary, term binary"
_CHUNK_HITS = 50_000
_PASSAGES = 2048
_HELD_PAIRS = 4_000_000


@dataclass(frozen=True)
class Items:
    """A block of benchmark items over its own vocabulary of word numbers."""

    ids: list
    terms: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray
    #: (item, first word, end) of the stretches that passages are compared with
    pieces: list[tuple[int, int, int]]


def _pieces(n: int, cell: int) -> list[tuple[int, int]]:
    """An item of ``n`` words in stretches of a passage's length, one from every ``cell`` words on; a short item is one."""
    if n <= 3 * cell:
        return [(0, n)]
    return [(s, min(n, s + 2 * cell)) for s in range(0, n - cell, cell)]


def _clean(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE)


def _items(rows: list[tuple], cell: int) -> Items:
    ids, texts, answers = zip(*rows, strict=True)
    words, off = texts_words([_clean(t) for t in texts])
    vocabulary, terms = np.unique(words, return_inverse=True)
    own = [terms[off[i]:off[i + 1]].astype(np.int32) for i in range(len(ids))]
    ends = []
    for t, a in zip(own, answers, strict=True):
        if a is None:
            ends.append(np.unique(t[-max(3, len(t) // 4):]))
        else:
            w = texts_words([_clean(a)])[0]
            at = np.minimum(np.searchsorted(vocabulary, w), max(0, len(vocabulary) - 1))
            ends.append(np.unique(at[vocabulary[at] == w] if len(vocabulary) else at[:0]))
    pieces = [(i, *p) for i, t in enumerate(own) for p in _pieces(len(t), cell)]
    return Items(list(ids), own, ends, vocabulary, pieces)


class _Lookup:
    """Term of each word number, -1 for others; a collision-free table if one is found soon, else binary search."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary, self.table = vocabulary, None
        bits = min(22, max(12, 2 * len(vocabulary).bit_length() - 2))
        for seed in range(64):
            self.seed, self.shift = np.uint64(seed * 2 + 0x9E3779B97F4A7C15), np.uint64(64 - bits)
            slot = self._slot(vocabulary)
            if len(np.unique(slot)) == len(vocabulary):
                self.table = np.zeros(1 << bits, dtype=np.int32)
                self.table[slot] = np.arange(len(vocabulary), dtype=np.int32)
                break

    def _slot(self, words: np.ndarray) -> np.ndarray:
        return ((words * self.seed) >> self.shift).astype(np.int64)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.full(len(words), -1, dtype=np.int32)
        if self.table is not None:
            t = self.table[self._slot(words)]
        else:
            t = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1).astype(np.int32)
        return np.where(self.vocabulary[t] == words, t, np.int32(-1))


def _hits(docs: DataFrame, items: Items, id_col: str, text_col: str, overlap: int, least: int, piece: int = 1_000_000) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), F.xxhash64(text), text)
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    @lean
    def run(batches):
        find = _Lookup(shared.value)
        for b in small(batches):
            doc, sig = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts, at = b.column(2).to_pylist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 500_000):
                    size += len(texts[end])
                    end += 1
                ids, off = texts_words([_clean(t) for t in texts[at:end]])
                term = find(ids)
                at_hit = np.flatnonzero(term >= 0)
                rows = []
                for i in range(end - at):
                    for s in range(off[i], max(off[i] + 1, off[i + 1] - overlap), piece):
                        x, y = np.searchsorted(at_hit, (s, min(off[i + 1], s + piece + overlap)))
                        if y - x >= least:
                            h = at_hit[x:y]
                            rows.append((doc[at + i], sig[at + i], s - off[i], (h - s).astype(np.int32).tobytes(), term[h].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        names=["doc", "sig", "base", "pos", "term"])
                at = end

    return src.mapInArrow(run, _HITS)


def _chunks(batches):
    """Rows together: (doc, sig), place and term of the hits, row of each hit, and the offsets of the rows."""
    def pack(keys, pos, term):
        off = np.cumsum([0, *map(len, pos)])
        return keys, np.concatenate(pos), np.concatenate(term), np.repeat(np.arange(len(keys)), np.diff(off)), off

    keys, pos, term, size = [], [], [], 0
    for b in batches:
        for doc, sig, p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
            keys.append((doc, sig))
            pos.append(np.frombuffer(p, dtype=np.int32))
            term.append(np.frombuffer(t, dtype=np.int32))
            size += len(pos[-1])
            if size >= _CHUNK_HITS:
                yield pack(keys, pos, term)
                keys, pos, term, size = [], [], [], 0
    if keys:
        yield pack(keys, pos, term)


def _cells(pos, row, off, cell):
    """Number of the cell of each hit, with a gap between rows, and the first cell of each row."""
    last = np.array([pos[off[i + 1] - 1] // cell for i in range(len(off) - 1)], dtype=np.int64)
    first = np.concatenate(([1], np.cumsum(last[:-1] + 3) + 1))
    return first[row] + pos // cell, first


def _matrix(cells, term, idf, n_terms, min_terms):
    """TF-IDF entries of all passages with ``min_terms`` or more weighted terms: passage, row starts, terms, values of unit length."""
    use = idf[term] > 0
    c, t = cells[use], term[use].astype(np.int64)
    key, tf = np.unique(np.concatenate((c, c - 1)) * n_terms + np.concatenate((t, t)), return_counts=True)
    passage, t = key // n_terms, key % n_terms
    starts = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1]))) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate((starts, [len(key)])))
    keep = np.repeat(n >= min_terms, n)
    passage, t, tf = passage[keep], t[keep], tf[keep]
    n = n[n >= min_terms]
    starts = np.cumsum(n) - n
    value = (1 + np.log(tf)) * idf[t]
    if len(n):
        value /= np.repeat(np.sqrt(np.add.reduceat(value**2, starts)), n)
    return passage[starts], starts, n, t, value.astype(np.float32)


def _statistics(hits: DataFrame, n_terms: int, cell: int) -> tuple[np.ndarray, int]:
    """Cells that hold each term, and cells that hold any (counted over all documents)."""
    @lean
    def run(batches):
        df, total = np.zeros(n_terms, dtype=np.int64), 0
        for _, pos, term, row, off in _chunks(batches):
            c, _ = _cells(pos, row, off, cell)
            df += np.bincount(np.unique(c * n_terms + term) % n_terms, minlength=n_terms)
            total += len(np.unique(c))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], total))], names=["term", "n"])

    df, total = np.zeros(n_terms), 0
    for r in hits.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r.term < 0:
            total = r.n
        else:
            df[r.term] = r.n
    return df, total


def _idf(items: Items, df: np.ndarray, total: int, max_df: float, always: int, cell: int) -> np.ndarray:
    weight = np.log1p(max(1, total) / np.maximum(df, 1))
    use = df <= max_df * total
    for i, a, b in items.pieces:
        # half as many of each cell, so that what is left of a cut item has some wherever its rarest words were
        for s, e, n in [(a, b, always), *((s, min(b, s + cell), always // 2) for s in range(a, b, cell))]:
            own = np.unique(items.terms[i][s:e])
            use[own[np.argsort(df[own], kind="stable")[:n]]] = True
    return np.where(use, weight, 0.0)


def _item_matrix(items: Items, pieces: list[tuple[int, int, int]], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(pieces), len(idf)), dtype=np.float32)
    for k, (i, a, b) in enumerate(pieces):
        own, tf = np.unique(items.terms[i][a:b], return_counts=True)
        out[k, own] = (1 + np.log(tf)) * idf[own]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def _pairs(starts, n, t, value, n_terms):
    """Products of the entries of each passage, summed by pair of terms (the lesser one first): pair numbers, sums."""
    keys, products = [], []
    for k in np.unique(n):
        at = starts[n == k][:, None] + np.arange(k)
        i, j = np.triu_indices(k)
        terms, values = t[at], value[at].astype(np.float64)
        keys.append((terms[:, i] * n_terms + terms[:, j]).ravel())
        products.append((values[:, i] * values[:, j]).ravel())
    return _summed(keys, products)


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sum of the values of each."""
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value[order], first) if len(first) else value[:0]


def gram(hits: DataFrame, idf: np.ndarray, cell: int, min_terms: int) -> DataFrame:
    """A'A for the TF-IDF passages A of all hits: a row for each term with its products with the terms that are not below it.

    A passage has few weighted terms, so its pairs are fewer than its entries times a basis. A worker adds them up and lets go of what it
    holds at ``_HELD_PAIRS``; there is one partial sum a core, not one a task, and the table has at most (terms x terms) / 2 entries.
    """
    n_terms = len(idf)
    shared = hits.sparkSession.sparkContext.broadcast(idf)

    def rows(key, value):
        term, other = key // n_terms, (key % n_terms).astype(np.int32)
        first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(key) else np.zeros(0, np.int64)
        end = np.append(first, len(key))[1:]
        value = value.astype(np.float32)
        return pa.RecordBatch.from_arrays(
            [pa.array(term[first], pa.int64()), *(pa.array([x[s:e].tobytes() for s, e in zip(first, end, strict=True)], pa.binary()) for x in (other, value))],
            names=["term", "other", "v"])

    @lean
    def multiply(batches):
        idf, keys, values, held, sums = shared.value, [], [], 0, 0
        for _, pos, term, row, off in _chunks(batches):
            c, _ = _cells(pos, row, off, cell)
            _, starts, n, t, value = _matrix(c, term, idf, n_terms, min_terms)
            key, product = _pairs(starts, n, t, value, n_terms)
            keys.append(key)
            values.append(product)
            held += len(key)
            # the sums are put together when as much has come to them again
            if held >= max(2 * sums, _HELD_PAIRS // 4):
                key, product = _summed(keys, values)
                keys, values, held = [key], [product], len(key)
                sums = held
                if held >= _HELD_PAIRS:
                    yield rows(key, product)
                    keys, values, held, sums = [], [], 0, 0
        yield rows(*_summed(keys, values))

    @lean
    def add(batches):
        held: dict[int, tuple[list, list]] = {}
        for b in batches:
            for t, other, v in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                keys, values = held.setdefault(t, ([], []))
                keys.append(t * n_terms + np.frombuffer(other, dtype=np.int32).astype(np.int64))
                values.append(np.frombuffer(v, dtype=np.float32).astype(np.float64))
        for some in held.values():
            yield rows(*_summed(*some))

    schema = "term long, other binary, v binary"
    few = hits.coalesce(hits.sparkSession.sparkContext.defaultParallelism)
    return written(few.mapInArrow(multiply, schema).repartition("term").mapInArrow(add, schema), "decontam-gram")


def _gram_times(products: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'A B from the table of A'A, summed per term in Spark."""
    n_terms, rank = basis.shape
    shared = products.sparkSession.sparkContext.broadcast(basis)

    @lean
    def multiply(batches):
        basis = shared.value
        total = np.zeros(basis.shape)
        for b in batches:
            for t, other, v in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                other, v = np.frombuffer(other, dtype=np.int32), np.frombuffer(v, dtype=np.float32)
                total[t] += v @ basis[other]
                above = other > t
                total[other[above]] += v[above][:, None] * basis[t]
        at = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([total[i].tobytes() for i in at], pa.binary())], names=["term", "v"])

    @lean
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for t, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[t] = sums.get(t, 0.0) + np.frombuffer(v, dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["term", "v"])

    out = np.zeros((n_terms, rank))
    few = products.coalesce(products.sparkSession.sparkContext.defaultParallelism)
    for r in few.mapInArrow(multiply, "term long, v binary").repartition("term").mapInArrow(add, "term long, v binary").collect():
        out[r.term] = np.frombuffer(r.v, dtype=np.float64)
    return out


def latent_basis(hits: DataFrame, items: Items, pieces: list[tuple[int, int, int]], idf: np.ndarray, cell: int, min_terms: int, rank_share: float = 0.64,
                 item_weight: float = 30.0, passes: int = 2, seed: int = 7, weight_rows: int = 2000, products: DataFrame | None = None) -> np.ndarray:
    """(terms x rank) orthonormal basis: randomised SVD of all passages and the pieces of items by subspace iteration.

    ``products`` is the :func:`gram` of the hits, if it is there already. All passages count alike; together they weigh as those of at most ``weight_rows``
    documents, so that an item weighs as much beside many documents as beside few.
    """
    if products is None:
        products = gram(hits, idf, cell, min_terms)
    scale = weight_rows / max(weight_rows, hits.count())
    own = _item_matrix(items, pieces, idf).astype(np.float64)
    n_terms = len(idf)
    rank = min(n_terms, max(8, int(np.ceil(rank_share * len(pieces)))))
    b = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, rank)))[0]
    for _ in range(passes):
        z = scale * _gram_times(products, b.astype(np.float32))
        b = np.linalg.qr(z + item_weight * (own.T @ (own @ b)))[0]
    return b.astype(np.float32)


def _unit(y: np.ndarray) -> np.ndarray:
    """Rows of unit length; rows without a part in the latent space become zero."""
    norm = np.linalg.norm(y, axis=1, keepdims=True)
    return np.divide(y, norm, out=np.zeros_like(y), where=norm > 1e-3)


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, with the columns of the table as bits of one number."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def longest_run(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> int:
    """Most consecutive items of ``a`` that stand at consecutive places in ``b``."""
    best, run, last = 0, np.zeros(len(a) + 1, dtype=np.int64), None
    for x, p in zip(b.tolist(), place.tolist(), strict=True):
        before = run[:-1] if last is not None and p == last + 1 else 0
        run = np.concatenate(([0], np.where(a == x, before + 1, 0)))
        best, last = max(best, int(run.max())), p
    return best


def _cosine(own: np.ndarray, stretch: np.ndarray, idf: np.ndarray) -> float:
    """TF-IDF cosine of an item and of a stretch of its words."""
    terms = np.unique(own)
    a, b = ((x > 0) * (1 + np.log(np.maximum(x, 1))) * idf[terms] for x in
            (np.array([(w == t).sum() for t in terms]) for w in (own, stretch)))
    norm = float(np.linalg.norm(a) * np.linalg.norm(b))
    return float(a @ b) / norm if norm else 0.0


def _search(hits: DataFrame, items: Items, pieces: list[tuple[int, int, int]], direct: list[int], basis: np.ndarray, idf: np.ndarray, cell: int,
            min_terms: int, min_cosine: float, min_lcs: float, dense_lcs: float, exact_run: int, min_answer: float) -> DataFrame:
    """Candidates by cosine with ``pieces``, and all stretches with enough words of the items ``direct``, verified."""
    n_terms = len(idf)
    shared = hits.sparkSession.sparkContext.broadcast((basis, idf, items))

    @lean
    def run(batches):
        basis, idf, items = shared.value
        latent = _unit(_item_matrix(items, pieces, idf) @ basis).T.copy()
        sets = {i: np.isin(np.arange(n_terms), items.terms[i]) for i in {*direct, *(p[0] for p in pieces)}}

        def verified(i, stretch, place):
            """(share, answer) of a stretch that holds the item, or None."""
            own = items.terms[i]
            share = lcs(own, stretch) / len(own)
            if share < min_lcs:
                return None
            answer = float(np.isin(items.answers[i], stretch).mean()) if len(items.answers[i]) else 0.0
            if share < dense_lcs and answer < min_answer and longest_run(own, stretch, place) < exact_run:
                return None
            return share, answer

        for keys, pos, term, row, off in _chunks(batches):
            best: dict[tuple[int, int], tuple] = {}
            for i in direct:
                own = items.terms[i]
                width = len(own) + len(own) // 3 + 2
                at = np.flatnonzero(sets[i][term])
                place = row[at] * (int(pos.max()) + width + 1) + pos[at]
                upto = np.searchsorted(place, place + width)
                for k in np.flatnonzero(upto - np.arange(len(at)) >= min_lcs * len(own)):
                    d, stretch = int(row[at[k]]), term[at[k:upto[k]]]
                    if best.get((d, i), (0.0,))[0] < 1 and (found := verified(i, stretch, pos[at[k:upto[k]]])):
                        found = (*found, _cosine(own, stretch, idf))
                        best[d, i] = max(best.get((d, i), found), found)
            c, first = _cells(pos, row, off, cell)
            passage, starts, n, t, value = _matrix(c, term, idf, n_terms, min_terms)
            # several passages and pieces lead to one stretch
            known: dict[tuple, tuple | None] = {}
            for s in range(0, len(n), _PASSAGES):
                e = min(len(n), s + _PASSAGES)
                lo, hi = starts[s], starts[e - 1] + n[e - 1]
                y = np.add.reduceat(basis[t[lo:hi]] * value[lo:hi, None], starts[s:e] - lo, axis=0)
                cosine = _unit(y) @ latent
                for p, j in zip(*np.nonzero(cosine >= min_cosine), strict=True):
                    i = pieces[j][0]
                    d = int(np.searchsorted(first, passage[s + p] + 1, side="right") - 1)
                    own = items.terms[i]
                    # the stretch of the item's length and a third with most of its words, near the passage
                    width = len(own) + len(own) // 3 + 2
                    begin = int(passage[s + p] - first[d]) * cell
                    x, z = off[d] + np.searchsorted(pos[off[d]:off[d + 1]], (begin - width, begin + 2 * cell + width))
                    near, words = pos[x:z], term[x:z]
                    mine = sets[i][words]
                    near, words = near[mine], words[mine]
                    if len(words) < min_lcs * len(own):
                        continue
                    upto = np.searchsorted(near, near + width)
                    k = int(np.argmax(upto - np.arange(len(near))))
                    stretch = words[k:upto[k]]
                    which = (d, i, int(near[k]), len(stretch))
                    if which not in known:
                        known[which] = verified(i, stretch, near[k:upto[k]])
                    if known[which]:
                        found = (*known[which], float(cosine[p, j]))
                        best[d, i] = max(best.get((d, i), found), found)
            if best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[d][0] for d, _ in best]), pa.array([keys[d][1] for d, _ in best]),
                     pa.array([items.ids[i] for _, i in best], pa.int64()),
                     *(pa.array([v[k] for v in best.values()], pa.float64()) for k in (2, 0, 1))],
                    names=["doc", "sig", "item_id", "cosine", "lcs", "answer"])

    return hits.mapInArrow(run, "doc long, sig long, item_id long, cosine double, lcs double, answer double")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", answer_col: str | None = None, cell: int = 24, min_terms: int = 3, max_df: float = 0.002,
                 always: int = 8, min_cosine: float = 0.5, min_lcs: float = 0.6, dense_lcs: float = 0.75, exact_run: int = 13, min_answer: float = 0.5,
                 item_block: int = 256, rank_share: float = 0.64, item_weight: float = 30.0, weight_rows: int = 2000) -> DataFrame:
    """Document and item pairs: ``id_col``, ``text_hash`` (xxhash64 of the text), ``item_id``, ``cosine``, ``lcs``, ``answer``."""
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    asked = benchmark.select(F.col(item_id_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t"), answer.alias("a")).filter("t IS NOT NULL")
    n_words = F.size(F.split("t", r"\s+"))
    size = asked.agg(F.sum(F.greatest(F.lit(1), F.when(n_words > 3 * cell, F.ceil(n_words / cell)).otherwise(1))).alias("pieces"), F.max(F.length("t")).alias("longest")).first()
    blocks, longest = max(1, -(-(size.pieces or 0) // item_block)), size.longest or 0
    # with fewer different words than this, an item in a passage full of other items' words may stay below the cosine
    few = max(min_terms, int(np.ceil(min_cosine**2 * 2 * cell)))
    out = None
    for k in range(blocks):
        rows = sorted(map(tuple, asked.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()), key=repr)
        items = _items(rows, cell) if rows else None
        if items is None or not len(items.vocabulary):
            continue
        n_terms = len(items.vocabulary)
        direct = [i for i, t in enumerate(items.terms) if len(t) and len(np.unique(t)) < few]
        # one word is enough: documents with too few to be searched count in the term statistics too
        hits = written(_hits(docs, items, id_col, text_col, overlap=2 * (longest + 2 * cell), least=1), "decontam-hits")
        df, total = _statistics(hits, n_terms, cell)
        idf = _idf(items, df, total, max_df, always, cell)
        products = gram(hits, idf, cell, min_terms)
        # the pieces of long items may be many more than a block holds on average
        for at in range(0, len(items.pieces), 2 * item_block):
            pieces = items.pieces[at:at + 2 * item_block]
            basis = latent_basis(hits, items, pieces, idf, cell, min_terms, rank_share, item_weight, weight_rows=weight_rows, products=products)
            part = written(_search(hits, items, pieces, [] if at else direct, basis, idf, cell, min_terms, min_cosine, min_lcs, dense_lcs, exact_run, min_answer), "decontam-found")
            out = part if out is None else out.union(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"{id_col} long, text_hash long, item_id long, cosine double, lcs double, answer double")
    return (out.groupBy("doc", "sig", "item_id").agg(F.max(F.struct("lcs", "answer", "cosine")).alias("m"))
            .select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias(id_col), F.col("sig").alias("text_hash"), "item_id", "m.cosine", "m.lcs", "m.answer"))
