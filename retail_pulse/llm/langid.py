"""Language identification with a language-bitmask Bloom filter of character n-grams.

Training counts every n-gram of every labelled text per language with Spark and
gives each n-gram a bitmask of the languages in which it is usual. The masks go
into one bit-sliced Bloom filter: ``2**slot_bits`` slots of language masks; an
n-gram ORs its mask into ``hashes`` slots, and a lookup ANDs those slots, which
returns all languages containing the n-gram at once. To classify a text, the bits
of each language are counted over all its n-grams, the hits that the filter's fill
alone would give are taken off, and the largest corrected count decides.

The only broadcast object is the filter: ``2**slot_bits`` masks of 8 bytes for every
63 languages (8 MB), whatever the corpus. ``min_rate`` bounds the n-grams of a language
that can enter (at most ``1 / min_rate`` can be so frequent).

Defined cases: a text that is NULL or has no letter gives ``und`` and score 0; NULL texts and
NULL languages are not learned from; without any training text every prediction is
``und``; ties go to the smaller language name; repeated rows count as often as they
come; any extra columns pass through ``classify`` unchanged, and an input column that has the
name of an output column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.llm.common import lean, table_of, written

UND = "und"
_MASK_BITS = 63


@dataclass(frozen=True)
class LangFilter:
    """The trained filter: ``slots[word, slot]`` masks, in language order of ``langs``."""

    langs: tuple[str, ...]
    slots: np.ndarray
    fill: np.ndarray
    sizes: tuple[int, ...]
    hashes: int
    default: str


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _grams(texts: list[str], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, and the number of the text that each belongs to.

    Texts are lower-cased, every run of other characters than letters becomes one boundary, and
    n-grams hold at least one letter and no boundary but at their ends.
    """
    lower = [t.lower() for t in texts]
    # two boundaries stand between texts
    cp = np.frombuffer(("\0\0" + "\0\0".join(lower) + "\0\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes_with_end = np.fromiter((len(t) + 2 for t in lower), dtype=np.int64, count=len(lower))
    sizes_with_end[:1] += 2
    owner = np.repeat(np.arange(len(lower), dtype=np.int32), sizes_with_end)
    letter = _letters()[cp]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    cp = np.where(letter, cp, 0)[keep]
    owner, letter = owner[keep], letter[keep]
    # an edge shared by two words stays one boundary, two edges in a row stay two: both fit "no inner boundary"
    out, who = [], []
    for n in sizes:
        m = len(cp) - n + 1
        if m <= 0:
            continue
        ok = np.ones(m, dtype=bool)
        for i in range(1, n - 1):
            ok &= letter[i:i + m]
        if n <= 2:
            ok &= letter[:m] | letter[n - 1:m + n - 1]
        h = np.full(m, n, dtype=np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + cp[i:i + m]
        out.append(_mix(h[ok]))
        # the boundary in front of a text's first letter is not its own
        who.append((owner[1:m + 1] if n > 2 else np.where(letter[:m], owner[:m], owner[n - 1:m + n - 1]))[ok])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    return np.concatenate(out), np.concatenate(who)


def _places(h: np.ndarray, i: int, slot_bits: int) -> np.ndarray:
    """The i-th slot of each n-gram."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h + np.uint64(i) * step) & np.uint64((1 << slot_bits) - 1)).astype(np.int64)


def _blocks(texts: list[str | None], limit: int = 1_000_000):
    """Blocks of about ``limit`` characters, so that arrays stay small: (pieces, number of the text of each piece).

    A longer text comes in several pieces, cut where no letter is (a run of letters longer than a piece is cut anywhere).
    """
    pieces, owner, size = [], [], 0
    for i, t in enumerate(texts):
        t, at = t or "", 0
        while at < len(t):
            end = min(len(t), at + limit)
            if end < len(t):
                cut = next((k for k in range(end, at, -1) if not t[k - 1].isalpha()), end)
                end = cut
            pieces.append(t[at:end])
            owner.append(i)
            size += end - at
            at = end
            if size >= limit:
                yield pieces, np.array(owner)
                pieces, owner, size = [], [], 0
    if pieces:
        yield pieces, np.array(owner)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: tuple[int, ...] = (3, 4),
          slot_bits: int = 20, hashes: int = 2, min_rate: float = 1e-5, min_ratio: float = 0.25) -> LangFilter:
    """Count the n-grams of every labelled text and build the filter.

    An n-gram is usual in a language if it makes up at least ``min_rate`` of that
    language's n-grams, and at least ``min_ratio`` of its rate in the language where it is most
    usual. To the driver go the filter's non-empty slots only, at most ``2**slot_bits``
    for every 63 languages, and one row per language.
    """
    spark = docs.sparkSession

    @lean
    def count(batches):
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            names, codes = np.unique(np.array(langs, dtype=object), return_inverse=True)
            for pieces, owner in _blocks(texts):
                h, who = _grams(pieces, sizes)
                lang = codes[owner[who]]
                for k, name in enumerate(names):
                    g, n = np.unique(h[lang == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"])

    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    counts = written(labelled.mapInArrow(count, "lang string, gram long, n long")
                     .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-counts")
    totals = {r.lang: r.total for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    langs = tuple(sorted(totals))
    words = max(1, -(-len(langs) // _MASK_BITS))
    if not langs:
        return LangFilter((), np.zeros((1, 1 << slot_bits), np.int64), np.zeros(0), sizes, hashes, UND)
    info = spark.createDataFrame([(name, i // _MASK_BITS, 1 << (i % _MASK_BITS), float(totals[name])) for i, name in enumerate(langs)],
                                 "lang string, word int, bit long, total double")
    rates = counts.join(F.broadcast(info), "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = rates.groupBy("gram").agg(
        F.max("rate").alias("best"), F.collect_list(F.struct("word", "bit", "rate")).alias("per"))
    usual = (best.select("gram", "best", F.explode("per").alias("p"))
             .filter((F.col("p.rate") >= min_rate) & (F.col("p.rate") >= min_ratio * F.col("best")))
             .groupBy("gram", F.col("p.word").alias("word")).agg(F.bit_or("p.bit").alias("mask")))

    @lean
    def slots(batches):
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(hashes):
                yield pa.RecordBatch.from_arrays([pa.array(_places(h, i, slot_bits)), b.column(1), b.column(2)],
                                                 names=["slot", "word", "mask"])

    filled = usual.mapInArrow(slots, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    table = table_of(filled.select(F.col("word").cast("long") * (1 << slot_bits) + F.col("slot"), "mask"), words << slot_bits).reshape(words, -1)
    fill = np.array([((table[i // _MASK_BITS] >> (i % _MASK_BITS)) & 1).mean() for i in range(len(langs))])
    default = min(langs, key=lambda x: (-totals[x], x))
    return LangFilter(langs, table, fill, sizes, hashes, default)


def _hits(model: LangFilter, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Corrected hits of each language (rows) in each text, and the n-grams of each text."""
    n_docs, n_langs = len(texts), len(model.langs)
    slot_bits = int(model.slots.shape[1]).bit_length() - 1
    hits, total = np.zeros((n_langs, n_docs)), np.zeros(n_docs)
    for pieces, owner in _blocks(texts):
        h, who = _grams(pieces, model.sizes)
        who = owner[who]
        total += np.bincount(who, minlength=n_docs)
        for w in range(model.slots.shape[0]):
            mask = model.slots[w][_places(h, 0, slot_bits)]
            for i in range(1, model.hashes):
                mask &= model.slots[w][_places(h, i, slot_bits)]
            for k in range(w * _MASK_BITS, min(n_langs, (w + 1) * _MASK_BITS)):
                hits[k] += np.bincount(who[((mask >> (k - w * _MASK_BITS)) & 1).astype(bool)], minlength=n_docs)
    fp = np.minimum(model.fill**model.hashes, 0.999)[:, None]
    return np.clip((hits - fp * total) / (1 - fp), 0, None), total


def predict(model: LangFilter, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    langs, scores, _, _ = measure(model, texts)
    return langs, scores


def measure(model: LangFilter, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language and score of each text, the share of its n-grams that hit that language (corrected), and their number."""
    langs, scores = [UND] * len(texts), np.zeros(len(texts))
    if not model.langs:
        return langs, scores, np.zeros(len(texts)), np.zeros(len(texts))
    true, total = _hits(model, texts)
    best, sums = true.argmax(axis=0), true.sum(axis=0)
    top = true.max(axis=0)
    for d in np.flatnonzero(total > 0):
        langs[d] = model.langs[best[d]] if sums[d] > 0 else model.default
        scores[d] = min(1.0, top[d] / sums[d]) if sums[d] > 0 else 0.0
    # a text of fewer letters than an n-gram needs still has a letter
    for d in np.flatnonzero(total == 0):
        if texts[d] and any(map(str.isalpha, texts[d])):
            langs[d] = model.default
    return langs, scores, np.divide(top, total, out=np.zeros(len(texts)), where=total > 0), total


def classify(docs: DataFrame, model: LangFilter, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score", share_out: str | None = None, min_grams: int = 30) -> DataFrame:
    """Add the predicted language and its score (0 to 1) to every row; all other columns pass through.

    ``share_out`` adds the share of the text's n-grams that hit the predicted language (corrected); it is NULL for a text of fewer
    than ``min_grams`` n-grams, which says too little.
    """
    added = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]
    if share_out:
        added.append(T.StructField(share_out, T.DoubleType()))
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {f.name.lower() for f in added}])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, *added])
    at = docs.columns.index(text_col)

    @lean
    def run(batches):
        model = shared.value
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                langs, scores, share, total = measure(model, part.column(at).cast(pa.string()).to_pylist())
                found = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                if share_out:
                    found.append(pa.array(share, pa.float64(), mask=total < min_grams))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*b.schema.names, *(f.name for f in added)])

    return docs.mapInArrow(run, schema)


def least_shares(held: DataFrame, model: LangFilter, text_col: str = "text", lang_col: str = "lang", part: float = 0.5) -> dict[str, float]:
    """For each language of the model the share of hits that a text of it must exceed: ``part`` of the lower quartile of
    the labelled texts ``held``, which must not be those that the model has learned from.

    A language without such texts takes the least value of the others; without any, only texts without a hit fall short.
    """
    labelled = held.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"))
    found = {r.lang_pred: part * r.low for r in classify(labelled, model, share_out="share").filter("share IS NOT NULL")
             .groupBy("lang_pred").agg(F.percentile_approx("share", 0.25).alias("low")).collect()}
    return {k: found.get(k, min(found.values(), default=0.0)) for k in model.langs}
