"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. Every text is cut into overlapping windows of
words; a window that the toxic dictionary compresses better than the ordinary one speaks for toxic content. The
gains of a document's windows (greatest, greatest few, number above a step) go into a logistic curve that is calibrated on
labelled documents which the dictionaries have not seen, weighted to the share of toxic documents among all labels.

The toxic dictionary is the ordinary one with toxic text behind it, so that the two differ only where toxic text
matches. Its text are the words of toxic documents whose opening is met after far more different words there
than in ordinary documents (counting contexts, not documents, keeps copies of one text from looking like a habit).

Fitting takes a bounded sample: ``max_per_class`` labelled documents of each class, chosen by a hash of the id, of at most
``max_chars`` characters; the ordinary dictionary is trained on at most ``max_windows`` of their windows (chosen by a hash), and a telling opening counts at most
``max_repeat`` times in the training of the toxic one. Only their ids are broadcast, only their texts reach the driver. Scoring reads every text whole, in one pass without
any shuffle; what is broadcast is two dictionaries and a few weights.

Defined cases: NULL and empty texts score as texts without any gain; without labels of both classes every score is the share of toxic
labels (0 without labels); a document with several labels counts as toxic if one of them is; repeated rows score alike; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SHORTEST, _LONGEST = 4, 12
#: Starts every window and ends both dictionaries: every window then has a match, and none falls back to a stored block, in which
#: a single match of a word would not show.
_HEAD = bytes(range(1, 9)) * 2


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries, scaling and weights; ``weights`` is None if there is nothing to weigh."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    share: float
    window: int
    stride: int


def _words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def _windows(words: list[bytes], window: int, stride: int) -> list[bytes]:
    return [_HEAD + b" " + b" ".join(words[i:i + window]) + b" " for i in range(0, max(1, len(words) - window + stride), stride)]


def _openings(word: bytes) -> list[bytes]:
    """The word's first bytes, a boundary before them, at every length from ``_SHORTEST`` to ``_LONGEST``; and the whole word."""
    word = b" " + word
    return [word[:k] for k in range(_SHORTEST, min(_LONGEST, len(word)) + 1)] + [word + b" "]


def _contexts(texts: list[list[bytes]]) -> tuple[Counter, int]:
    """After how many different words each opening comes, and the number of pairs of neighbours."""
    pairs = set()
    for words in texts:
        pairs.update(zip([b"", *words[:-1]], words, strict=True))
    counts: Counter = Counter()
    for _, w in pairs:
        counts.update(_openings(w))
    return counts, max(1, len(pairs))


def _train(size: int, samples: list[bytes], segment: int) -> bytes:
    """A trained dictionary; of too few samples to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class _Gain:
    """How many bytes shorter each window gets with the toxic dictionary."""

    def __init__(self, model: ToxicityModel):
        params = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=16, hash_log=17, search_log=3, min_match=5, target_length=32, strategy=zstandard.STRATEGY_GREEDY,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.window, self.stride = model.window, model.stride
        self.plain, self.toxic = (
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params).compress
            for d in (model.ordinary + _HEAD, model.ordinary + model.toxic + _HEAD))

    def features(self, text: str | None) -> list[float]:
        parts = _windows(_words(text), self.window, self.stride)
        gain = np.fromiter(map(len, map(self.plain, parts)), np.int64, len(parts)) - np.fromiter(map(len, map(self.toxic, parts)), np.int64, len(parts))
        top = np.sort(gain)[::-1]
        return [float(top[0]), float(top[:2].sum()), float(top[:6].sum()), *(math.log1p(int((gain >= k).sum())) for k in (3, 5)), math.log1p(len(gain))]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * w)
    return w


def _dictionaries(rows: list[tuple], window: int, size: int, toxic_size: int, max_windows: int, max_repeat: int) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary of (hash, text, label) rows."""
    toxic, plain = ([_words(t) for _, t, k in rows if k == want] for want in (1, 0))
    (in_toxic, n_toxic), (in_plain, n_plain) = _contexts(toxic), _contexts(plain)
    telling = {}
    for g, n in in_toxic.items():
        a, b = n / n_toxic, in_plain[g] / n_plain
        p = (n + in_plain[g]) / (n_toxic + n_plain)
        z = (a - b) / math.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_plain))
        if n >= 3 and z >= 6 and a >= 10 * (in_plain[g] + 1) / n_plain:
            telling[g] = z
    found = Counter(max(own, key=lambda g: (telling[g], len(g))) for words in toxic for w in words if (own := [g for g in _openings(w) if g in telling]))
    often = sorted(found.items(), key=lambda x: (x[1], x[0]))
    samples = sorted((g for g, n in often for _ in range(min(n, max_repeat))), key=xxhash.xxh64_intdigest)
    whole = b"".join(g for g, _ in often)[-toxic_size:]
    parts = sorted((p[len(_HEAD):] for words in plain for p in _windows(words, window, window)), key=xxhash.xxh64_intdigest)[:max_windows]
    return _train(size, parts, 64), _train(toxic_size, samples, 100) + whole


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_per_class: int = 3000,
        max_chars: int = 20_000, window: int = 24, stride: int = 12, dictionary: int = 32_768, toxic_dictionary: int = 8_192,
        max_windows: int = 60_000, max_repeat: int = 50) -> ToxicityModel:
    """Train on a bounded sample of the labelled documents (labels: ``id_col``, ``label_col`` 0 or 1)."""
    own = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(id_col).alias("label_id")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    counts = {r.label: r.n for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chosen = [own.filter(F.col("label") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(max_per_class) for k in (0, 1)]
    ids = F.broadcast(chosen[0].union(chosen[1]))
    rows = (docs.select(F.col(id_col).alias("own_id"), F.col(text_col).cast("string").alias("text"))
            .filter(F.length("text") <= max_chars).join(ids, F.col("own_id") == F.col("label_id")).select("text", "label").distinct().collect())
    rows = sorted(((xxhash.xxh64_intdigest(r.text.encode("utf-8", "surrogatepass")), r.text, r.label) for r in rows), key=lambda r: r[0])
    halves = [[r for r in rows if r[0] % 2 == k] for k in (0, 1)]
    if not all(any(r[2] == k for r in part) for part in halves for k in (0, 1)):
        return ToxicityModel(b"", b"", np.zeros(0), np.ones(0), None, share, window, stride)

    def build(part) -> ToxicityModel:
        return ToxicityModel(*_dictionaries(part, window, dictionary, toxic_dictionary, max_windows, max_repeat), np.zeros(0), np.ones(0), None, share, window, stride)

    # each half is scored by the dictionaries of the other one
    x, y = [], []
    for part, other in (halves, halves[::-1]):
        gain = _Gain(build(other))
        x += [gain.features(t) for _, t, _ in part]
        y += [k for _, _, k in part]
    x, y = np.array(x), np.array(y, dtype=float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    weights = _logistic(np.column_stack([np.ones(len(x)), (x - mean) / scale]), y, weight)
    model = build(rows)
    return ToxicityModel(model.ordinary, model.toxic, mean, scale, weights, share, window, stride)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: ``id_col``, ``score`` (0 to 1, higher: likelier toxic), ``predicted`` (1 if the score reaches ``threshold``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        gain = _Gain(model) if model.weights is not None else None
        for b in batches:
            if gain is None or not b.num_rows:
                p = np.full(b.num_rows, model.share)
            else:
                x = (np.array([gain.features(t.as_py()) for t in b.column(1)]) - model.mean) / model.scale
                p = 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ model.weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))], names=["id", "score", "predicted"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id long, score double, predicted int").withColumnRenamed("id", id_col)
