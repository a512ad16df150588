"""URL filters: rules first, logistic regression on hashed character n-grams for the rest.

Everything on the main path are DataFrame and SQL functions. Host and path are cut from the url, rules are tested as
expressions, and n-grams of host and path are hashed into ``2**hash_bits`` features. The model is trained on a small table of
labelled urls (at most ``max_labelled`` of them, chosen by a hash) and gives a verdict where no rule does.

Defined cases: a NULL url or one without ``://`` has an empty host and path, fits no rule and gets the model's verdict for empty parts;
without labels of both kinds the model's verdict is the only kind there is, or allow; of rules that fit with the same length block wins, then the
smaller rule; repeated rows come out as often as they come in; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, and for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[str]) -> list[Rule]:
    """Rules of lines such as ``block example.com/de/``."""
    out = []
    for line in lines:
        verdict, _, where = line.strip().partition(" ")
        host, slash, path = where.strip().partition("/")
        if verdict not in ("allow", "block") or not host:
            raise ValueError(f"not a rule: {line!r}")
        out.append(Rule(verdict, host.lower(), slash + path))
    return out


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    at = F.locate("://", F.col(url_col))
    rest = F.when(at > 0, F.expr(f"substr(`{url_col}`, locate('://', `{url_col}`) + 3)")).otherwise(F.lit(""))
    return pages.withColumn("host", F.translate(F.regexp_extract(rest, _PARTS, 1), _UPPER, _LOWER)).withColumn("path", F.regexp_extract(rest, _PARTS, 2))


def _fits(rule: Rule) -> Column:
    host, path = F.col("host"), F.col("path")
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def ruled(rules: list[Rule], field: str) -> Column:
    """The name or the verdict of the longest rule that fits, else NULL."""
    found = F.lit(None).cast("string")
    # the last condition that is put in front is tested first
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", [-ord(c) for c in r.name])):
        found = F.when(_fits(rule), F.lit(getattr(rule, field))).otherwise(found)
    return found


def _with_features(df: DataFrame, hash_bits: int, out: str) -> DataFrame:
    """Add the hashed character n-grams (3 and 4 characters, boundaries marked) of host and path."""
    def grams(col: str, mark: str, n: int) -> Column:
        whole = f"concat('^', {col}, '$')"
        return F.expr(f"transform(sequence(1, greatest(length({whole}) - {n - 1}, 1)), i -> concat('{mark}', substr({whole}, i, {n})))")

    all_grams = F.concat(grams("host", "h", 3), grams("host", "h", 4), grams("path", "p", 3), grams("path", "p", 4))
    tf = HashingTF(inputCol="__grams", outputCol=out, numFeatures=1 << hash_bits, binary=True)
    return tf.transform(df.withColumn("__grams", all_grams)).drop("__grams")


@dataclass(frozen=True)
class UrlModel:
    """The trained regression; without one, ``only`` is the verdict for all."""

    regression: LogisticRegressionModel | None
    only: str
    hash_bits: int


def train(labelled: DataFrame, url_col: str = "url", verdict_col: str = "verdict", max_labelled: int = 4000, hash_bits: int = 12,
          regularisation: float = 0.001) -> UrlModel:
    """Train on a bounded table of labelled urls (verdict ``block`` or ``allow``)."""
    rows = (labelled.select(F.col(url_col).alias("url"), F.col(verdict_col).alias("verdict"))
            .filter(F.col("verdict").isin("block", "allow")).distinct()
            .orderBy(F.xxhash64("url"), "url", "verdict").limit(max_labelled))
    data = _with_features(with_parts(rows), hash_bits, "features").select("features", (F.col("verdict") == "block").cast("double").alias("label"))
    data = data.coalesce(1).cache()
    kinds = [r.label for r in data.select("label").distinct().collect()]
    if len(kinds) < 2:
        model = UrlModel(None, "block" if kinds == [1.0] else "allow", hash_bits)
    else:
        model = UrlModel(LogisticRegression(maxIter=50, regParam=regularisation).fit(data), "", hash_bits)
    data.unpersist()
    return model


def judge(pages: DataFrame, rules: list[Rule], model: UrlModel, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: ``id_col``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (the model's probability of block)."""
    src = with_parts(pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")))
    if model.regression is None:
        scored = src.withColumn("score", F.lit(1.0 if model.only == "block" else 0.0))
    else:
        scored = model.regression.transform(_with_features(src, model.hash_bits, model.regression.getFeaturesCol()))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    by_model = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("id").alias(id_col), "host", "path", ruled(rules, "name").alias("rule"),
                         F.coalesce(ruled(rules, "verdict"), by_model).alias("verdict"), "score")
