"""Document search: term filter + scored full-text match, hits page, total, terms buckets.

A bool query ``filter: term`` (no score) ``AND must: match`` (BM25 score,
OR over the analyzed query terms by default) over a document table.

Plan shape:

* every document is analyzed once per pass with built-in expressions
  (``split``/``filter`` on arrays, whole-stage codegen); term frequencies
  for the few query terms are computed per document, so there is no
  explode and no shuffle of tokens;
* index statistics (doc count, mean length, document frequency per query
  term) are over the *whole* index, not the filtered set; the scored search
  analyzes the index once into a narrow per-document table, computes the
  statistics (one row) from it and scores from it;
* the page is ``ORDER BY score DESC, id LIMIT offset+size`` -> a
  ``TakeOrderedAndProject`` (per-task top-k, then a k-row merge);
* total and buckets need no score and skip the statistics pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_pulse.functions.text import analyze, bm25_idf, bm25_term, term_freq, tokens
from retail_pulse.sources.sinks import materialize
from retail_pulse.sources.tables import balanced


@dataclass
class BoolQuery:
    """``filter`` term conditions (exact equality, no score) and one ``must`` match."""

    text_col: str
    query: str
    term_filters: dict[str, object] = field(default_factory=dict)
    operator: str = "or"  # "or": any query term; "and": all terms

    def terms(self) -> list[str]:
        return analyze(self.query)

    def filter_condition(self) -> Column:
        cond = F.lit(True)
        for c, v in self.term_filters.items():
            cond = cond & (F.col(c) == F.lit(v))
        return cond


def _tf_cols(terms: list[str]) -> list[str]:
    return [f"_tf{i}" for i in range(len(terms))]


def analyzed(docs: DataFrame, text_col: str, terms: list[str], keep: list[str],
             operator: str = "or") -> DataFrame:
    """Per document: kept columns, ``_dl`` (token count), ``_tf{i}`` per query term, ``_m`` (match).

    The token array is its own projection, referenced by the length and
    every term count; Catalyst keeps it computed once per document rather
    than inlining the regex split into each reference. Callers never put the
    match flag in a plain ``where``: Catalyst would push that predicate (and
    the tokenizer inside it) below the repartition that spreads the work.
    """
    tok = balanced(docs.select(*keep, text_col)).select(*keep, tokens(text_col).alias("_tok"))
    tfs = [term_freq(F.col("_tok"), t).alias(c) for t, c in zip(terms, _tf_cols(terms))]
    base = tok.select(*keep, F.size("_tok").alias("_dl"), *tfs)
    return base.withColumn("_m", _matched(terms, operator))


def _matched(terms: list[str], operator: str) -> Column:
    tfs = [F.col(c) > 0 for c in _tf_cols(terms)]
    if not tfs:
        return F.lit(False)
    out = tfs[0]
    for t in tfs[1:]:
        out = (out & t) if operator == "and" else (out | t)
    return out


def _stats_of(base: DataFrame, terms: list[str]) -> DataFrame:
    return base.agg(F.count(F.lit(1)).cast("double").alias("n_docs"),
                    F.avg("_dl").alias("avgdl"),
                    *[F.count_if(F.col(c) > 0).cast("double").alias(f"_df{i}")
                      for i, c in enumerate(_tf_cols(terms))])


def scored(docs: DataFrame, q: BoolQuery, keep: list[str], digits: int | None = 6) -> DataFrame:
    """Filtered documents with ``score`` (BM25 over whole-index statistics), NULL when not matched.

    The index is analyzed once into a narrow per-document table (kept and
    filter columns, length, term counts) written in the shared work folder;
    the statistics aggregate (exactly one row of ``2 + len(terms)`` numbers)
    and the scoring pass both read that table, so no document is tokenized
    twice. The statistics are inlined as literals: what a scalar subquery
    does, evaluated once instead of once per reference.
    """
    terms = q.terms()
    cols = list(dict.fromkeys(keep + list(q.term_filters)))
    narrow = materialize(analyzed(docs, q.text_col, terms, cols, q.operator), "search-terms")
    st = _stats_of(narrow, terms).first()
    return _with_score(narrow, q, keep, st["n_docs"], st["avgdl"], [st[f"_df{i}"] for i in range(len(terms))], digits)


def _with_score(narrow: DataFrame, q: BoolQuery, keep: list[str], n: float | None, mean: float | None, dfs: list, digits: int | None) -> DataFrame:
    base = narrow.where(q.filter_condition())
    if not n:
        return base.select(*keep, F.lit(None).cast("double").alias("score"))
    n_docs, avgdl = F.lit(float(n)), F.lit(float(mean))
    score = F.lit(0.0)
    for c, df in zip(_tf_cols(q.terms()), dfs):
        idf = bm25_idf(n_docs, F.lit(float(df)))
        score = score + bm25_term(F.col(c).cast("double"), F.col("_dl").cast("double"), avgdl, idf)
    if digits is not None:
        score = F.round(score, digits)
    return base.select(*keep, F.when(F.col("_m"), score).alias("score"))


def scored_matches(docs: DataFrame, q: BoolQuery, keep: list[str], digits: int | None = 6) -> DataFrame:
    """Only the matching documents with their score (for small inputs and tests)."""
    return scored(docs, q, keep, digits).where(F.col("score").isNotNull())


def hits_page(docs: DataFrame, q: BoolQuery, id_col: str, fields: list[str],
              offset: int = 0, size: int = 10, digits: int = 6) -> DataFrame:
    """Page of hits ordered by score desc then id: (id, score, source fields).

    Non-matches carry a NULL score and sort last, so the page is a plain
    top-k (``TakeOrderedAndProject``) over the scored documents; NULL rows
    that fill a short last page are dropped after the limit.
    """
    keep = [id_col] + [f for f in fields if f != id_col]
    # ordered by the exact score and rounded on output, so near ties keep their order
    return _page(scored(docs, q, keep, digits=None), id_col, fields, offset, size, digits)


def _page(s: DataFrame, id_col: str, fields: list[str], offset: int, size: int, digits: int) -> DataFrame:
    page = s.orderBy(F.col("score").desc_nulls_last(), F.col(id_col).asc())
    if offset:
        page = page.offset(offset)
    return page.limit(size).where(F.col("score").isNotNull()) \
        .select(id_col, F.round("score", digits).alias("score"), *[f for f in fields if f != id_col])


def total_hits(docs: DataFrame, q: BoolQuery) -> DataFrame:
    """One row ``total``: number of matching documents (before paging)."""
    base = analyzed(docs.where(q.filter_condition()), q.text_col, q.terms(), [], q.operator)
    return base.agg(F.count_if(F.col("_m")).cast("bigint").alias("total"))


def terms_buckets(docs: DataFrame, q: BoolQuery, key: str, max_field: str, size: int = 10) -> DataFrame:
    """Terms aggregation over all matches: (key, doc_count, max of ``max_field``), top ``size``
    by doc_count desc then key asc. Aggregates first (partial aggregation per task), then
    drops keys without matches."""
    base = analyzed(docs.where(q.filter_condition()), q.text_col, q.terms(), [key, max_field], q.operator)
    agg = base.groupBy(key).agg(F.count_if(F.col("_m")).cast("bigint").alias("doc_count"),
                                F.max(F.when(F.col("_m"), F.col(max_field))).alias(f"max_{max_field}"))
    return agg.where(F.col("doc_count") > 0) \
        .orderBy(F.col("doc_count").desc(), F.col(key).asc()).limit(size)
