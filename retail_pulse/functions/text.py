"""Full-text analysis and BM25 scoring as built-in column expressions.

Analyzer: lower-case, every Han character becomes its own token, and the
rest is split on runs of characters that are neither letters nor digits.
Query strings are analyzed with the same rule on the driver (they are
parameters, a few words); documents are analyzed on the executors with
``regexp_replace`` / ``split`` / ``filter`` so the whole thing stays inside
whole-stage codegen.
"""

from __future__ import annotations

import regex as _re
from pyspark.sql import Column
from pyspark.sql import functions as F

# BM25 parameters of the search engine's default similarity.
BM25_K1 = 1.2
BM25_B = 0.75

# Java regex (executor side) and the equivalent Python ``regex`` patterns.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
HAN_CHAR_JAVA = r"(\p{IsHan})"
HAN_CHAR_PY = r"(\p{Han})"


def tokens(text) -> Column:
    """Document text -> array of analyzed tokens.

    The empty strings a split leaves at the ends are dropped with
    ``array_remove`` (code-generated) rather than a lambda ``filter``
    (interpreted) or another regex pass.
    """
    t = F.col(text) if isinstance(text, str) else text
    spaced = F.regexp_replace(F.lower(t), HAN_CHAR_JAVA, " $1 ")
    return F.array_remove(F.split(spaced, TOKEN_SPLIT), F.lit(""))


def analyze(query: str) -> list[str]:
    """Query string -> list of analyzed terms, same rule as :func:`tokens`."""
    spaced = _re.sub(HAN_CHAR_PY, r" \1 ", (query or "").lower())
    return [w for w in _re.split(TOKEN_SPLIT, spaced) if w]


def term_freq(tok: Column, term: str) -> Column:
    """Occurrences of ``term`` in a token array (``array_remove`` is code-generated)."""
    return F.size(tok) - F.size(F.array_remove(tok, F.lit(term)))


def bm25_idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - doc_freq + F.lit(0.5)) / (doc_freq + F.lit(0.5)))


def bm25_term(tf: Column, dl: Column, avgdl: Column, idf: Column,
              k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """One term's BM25 contribution (0 when ``tf`` is 0)."""
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / avgdl)
    return idf * tf * F.lit(k1 + 1.0) / (tf + norm)
