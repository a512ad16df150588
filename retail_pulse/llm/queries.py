"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_pulse.llm import bpe, decontam, htmltext, langid, pqcodes, rabitq, simhash, substring, tokencount, topk, toxicity, urlfilter, whiten
from retail_pulse.llm.common import table, text_crc


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned where crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(text_crc("doc_id", 4) != 2)
    return toxicity.score(docs, toxicity.fit(docs, labels), threshold=0.3).select(
        "doc_id", (text_crc("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 greatest integer products of every vector whose id is divisible by 100, against all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


_OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, p.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id <> p.vec_id AND q.vec_id % 100 = 0)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s) WHERE rank <= 10
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document (3-word shingles, 3 bits)."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=3)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count, digest of the ids and digest of the decoded bytes of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document once the 20-word windows that also start earlier are removed."""
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=20).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


_OP5_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL)),
windows AS (
  SELECT doc_id, pos, w, string_agg(w, ' ') OVER ahead AS win, count(*) OVER ahead AS n
  FROM words WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
judged AS (
  SELECT doc_id, pos, w, n = 20 AND row_number() OVER (PARTITION BY win, n = 20 ORDER BY doc_id, pos) > 1 AS gone FROM windows),
covered AS (
  SELECT doc_id, pos, w, bool_or(gone) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS cut FROM judged),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (cut) AS n_removed, string_agg(w, ' ' ORDER BY pos) FILTER (NOT cut) AS t
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def op6_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned where crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(text_crc("doc_id", 5) != 0))
    return langid.classify(docs.select("doc_id", "text"), model).select(
        "doc_id", (text_crc("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds, verbatim or paraphrased."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "cosine", "lcs", "answer")


def op9_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than 512 tokens."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=512)


#: the rules of the contract (fixed values)
URL_RULES = ["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url.

    The labelled urls are those that a rule decides: the model carries the rules' judgement over to the other urls.
    """
    pages, rules = table(spark, sf_dir, "pages"), urlfilter.parse_rules(URL_RULES)
    labelled = urlfilter.with_parts(pages.select("url")).select("url", urlfilter.ruled(rules, "verdict").alias("verdict")).filter("verdict IS NOT NULL")
    return urlfilter.judge(pages, rules, urlfilter.train(labelled))


def op11_pqcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code, squared error and label's error of every vector: 4 parts, 256 entries, 4 rounds."""
    return pqcodes.compress(table(spark, sf_dir, "embeddings"))


def _op11_sql(rounds: int = 4) -> str:
    """The rounds unrolled: a{i} assigns the parts to the codebooks b{i} (distance * 256 + index, so ties go to the lower index)."""
    steps = ["""
v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, list_slice(e, p * len(e) // 4 + 1, (p + 1) * len(e) // 4) AS s FROM v, (SELECT unnest([0, 1, 2, 3]) AS p)),
b0 AS MATERIALIZED (
  SELECT p, i, s AS c FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM v QUALIFY i < 256) USING (vec_id))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, label, p, s, min(256 * CAST(list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) + i) AS best
  FROM parts JOIN b{i} USING (p) GROUP BY vec_id, label, p, s)""")
        if i < rounds:
            steps.append(f"""
m{i} AS MATERIALIZED (
  SELECT p, i, list(mean ORDER BY place) AS c FROM (
    SELECT p, best % 256 AS i, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
    FROM (SELECT p, best, unnest(s) AS x, generate_subscripts(s, 1) AS place FROM a{i}) GROUP BY p, best % 256, place) GROUP BY p, i),
b{i + 1} AS MATERIALIZED (SELECT b{i}.p, b{i}.i, coalesce(m{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN m{i} ON b{i}.p = m{i}.p AND b{i}.i = m{i}.i)""")
    return "WITH" + ",".join(steps) + f""",
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM b{rounds}),
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest
"""


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector on the 4 leading components."""
    return whiten.whiten(table(spark, sf_dir, "embeddings"), k=4, scale=256)


def op13_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every vector at a cosine of 0.9."""
    return rabitq.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


_OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id <= coalesce(least, vec_id) AS kept
FROM embeddings LEFT JOIN classes c ON vec_id = c.a LEFT JOIN degrees d ON vec_id = d.a
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_topk": op2_topk,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_substring": op5_substring,
    "op6_htmltext": op6_htmltext,
    "op7_langid": op7_langid,
    "op8_decontam": op8_decontam,
    "op9_tokencount": op9_tokencount,
    "op10_urls": op10_urls,
    "op11_pqcodes": op11_pqcodes,
    "op12_whiten": op12_whiten,
    "op13_rabitq": op13_rabitq,
}

#: DuckDB SQL of the queries that SQL can express
ORACLES: dict[str, str] = {
    "op2_topk": _OP2_SQL,
    "op5_substring": _OP5_SQL,
    "op11_pqcodes": _op11_sql(),
    "op13_rabitq": _OP13_SQL,
}
