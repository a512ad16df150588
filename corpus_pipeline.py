"""From raw documents to encoded training text: each stage reads all that the one before it kept.

A stage is a function of (spark, docs, sf_dir). ``run`` writes each stage's rows as Parquet in the
shared folder and reads them back as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retail_pulse.llm import bpe, decontam, langid, simhash, substring
from retail_pulse.llm.common import NULL_ID, fresh, table, text_crc, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are in none of the learned languages: no letter in them, or too few n-grams of the predicted one.

    The filter is trained on the labelled documents of the stage's own input whose crc32(doc_id) mod 5 is not 0 (NULL ids
    are not learned from). The least share of hits comes from the labelled documents that are left over. A text with too few
    n-grams to judge stays.
    """
    learned = text_crc("doc_id", 5) != 0
    model = langid.train(docs.filter(learned))
    least = langid.least_shares(docs.filter(~learned), model)
    lang, score, share = (fresh(docs.columns, c) for c in ("lang_pred", "lang_score", "lang_share"))
    found = langid.classify(docs, model, lang_out=lang, score_out=score, share_out=share).filter(F.col(lang) != langid.UND)
    if least:
        needed = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col(lang)]
        found = found.filter(F.col(share).isNull() | (F.col(share) > needed))
    return found.drop(lang, score, share)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class: the one with the smallest id (NULL ids last), then the smallest text hash.

    A row is known by its id and text, so different texts under one id, or without an id, are judged on their own. Of rows
    that are equal in both one stays. NULL and empty texts are one class, linked like any other fingerprint.
    """
    keep = simhash.representatives(docs, shingle=3, max_distance=3)
    sig, n = fresh(docs.columns, "text_sig"), fresh(docs.columns, "nth")
    keyed = docs.withColumn(sig, F.xxhash64(F.coalesce("text", F.lit(""))))
    one = keyed.join(keep, keyed["doc_id"].cast("long").eqNullSafe(keep["id"]) & (keyed[sig] == keep["sig"]), "left_semi")
    others = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    return (one.withColumn(n, F.row_number().over(Window.partitionBy("doc_id", sig).orderBy(others)))
            .filter(F.col(n) == 1).select(docs.columns))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the 20-word windows that also start earlier; documents without a word left go.

    A document that loses nothing keeps its text as it is; the others keep their remaining words joined by one
    space. ``n_chars`` follows the text. Rows with the same id and text are cut alike.
    """
    return substring.cut_repeats(docs, window=20)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item, verbatim or paraphrased.

    A row is known by its id and text: rows that are equal in both are judged alike, different texts under one id, or without an
    id, on their own. NULL and empty texts hold nothing and stay; very long texts are searched whole; an empty table, or a benchmark
    without a text, drops nothing.
    """
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    hit = found.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    same = (F.coalesce(docs["doc_id"], F.lit(NULL_ID)) == hit["bad_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == hit["bad_hash"])
    return docs.join(hit, same, "left_anti")


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the token ids of each text (``token_ids``), and their number (``n_tokens``); a column of such a name stays, the new one gets underscores.

    Every row stays, repeated ones too; NULL and empty texts have no ids; texts of any length are encoded whole.
    """
    ids = fresh(docs.columns, "token_ids")
    out = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids_out=ids)
    return out.withColumn(fresh(docs.columns, "n_tokens"), F.size(ids).cast("long"))


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("bpe_encode", bpe_encode),
]

#: SQL has no form for these stages; they are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
