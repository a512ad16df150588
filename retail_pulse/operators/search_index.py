"""A stored search index: documents are analyzed once, when they are indexed, and searched without tokenizing.

Two tables under one path:

* ``documents``: per version of a document its fields, length and a map term -> count, made of the sorted tokens by
  array functions in one pass, without a shuffle;
* ``statistics``: changes of the document frequency of each term and, under the NULL term, of the number of documents, of those
  with a text, and of their total length. A batch adds what its documents bring and takes off what the versions that it replaces had brought, so the
  statistics of a search are the sums of a few rows, from the folders of the query's terms.

Both are written under the batch id: a replayed batch rewrites its own rows and finds the same older versions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_pulse.functions.text import tokens
from retail_pulse.operators.dedup import first_per_key
from retail_pulse.operators.search import BoolQuery, _matched, _page, _tf_cols, _with_score
from retail_pulse.sources.sinks import bucket_of, latest_documents, write_batch_partition

TERM_BUCKETS = 64
_CHANGES = ("df", "docs", "texts", "length")
_STATS = "term string, df bigint, docs bigint, texts bigint, length bigint, _bucket int, _batch_id bigint"


def term_counts(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep``, ``_dl`` (token count) and ``_terms`` (term -> count) of each document, both NULL without a text."""
    tok = docs.select(*keep, F.sort_array(tokens(text_col)).alias("_tok")).withColumn("_dl", F.size("_tok"))
    # the places where a term differs from the one before it
    new_term = F.filter(F.sequence(F.lit(0), F.col("_dl")), lambda i: (i < F.col("_dl")) & ((i == 0) | (F.get("_tok", i) != F.get("_tok", i - 1))))
    runs = tok.withColumn("_runs", new_term)
    terms = F.transform("_runs", lambda i: F.get("_tok", i))
    counts = F.transform("_runs", lambda i, k: F.coalesce(F.get("_runs", k + 1), F.col("_dl")) - i)
    return runs.select(*keep, "_dl", F.map_from_arrays(terms, counts).alias("_terms"))


def index_documents(docs: DataFrame, path: str, batch_id: int, id_col: str, text_col: str, fields: list[str], order_col: str | None = None) -> None:
    """Index one batch: a document whose id is there already replaces it; of several under one id the last by ``order_col``
    (else by content) counts. Rows without an id are left out."""
    spark = docs.sparkSession
    keep = [id_col] + [f for f in fields if f != id_col]
    seq = (F.col(order_col) if order_col else F.xxhash64(text_col, *keep)).cast("bigint")
    one = first_per_key(docs.where(F.col(id_col).isNotNull()).withColumn("_seq", seq), [id_col], [F.col("_seq").desc()])
    new = term_counts(one, text_col, [*keep, "_seq"])
    # written once and read back: no cache of all maps beside the shuffles
    write_batch_partition(new, f"{path}/documents", batch_id)
    new = spark.read.schema(T.StructType(new.schema.fields + [T.StructField("_batch_id", T.LongType())])).parquet(f"{path}/documents").where(F.col("_batch_id") == F.lit(int(batch_id)))
    changes = _changes(new.select("_dl", F.map_keys("_terms").alias("_words")), 1)
    old = _versions(spark, path, batch_id)
    if old is not None:
        replaced = latest_documents(old.join(new.select(id_col), id_col, "left_semi").select(id_col, "_dl", F.map_keys("_terms").alias("_words"), "_batch_id", "_seq"), id_col)
        changes = changes.unionByName(_changes(replaced, -1))
    stats = changes.groupBy("term").agg(*[F.sum(c).alias(c) for c in _CHANGES]).where("df <> 0 OR docs <> 0 OR texts <> 0 OR length <> 0") \
        .withColumn("_bucket", _term_bucket(F.col("term")))
    write_batch_partition(stats, f"{path}/statistics", batch_id, ["_bucket"])


def _term_bucket(term):
    """Hash bucket of a term; the NULL term has a folder of its own."""
    return F.when(term.isNull(), F.lit(-1)).otherwise(bucket_of(term, TERM_BUCKETS))


def _changes(docs: DataFrame, sign: int) -> DataFrame:
    """What documents (``_dl``, ``_words``) add to the statistics, or take off."""
    s = F.lit(sign).cast("bigint")
    zero = F.lit(0).cast("bigint")
    terms = docs.select(F.explode("_words").alias("term"), s.alias("df"), zero.alias("docs"), zero.alias("texts"), zero.alias("length"))
    texts = F.when(F.col("_dl").isNotNull(), s).otherwise(zero)
    return terms.unionByName(docs.select(F.lit(None).cast("string").alias("term"), zero.alias("df"), s.alias("docs"), texts.alias("texts"),
                                         F.coalesce(s * F.col("_dl"), zero).alias("length")))


def _versions(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    try:
        t = spark.read.parquet(f"{path}/documents")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return t if below is None else t.where(F.col("_batch_id") < F.lit(int(below)))


def indexed_hits(spark: SparkSession, path: str, q: BoolQuery, id_col: str, fields: list[str], offset: int = 0, size: int = 10, digits: int = 6) -> DataFrame:
    """The hits page of :func:`retail_pulse.operators.search.hits_page`, from the stored index: nothing is tokenized and no table is written.

    Of the stored maps only the query's terms are looked up, before the latest version of each document is found.
    """
    terms = q.terms()
    stats = spark.read.schema(_STATS).parquet(f"{path}/statistics")
    mine = F.col("_bucket") == F.lit(-1)
    for t in terms:
        mine = mine | ((F.col("_bucket") == bucket_of(F.lit(t), TERM_BUCKETS)) & (F.col("term") == F.lit(t)))
    df = [F.sum(F.when(F.col("term") == F.lit(t), F.col("df"))).alias(f"_df{i}") for i, t in enumerate(terms)]
    st = stats.where(mine).agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"), F.sum("length").alias("length"), *df).first()
    keep = [id_col] + [f for f in fields if f != id_col]
    cols = list(dict.fromkeys(keep + list(q.term_filters)))
    tfs = [F.coalesce(F.element_at("_terms", F.lit(t)), F.lit(0)).alias(c) for t, c in zip(terms, _tf_cols(terms))]
    t = spark.read.parquet(f"{path}/documents").select(*cols, "_dl", *tfs, "_batch_id", "_seq")
    narrow = latest_documents(t, id_col).withColumn("_m", _matched(terms, q.operator))
    s = _with_score(narrow, q, keep, st["docs"], st["length"] / st["texts"] if st["texts"] else 0.0, [st[f"_df{i}"] or 0 for i in range(len(terms))], None)
    return _page(s, id_col, fields, offset, size, digits)
