"""The stored search index against the search that analyzes every document."""

from collections import Counter

from retail_pulse.functions.text import analyze
from retail_pulse.operators import search, search_index

DOC = "id long, text string, lang string"
ROWS = [(1, "the ring and the bolt", "en"), (2, "", "en"), (3, None, "en"), (4, "ring ring RING 羽毛球 ring", "en"), (5, "and and and", "fr"), (6, "bolt", "en"), (7, "the " * 5000, "en")]


def page(df):
    return [tuple(r) for r in df.collect()]


def test_term_counts_of_each_document(spark):
    got = {r.id: (r._dl, r._terms) for r in search_index.term_counts(spark.createDataFrame(ROWS, DOC), "text", ["id"]).collect()}
    assert got == {i: (len(analyze(t)), dict(Counter(analyze(t)))) if t is not None else (None, None) for i, t, _ in ROWS}


def test_indexed_search_equals_the_search_over_the_texts(spark, tmp_dir):
    path = f"{tmp_dir}/index"
    docs = spark.createDataFrame(ROWS, DOC)
    old = spark.createDataFrame([(i, (t or "") + " the ring 球", "xx") for i, t, _ in ROWS[:5]] + [(8, "a ring", "en"), (None, "ring", "en")], DOC)
    search_index.index_documents(old, path, 0, "id", "text", ["lang"])
    extra = spark.createDataFrame([(8, "ring and the", "en")], DOC)
    for _ in range(2):  # the batch is run again
        search_index.index_documents(docs.union(extra), path, 1, "id", "text", ["lang"])
    whole = docs.union(extra)
    for text, filters, op in (("the ring", {"lang": "en"}, "or"), ("球 bolt", {}, "or"), ("the and", {}, "and"), ("absent", {}, "or"), ("", {}, "or")):
        q = search.BoolQuery("text", text, filters, op)
        for offset in (0, 2):
            assert page(search_index.indexed_hits(spark, path, q, "id", ["lang"], offset, 3)) == page(search.hits_page(whole, q, "id", ["lang"], offset, 3))
    stats = spark.read.parquet(f"{path}/statistics").groupBy("term").sum("df", "docs", "texts", "length").collect()
    live = {r.term: r["sum(df)"] for r in stats if r["sum(df)"]}
    rows = [t for _, t, _ in ROWS] + ["ring and the"]
    assert live == dict(Counter(w for t in rows for w in set(analyze(t))))
    assert [(r["sum(docs)"], r["sum(texts)"], r["sum(length)"]) for r in stats if r.term is None] == [(8, 7, sum(len(analyze(t)) for t in rows))]


def test_a_search_reads_the_folders_of_its_terms_and_tokenizes_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/index"
    search_index.index_documents(spark.createDataFrame(ROWS, DOC), path, 0, "id", "text", ["lang"])
    hits = search_index.indexed_hits(spark, path, search.BoolQuery("text", "ring"), "id", ["lang"])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "regexp_replace" not in plan and "RoundRobin" not in plan
