from retail_pulse.operators.search import BoolQuery, hits_page, scored_matches, terms_buckets, total_hits

SCHEMA = "id bigint, sex string, favo string, class_id string, age int"
DOCS = [
    (1, "true", "羽毛球 tennis", "c1", 20),
    (2, "true", "羽毛 swimming", "c1", 25),
    (3, "false", "羽毛球 羽毛球 羽毛球", "c2", 30),
    (4, "true", "football", "c2", 22),
    (5, "true", "羽毛球", "c2", 21),
    (6, "true", "球 tennis", "c3", 28),
]


def test_bool_query_filter_excludes_better_text_match(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    q = BoolQuery("favo", "羽毛球", {"sex": "true"})
    ids = [r.id for r in hits_page(docs, q, "id", ["class_id", "age"], 0, 10).collect()]
    assert 3 not in ids
    assert total_hits(docs, q).first().total == 4  # 1, 2, 5, 6 (any Han token)
    buckets = {r.class_id: (r.doc_count, r.max_age) for r in terms_buckets(docs, q, "class_id", "age").collect()}
    assert buckets == {"c1": (2, 25), "c2": (1, 21), "c3": (1, 28)}


def test_buckets_cover_all_matches_not_the_page(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    q = BoolQuery("favo", "羽毛球", {"sex": "true"})
    page = hits_page(docs, q, "id", ["class_id"], 0, 2).collect()
    assert len(page) == 2
    assert sum(r.doc_count for r in terms_buckets(docs, q, "class_id", "age").collect()) == 4


def test_partial_han_match_scores_lower(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    q = BoolQuery("favo", "羽毛球", {"sex": "true"})
    s = {r.id: r.score for r in scored_matches(docs, q, ["id"]).collect()}
    assert s[5] > s[2] > 0
    assert s[1] > s[2]


def test_and_operator(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    q = BoolQuery("favo", "羽毛球 tennis", {}, operator="and")
    assert sorted(r.id for r in scored_matches(docs, q, ["id"]).collect()) == [1]
