"""Registration of the optional queries, and their columns on the smallest tables."""

import pytest

import __spark_entry__ as E
from retail_pulse.llm.queries import ORACLES, QUERIES

SF_SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_topk": ["query_id", "rank", "vec_id", "score"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_substring": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op6_htmltext": ["page_id", "url", "text", "n_chars"],
    "op7_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_decontam": ["doc_id", "item_id"],
    "op9_tokencount": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op10_urls": ["page_id", "host", "path", "rule", "verdict"],
    "op11_pqcodes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op12_whiten": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_rabitq": ["vec_id", "n_links", "component_id", "kept"],
}


def test_all_operators_are_registered():
    assert list(QUERIES) == sorted(COLUMNS, key=list(QUERIES).index) and set(QUERIES) == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_columns_and_rows(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    table = "pages" if name in ("op6_htmltext", "op10_urls") else "embeddings" if name in ("op11_pqcodes", "op12_whiten", "op13_rabitq") else "documents"
    if name not in ("op2_topk", "op8_decontam"):
        assert df.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count() * (4 if name == "op12_whiten" else 1)
