"""What the named queries promise: columns, types and a row for each row of their table."""

import pytest

from stockyard.llm import entries

PROMISED = {
    "op1_ngram_jaccard_join": ("documents", "doc_id:bigint class_id:bigint n_links:bigint"),
    "op2_bpe": ("documents", "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string"),
    "op3_quality_classifier": ("documents", "doc_id:bigint held_out:boolean score:double predicted:int"),
    "op4_best_fit_packing": (None, "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint"),
    "op5_quality_rules": (
        "documents",
        "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint "
        "base_failed:boolean kept:boolean",
    ),
    "op6_html_extraction": ("pages", "page_id:bigint url:string text:string n_chars:bigint"),
    "op7_language_id": ("documents", "doc_id:bigint held_out:boolean lang_pred:string score:double"),
    "op8_exact_dedup": ("documents", "doc_id:bigint keep_id:bigint group_size:bigint kept:boolean text_sha256:string"),
    "op9_substring_dedup": (None, "doc_id:bigint start:bigint length:bigint n_words:bigint kept_doc_id:bigint"),
    "op10_url_filters": ("pages", "page_id:bigint host:string path:string rule:string verdict:string"),
    "op11_hard_negatives": (
        None,
        "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
    ),
    "op12_embedding_near_dedup": ("embeddings", "vec_id:bigint n_links:bigint component_id:bigint kept:boolean"),
    "op13_ranked_search": (None, "item_id:bigint rank:int doc_id:bigint score:bigint"),
}


def test_every_operator_is_promised():
    assert set(entries.QUERIES) == set(PROMISED)


@pytest.mark.parametrize("name", sorted(PROMISED))
def test_promise(spark, small, name):
    table, columns = PROMISED[name]
    result = entries.QUERIES[name](spark, small)
    assert set(columns.split()) <= {f"{c}:{kind}" for c, kind in result.dtypes}
    rows = result.count()
    if table:
        assert rows == spark.read.parquet(f"{small}/{table}.parquet").count()
    else:
        assert rows > 0
