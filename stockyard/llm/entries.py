"""Named queries of the operators, with the SQL they must equal where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockyard.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    html_extraction,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    ranked_search,
    url_filters,
)
from stockyard.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))[0].drop("text_hash")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_units(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), url_filters.rule_frame(spark))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_bpe": op2_bpe,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extraction": op6_html_extraction,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_url_filters": op10_url_filters,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE_SQL = {
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op10_url_filters": url_filters.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_embedding_near_dedup": embedding_dedup.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}
