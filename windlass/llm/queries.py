"""One registered query per operator, with production parameters over whole tables,
and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from windlass.llm import (ann, bpe, divergence, exact_dedup, filter_audit, html_extract, lang_id, lm_scoring, metric_join,
                          packing, quality, simhash, url_filter)
from windlass.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.encode_decode(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_dedup(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_html_extraction, op3_lm_scoring, op4_packing, op5_ann_search, op6_url_filter,
        op7_language_id, op8_byte_bpe, op9_quality_classifier, op10_simhash_dedup,
        op11_embedding_near_dedup, op12_source_divergence, op13_filter_interaction)}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_url_filter": url_filter.ORACLE_SQL,
    "op11_embedding_near_dedup": metric_join.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
    "op13_filter_interaction": filter_audit.ORACLE_SQL,
}
