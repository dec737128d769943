"""A corpus cleaning pipeline over ``documents``: each stage is one operator of
``windlass.llm``, its result written as Parquet and reread by the next one.

Stages take ``(spark, docs, sf_dir)``. All but the last return the columns of
``docs``, with fewer rows; extra columns pass through. An empty table passes
through all stages and gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from windlass.llm import exact_dedup, lang_id, packing, quality, simhash
from windlass.llm.common import table, write_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text stays below their language's threshold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that lie close enough to a learned language."""
    return lang_id.keep_known(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints, the document with the smallest id."""
    return simhash.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences that hold what is left."""
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_dedup", near_duplicates),
    ("packing", pack),
]

ORACLE_SQL = None  # SQL can't express the models, fingerprints and packing; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
