"""The operators bound to the test tables with production parameters, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from larder.llm import (
    alignment,
    jaccard_join,
    language_id,
    license_scan,
    lm_scoring,
    near_vectors,
    nearest,
    packing,
    ranked_search,
    secret_scan,
    substring_dedup,
    token_counts,
    transducer,
)
from larder.llm.shared import benchmark, documents, embeddings, shipped, tokenizer_file, tokenizer_pattern

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document; ``round_trip`` decodes them again."""
    return transducer.encode(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat text which stands elsewhere first: what is repeated, and which documents keep it."""
    return substring_dedup.by_document(substring_dedup.repeated_spans(documents(spark, sf_dir)))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(documents(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(embeddings(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.summary(secret_scan.find_secrets(documents(spark, sf_dir)))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(documents(spark, sf_dir)))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_held_out(documents(spark, sf_dir))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(embeddings(spark, sf_dir), "vec_id % 20 = 0")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern()
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return alignment.align(documents(spark, sf_dir), *paths, ranks, pattern)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    found = [
        op1_sentencepiece,
        op2_substring_dedup,
        op3_ngram_jaccard_join,
        op4_best_fit_packing,
        op5_embedding_near_dedup,
        op6_secret_scan,
        op7_license_scan,
        op8_language_id,
        op9_nearest_neighbours,
        op10_token_counts,
        op11_token_alignment,
        op12_ranked_search,
        op13_lm_scoring,
    ]
    return {run.__name__: shipped(run) for run in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op12_ranked_search": ranked_search.oracle()}
