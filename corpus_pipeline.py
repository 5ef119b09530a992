"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before it kept, as written to the shared folder, and
its decisions take effect: documents go, texts change, pieces get their places.

Defined results of ``run``: null texts, empty texts and texts without a letter go in the first stage; of repeated rows and
of rows that share a ``doc_id`` one stays (second stage), rows without ``doc_id`` are neither compared nor cut and stay;
very long texts are read whole and cut into pieces at the end; of equal texts the smallest ``doc_id`` stays; an
empty table gives no rows; columns beyond those of documents are carried through the first four stages, whatever their
names. The tables between the stages lie in the folder of ``spark.checkpoint.dir``, one folder per application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import jaccard_join, language_id, packing, secret_scan, substring_dedup
from larder.llm.shared import documents, settled, shipped, tokenizer_file


@shipped
def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``lang`` as the n-gram filters say; texts in no language (null, or without a letter) go."""
    return language_id.identify(docs)


@shipped
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every group of similar ones stays."""
    return jaccard_join.one_of_each(docs)


@shipped
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand elsewhere first are cut out; documents that have nothing else go."""
    return substring_dedup.remove_repeats(docs)


@shipped
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are masked; every document stays."""
    return secret_scan.masked(docs)


@shipped
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the tokenised documents in sequences of 4096 ids."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_languages),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: No stage of these can be said in SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
