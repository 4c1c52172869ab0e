"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

language ID -> near duplicates -> secrets -> mix -> pieces.  Every stage works on all rows its
predecessor kept; all but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracksync.llm import jaccard, language_id, mixing, pieces, secrets
from tracksync.llm.common import importable, materialise, read_table


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, null ones among them, and those of no decided language go."""
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a 5-word Jaccard similarity of 0.8 stays: that of the smallest doc_id."""
    return jaccard.keep_one_of_each(docs, words=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark, and n_chars follows."""
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.emit_copies(mixing.mix_sources(docs), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (unsigned 32-bit, little-endian, begin and end ids included) of each copy."""
    encoded = pieces.encode_pieces(docs, pieces.model_bytes())
    return encoded.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_languages),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", hide_secrets),
    ("mixing", mix),
    ("pieces", encode),
]

#: The language model and the tokenizer have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
