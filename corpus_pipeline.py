"""The corpus pipeline: documents whose language is known and whose text is sound, one of each group of near
copies, packed into training sequences.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is written as Parquet and read again
as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from termloom.llm import language_id, packing, quality_rules, simhash
from termloom.llm.common import table
from termloom.session import materialize

# No SQL: a fitted model, fingerprints and tokens are beyond it. tests/llm compares with brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the model is fitted on labelled ones among them."""
    return language_id.language_filter(docs)


def sound_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source."""
    return quality_rules.quality_filter(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that SimHash links: four-word shingles, four bits at most."""
    return simhash.near_duplicate_filter(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("quality_rules", sound_text),
    ("near_duplicates", one_of_each),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
