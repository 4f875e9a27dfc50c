"""The relations a corpus run needs, derived from the test tables (see FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.lookup import Dictionary
from termloom.operators.tokens import clean_tokens
from termloom.plans.pipeline import TermStatistics
from termloom.session import materialize
from termloom.sources.corpus import corpus_from_table
from termloom.sources.dictionary import dense_ids, vocabulary_ids

# The stop list. Lower case on purpose, so that "The" and "Und" survive.
STOPWORDS = ("the", "and", "of", "to", "in", "a", "de", "la", "und", "die", "der", "el", "los", "les")

# The test tables are single files, which one task would read alone.
PARTITIONS = 16

_dictionaries: dict[tuple, Dictionary] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str, label: str = "lang") -> DataFrame:
    return corpus_from_table(table(spark, sf_dir, "documents"), "doc_id", "text", label)


def stopwords(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{word}')" for word in STOPWORDS)
    return spark.sql(f"SELECT term FROM VALUES {rows} AS t(term)")


def benchmark_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_tokens(table(spark, sf_dir, "benchmark").select("text"), partitions=PARTITIONS)


def labelled_documents(spark: SparkSession, sf_dir: str, label: str = "lang") -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("src_id"))
    return corpus(spark, sf_dir, label).select("src_id", "doc_name").join(labels, "src_id")


def _stored(spark: SparkSession, key: tuple, build) -> Dictionary:
    """Dictionaries are inputs of a run, so each is written once per session and then read."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _dictionaries:
        _dictionaries[key] = Dictionary(materialize(build(), key[1]))
    return _dictionaries[key]


def terms(spark: SparkSession, sf_dir: str) -> Dictionary:
    return _stored(spark, ("terms", sf_dir), lambda: vocabulary_ids(benchmark_tokens(spark, sf_dir)))


def docs(spark: SparkSession, sf_dir: str, label: str = "lang") -> Dictionary:
    return _stored(
        spark, ("docs", sf_dir, label), lambda: dense_ids(labelled_documents(spark, sf_dir, label), "src_id", "doc_id")
    )


def statistics(spark: SparkSession, sf_dir: str, label: str = "lang", **options) -> TermStatistics:
    return TermStatistics(
        corpus(spark, sf_dir, label),
        terms(spark, sf_dir),
        docs(spark, sf_dir, label),
        stopwords(spark),
        doc_key="src_id",
        **{"partitions": PARTITIONS, "report_format": "%.6f", **options},
    )


def matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value)``: one text line per line item, well formed or malformed by its line number.

    Shapes 0-1: three fields, 2: two fields, 3: four fields, 4: a leading blank, 5: a trailing blank. Rows
    with return flag ``A`` have a third field that is no number.
    """
    part, supplier = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    quantity = F.when(F.col("l_returnflag") == "A", F.lit("x")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    three = F.concat_ws("\t", part, supplier, quantity)
    shape = F.col("l_linenumber") % 6
    line = (
        F.when(shape == 2, F.concat_ws("\t", part, supplier))
        .when(shape == 3, F.concat_ws("\t", three, F.lit("9")))
        .when(shape == 4, F.concat(F.lit(" "), three))
        .when(shape == 5, F.concat(three, F.lit(" ")))
        .otherwise(three)
    )
    return table(spark, sf_dir, "lineitem").select(line.alias("value"))


def foreign_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(term_id, doc_id, freq, place)`` with repeated keys and ids no dictionary knows."""
    return table(spark, sf_dir, "lineitem").select(
        F.monotonically_increasing_id().alias("place"),
        F.col("l_partkey").alias("term_id"),
        F.col("l_orderkey").alias("doc_id"),
        F.col("l_quantity").cast("bigint").alias("freq"),
    )
