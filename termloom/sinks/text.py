"""Tab-separated text output, one folder of part files per result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.text import class_of
from termloom.operators.lookup import Dictionary
from termloom.session import materialize
from termloom.sinks import folders


def _field(column: T.StructField) -> Column:
    """A field's text. A null double is a share of nothing, written ``NaN``; other nulls would be no field at
    all and shift those behind them, so they are an error."""
    text = F.col(column.name).cast("string")
    if isinstance(column.dataType, (T.DoubleType, T.FloatType)):
        return F.coalesce(text, F.lit("NaN"))
    return F.coalesce(text, F.raise_error(F.lit(f"null in column {column.name} of a text output")).cast("string"))


def write_rows(df: DataFrame, path: str) -> None:
    """All columns in order, tab-separated; doubles in Java's shortest exact form, null ones as ``NaN``."""
    df.select(F.concat_ws("\t", *map(_field, df.schema.fields)).alias("value")).write.text(path)


def write_matrix(matrix: DataFrame, path: str, ordered: bool = False) -> None:
    """``term_id \\t doc_id \\t value``, on request sorted over all part files by the bytes of both ids."""
    write_rows(sort_matrix(matrix) if ordered else matrix, path)


def sort_matrix(matrix: DataFrame) -> DataFrame:
    """Global order of the keys as text (``10`` before ``2``), by range partitioning."""
    return matrix.orderBy(F.col("term_id").cast("string"), F.col("doc_id").cast("string"))


def write_dictionary(words: DataFrame, word: str, ident: str, path: str) -> None:
    """One word per line in id order; part files follow each other, so line numbers give the ids back."""
    words.orderBy(ident).select(word).write.text(path)


# Rows of one document that go to one file.
ROWS_PER_FILE = 1 << 20


def write_per_document(counts: DataFrame, path: str) -> None:
    """``(doc_name, term_id, freq)`` as one folder ``class=…/doc_name=…`` per document, in one job.

    Rows are dealt by document, so a document is one file, and several where it has more than ``ROWS_PER_FILE``
    rows; a class folder holds its own documents only. The number of tasks is given, as creating files takes longer
    than the rows suggest. Tasks write them themselves (:mod:`folders`) unless Arrow does not know the file system.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = counts.groupBy("doc_name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ROWS_PER_FILE)
    parts = Dictionary(
        materialize(sizes.select("doc_name", F.ceil(F.col("n") / ROWS_PER_FILE).cast("int").alias("parts")), "large")
    )
    joined = counts.join(F.broadcast(parts.df) if parts.fits() else parts.df, "doc_name", "left")
    part = F.pmod(F.xxhash64("term_id"), F.coalesce("parts", F.lit(1)))
    line = F.concat_ws("\t", F.col("term_id").cast("string"), F.col("freq").cast("string"))
    name = F.nullif(F.col("doc_name"), F.lit(""))  # both have one folder
    rows = joined.select(class_of(name).alias("class"), name.alias("doc_name"), part.alias("part"), line.alias("value"))
    dealt = rows.repartition(tasks, "class", "doc_name", "part")
    if folders.opens(counts.sparkSession, path):
        folders.write(dealt, path)
    else:
        dealt.drop("part").write.partitionBy("class", "doc_name").text(path)


def read_per_document(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_name, term_id, freq)`` back from :func:`write_per_document`."""
    if folders.opens(spark, path):
        lines = folders.read(spark, path)
    else:
        lines = spark.read.schema("value STRING, class STRING, doc_name STRING").text(path)
    fields = F.split("value", "\t")
    return lines.select("doc_name", fields[0].cast("bigint").alias("term_id"), fields[1].cast("bigint").alias("freq"))
