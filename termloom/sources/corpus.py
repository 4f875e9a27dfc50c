"""Labelled text corpora: class folders of text files, or a table of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import doc_name_of, file_of, folder_of, listed_name_of, path_text
from termloom.session import materialize
from termloom.sources.listing import manifest


def _files(root: str) -> str:
    return root.rstrip("/") + "/*/*"


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """``(src_id, doc_name, class, text)``, one row per line of every ``<root>/<class>/<file>``.

    A file beside the class folders, such as ``README.TXT``, is not on that level and is not read. Lines
    rather than whole files are rows, so a file of any size is split over tasks.
    """
    path = path_text(F.col("_metadata.file_path"))
    return (
        spark.read.text(_files(root))
        .select(path.alias("src_id"), F.col("value").alias("text"))
        .select("src_id", doc_name_of(F.col("src_id")).alias("doc_name"), folder_of(F.col("src_id")).alias("class"), "text")
    )


def corpus_from_table(table: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """The same columns from a table with one text per document."""
    return table.select(
        F.col(key).alias("src_id"),
        F.concat_ws(".", F.col(label), F.col(key)).alias("doc_name"),
        F.col(label).alias("class"),
        F.col(text).alias("text"),
    )


def inventory(paths: DataFrame, path: str = "path") -> DataFrame:
    """``(class, file_name, doc_name)`` of every file path of a class folder; names keep extensions."""
    p = F.col(path)
    return paths.select(folder_of(p).alias("class"), file_of(p).alias("file_name"), listed_name_of(p).alias("doc_name"))


def corpus_inventory(spark: SparkSession, root: str) -> DataFrame:
    """:func:`inventory` of a corpus folder, files of zero length, which a scan does not show, included."""
    return inventory(manifest(spark, root))


def count_corpus_files(spark: SparkSession, root: str) -> DataFrame:
    """``(n_docs)``, one row: files of all class folders, empty ones included; listed once, when this is called."""
    return materialize(manifest(spark, root).agg(F.count(F.lit(1)).alias("n_docs")), "n_docs")
