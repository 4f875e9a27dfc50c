"""A matrix in order, as files of a given size with a manifest of the key range of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.session import materialize

ROWS_PER_FILE = 1 << 22
KEYS = ("term_id", "doc_id")


def write_ranges(matrix: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """``matrix`` below ``path``, ordered by (term_id, doc_id) over all files, ``rows_per_file`` at most in each.

    The order is by both ids, so a term of any size is spread over files. Its sampling reads a stored copy, not what
    made the matrix. Rows without a term id stand in front.
    """
    stored = materialize(matrix, "matrix")
    ordered = stored.orderBy(*KEYS)
    ordered.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    written = matrix.sparkSession.read.parquet(f"{path}/rows")
    by_file = written.groupBy(F.col("_metadata.file_name").alias("file"))
    ends = [f(F.col(k)).alias(f"{name}_{k}") for name, f in (("first", F.min), ("last", F.max)) for k in KEYS[:1]]
    by_file.agg(*ends, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/manifest")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """All rows."""
    return spark.read.parquet(f"{path}/rows")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(file, first_term_id, last_term_id, n)``."""
    return spark.read.parquet(f"{path}/manifest")


def rows_of_term(spark: SparkSession, path: str, term_id: int) -> DataFrame:
    """Rows of one term; files whose range does not hold it are not opened.

    The driver gets the names of the files that hold the term: one, or those that the term fills.
    """
    inside = F.lit(term_id).between(F.col("first_term_id"), F.col("last_term_id"))
    names = [r["file"] for r in manifest(spark, path).where(inside).select("file").collect()]
    if not names:
        return read_ranges(spark, path).limit(0)
    return spark.read.parquet(*[f"{path}/rows/{name}" for name in names]).where(F.col("term_id") == term_id)
