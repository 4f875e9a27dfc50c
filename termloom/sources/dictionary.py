"""Term and document dictionaries, and stop lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.operators.lookup import BROADCAST_LIMIT, Dictionary
from termloom.session import materialize

# monotonically_increasing_id() keeps the partition above this bit and the row number below it.
_ROW_BITS = 33


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, line)``: lines of a text file or folder, numbered from 1 over its files in order of their names.

    A task reads its splits one after the other, so within a split row numbers follow the lines. Lines are
    written down with those, the lines of each split are counted, and a running sum over the splits, in order of
    file and place in it, says with which number each begins.
    """
    found = materialize(
        spark.read.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "lines",
    )
    splits = found.groupBy("file", "block").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("n"))
    # One row per split.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least")).alias("shift"))
    table = Dictionary(materialize(starts, "splits"))
    joined = found.join(F.broadcast(table.df) if table.fits() else table.df, ["file", "block"])
    return joined.select("value", (F.col("shift") + F.col("place") + 1).alias("line"))


def load_ids(spark: SparkSession, path: str, word: str, ident: str) -> DataFrame:
    """``(ident, word)`` of a text file, the id being the 1-based line number.

    A repeated line keeps its last number and still uses up the earlier ones.
    """
    lines = numbered_lines(spark, path).groupBy(F.col("value").alias(word))
    return lines.agg(F.max("line").alias(ident)).select(ident, word)


def load_term_dictionary(spark: SparkSession, path: str, limit: int = BROADCAST_LIMIT) -> Dictionary:
    return Dictionary(materialize(load_ids(spark, path, "term", "term_id"), "terms"), limit)


def load_doc_dictionary(spark: SparkSession, path: str, limit: int = BROADCAST_LIMIT) -> Dictionary:
    return Dictionary(materialize(load_ids(spark, path, "doc_name", "doc_id"), "docs"), limit)


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``(term)``: the lines of a stop list, untrimmed."""
    return spark.read.text(path).select(F.col("value").alias("term")).distinct()


def dense_ids(df: DataFrame, key: str, ident: str) -> DataFrame:
    """``df`` with ``ident``, the 1-based rank of its unique ``key``, first.

    No window sees more than one row per partition: rows are range-partitioned and sorted, written down
    once, and each partition's first rank comes from the running sum of partition sizes.
    """
    columns = df.columns
    ranged = materialize(
        df.repartitionByRange(key)
        .sortWithinPartitions(key)
        .select("*", F.monotonically_increasing_id().alias("place")),
        "ranged",
    ).select(
        *columns,
        F.shiftright("place", _ROW_BITS).alias("part"),
        F.col("place").bitwiseAND((1 << _ROW_BITS) - 1).alias("row"),
    )
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("row") + 1
    # One row per partition, so a proven bound on what is broadcast.
    return ranged.join(F.broadcast(starts), "part").select(rank.alias(ident), *columns)


def vocabulary_ids(tokens: DataFrame) -> DataFrame:
    """``(term_id, term)``: a term dictionary of the distinct terms of a token table, in byte order."""
    return dense_ids(tokens.select("term").distinct(), "term", "term_id")
