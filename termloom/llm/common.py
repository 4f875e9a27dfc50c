"""Helpers shared by the operators: free column names, kept tables, measured removals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.lookup import Dictionary
from termloom.session import materialize

# Fixed value: a word is a run of characters other than blank and the five ASCII line and tab controls.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores behind it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def without_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids``; rows with a null key stay.

    ``ids`` has one row per id. It is written down and measured: within the broadcast limit the rows of
    ``df``, which may be texts, stay where they are; beyond it both sides are dealt by key.
    """
    listed = Dictionary(materialize(ids, "ids"))
    side = F.broadcast(listed.df) if listed.fits() else listed.df
    return df.join(side, key, "left_anti").select(*map(column, df.columns))


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` written down with a number per row, which stays the same whenever the rows are read."""
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")


def first_of_each(docs: DataFrame, rows: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    """The rows of :func:`numbered` ``docs`` whose number is in ``kept (row)``, with the columns of ``docs``."""
    listed = materialize(kept, "kept").select(F.col("row").alias(row))
    gone = rows.select(row).join(listed, row, "left_anti")
    return without_ids(rows, gone, row).select(*map(column, docs.columns))
