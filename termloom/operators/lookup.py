"""Joins against dictionaries: broadcast behind a measured size, salted or filtered beyond it."""

from __future__ import annotations

import math
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.operators.filters import KeyFilter
from termloom.session import materialize

# Measured bytes up to which one side of a join may be sent to every executor.
BROADCAST_LIMIT = 64 << 20
# Allowance per row for the hash table around the column values.
ROW_OVERHEAD = 32
# Keys a summary of frequent ones keeps at a time. A key with more than
# twice SUMMARY_ERROR / HEAVY_ITEMS of all rows is in it, and that share is the most by which its number is wrong.
HEAVY_ITEMS = 4096
SUMMARY_ERROR = 3.5


class Dictionary:
    """A table of unique ids whose size Spark measures, once, before it may be broadcast."""

    def __init__(self, df: DataFrame, limit: int = BROADCAST_LIMIT):
        self.df = df
        self.limit = limit

    @cached_property
    def size(self) -> tuple[int, int]:
        """(rows, bytes), from a one-row aggregate."""
        width = F.lit(ROW_OVERHEAD)
        for field in self.df.schema.fields:
            width = width + _width(field)
        row = self.df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
        return row["n"], row["b"] or 0

    @property
    def rows(self) -> int:
        return self.size[0]

    def fits(self) -> bool:
        return self.size[1] <= self.limit

    def fits_per_row(self, row_bytes: int) -> bool:
        """Whether a table with at most one row per entry stays under the limit."""
        return self.rows * (row_bytes + ROW_OVERHEAD) <= self.limit

    def select(self, *columns: str) -> Dictionary:
        """Fewer columns; the measured size stays valid as an upper bound."""
        return self._derived(self.df.select(*columns))

    def without(self, words: DataFrame, on: str) -> Dictionary:
        """The same dictionary less some words; ids stay as they are."""
        return self._derived(self.df.join(words.select(on), on, "left_anti"))

    def summary(self, df: DataFrame) -> Dictionary:
        """A table made from this one with no more rows, and none wider, than it."""
        return self._derived(df) if self.fits() else Dictionary(df, self.limit)

    def _derived(self, df: DataFrame) -> Dictionary:
        smaller = Dictionary(df, self.limit)
        smaller.__dict__["size"] = self.size
        return smaller


def _width(field: T.StructField) -> Column:
    """Bytes of a column in a row, or more."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0))
    if isinstance(field.dataType, T.AtomicType):
        return F.lit(8)
    # An element takes two characters of JSON at least, and 16 bytes with its length and its place at most.
    return 8 + 8 * F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))


def as_dictionary(source: Dictionary | DataFrame) -> Dictionary:
    return source if isinstance(source, Dictionary) else Dictionary(source)


def hot_keys(rows_per_key: DataFrame, key: str) -> DataFrame:
    """``(key, salts)``, stored: the keys that hold more than 1/P of all rows, with as many slices as their share
    asks for (P = shuffle partitions). Fewer than P keys can."""
    slices = int(rows_per_key.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows_per_key.agg(F.sum("n").alias("all_rows"))
    return materialize(
        rows_per_key.crossJoin(F.broadcast(total))
        .where(F.col("n") * slices > F.col("all_rows"))
        .select(key, F.ceil(F.col("n") * slices / F.col("all_rows")).cast("int").alias("salts")),
        "hot",
    )


def _summary(rows: DataFrame, key: str) -> list[Column]:
    """Aggregates: the most frequent keys with their numbers, and the number of rows.

    Summaries of tasks merge; one has ``HEAVY_ITEMS`` entries at most, whatever the number of keys.
    """
    k = min(HEAVY_ITEMS, _partitions(rows))
    top = F.call_function("approx_top_k", F.col(key), F.lit(k), F.lit(HEAVY_ITEMS))
    return [top.alias("top"), F.count(F.lit(1)).alias("n")]


class FrequentItems(NamedTuple):
    """``items`` with their numbers, wrong by ``error`` at most; a key not among them has ``missing`` at most."""

    items: list[tuple]
    error: int
    missing: int


def frequent_items(rows: DataFrame, key: str, size: int = HEAVY_ITEMS) -> FrequentItems:
    """The most frequent keys by a summary of ``size`` entries; nulls are no keys."""
    top = F.call_function("approx_top_k", F.col(key), F.lit(size), F.lit(size))
    found = rows.where(F.col(key).isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    items = [(r["item"], r["count"]) for r in found["top"] or ()]
    error = math.ceil(SUMMARY_ERROR * found["n"] / size)
    last = items[-1][1] if len(items) >= size else 0
    return FrequentItems(items, error, max(2 * error, last + error))


def _summarizable(rows: DataFrame, key: str) -> bool:
    kinds = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    return isinstance(rows.schema[key].dataType, kinds)


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _heavy(rows: DataFrame, key: str, top: list[Row], n: int) -> DataFrame:
    """``(key, salts)`` as of :func:`hot_keys`, from a summary."""
    slices = _partitions(rows)
    found = [(r["item"], -(-r["count"] * slices // n)) for r in top or () if r["item"] is not None and r["count"] * slices > n]
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("salts", T.IntegerType())])
    return rows.sparkSession.createDataFrame(found, schema)


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """``(key, salts)`` as of :func:`hot_keys`, from one pass over ``rows`` that shuffles summaries only."""
    if not _summarizable(rows, key):
        return hot_keys(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key)
    found = rows.select(key).agg(*_summary(rows, key)).first()
    return _heavy(rows, key, found["top"], found["n"])


def stored_with_heavy_keys(rows: DataFrame, key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` written down, and their heavy keys as seen while they were written: ``rows`` is evaluated once."""
    if not _summarizable(rows, key):
        stored = materialize(rows, label)
        return stored, heavy_keys(stored, key)
    seen = Observation()
    stored = materialize(rows.observe(seen, *_summary(rows, key)), label)
    return stored, _heavy(rows, key, seen.get["top"], seen.get["n"])


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_key: DataFrame | None = None,
    hot: DataFrame | None = None,
    slice_by: str | None = None,
) -> DataFrame:
    """Join on ``key`` where single keys may hold a large share of ``big``.

    ``small`` has one row per key. Keys holding more than 1/P of all rows (P = shuffle partitions) are cut
    into slices by a hash of the row, as many as their share asks for, and their row of ``small`` is copied
    to each slice. Fewer than P keys can hold more than 1/P each, so the list of hot keys that is broadcast
    has fewer than P rows and ``small`` grows by fewer than 2P rows, whatever the data. Rows without a key match
    nothing and are cut into P slices.

    ``slice_by`` names a column whose values differ between rows that are otherwise equal, such as the place of
    a token (see :func:`termloom.operators.tokens.tokenize`); without it equal rows stay together. It has to
    have the same value when a lost task runs again.

    The hot keys are the list ``hot`` (see :func:`hot_keys`), or come from ``rows_per_key (key, n)`` when those counts
    are known, or from a pass over ``big`` (see :func:`heavy_keys`); :func:`stored_with_heavy_keys` spares a second
    evaluation where ``big`` is costly. A list that lacks a key, or has one too many, changes where rows go and not
    what comes out.
    """
    if hot is None:
        hot = heavy_keys(big, key) if rows_per_key is None else hot_keys(rows_per_key, key)
    salts = F.coalesce("salts", F.lit(1))
    of_row = F.when(F.col(key).isNull(), F.lit(_partitions(big))).otherwise(salts)
    slice_of_row = F.pmod(F.xxhash64(*([slice_by] if slice_by else big.columns)), of_row).cast("int")
    cut = big.join(F.broadcast(hot), key, "left").withColumn("salt", slice_of_row).drop("salts")
    copied = (
        small.join(F.broadcast(hot), key, "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("salts")
    )
    return cut.join(copied, [key, "salt"], how).drop("salt")


def lookup(
    big: DataFrame, dictionary: Dictionary | DataFrame, key: str, how: str = "inner", slice_by: str | None = None
) -> DataFrame:
    """Join with a dictionary: ``inner`` adds its columns, ``left_semi`` / ``left_anti`` only test the key.

    Beyond the broadcast limit ``big`` is evaluated once and written down; see :func:`lookup_texts` for rows too wide
    for that.
    """
    dictionary = as_dictionary(dictionary)
    side = dictionary.df if how == "inner" else dictionary.df.select(key)
    if dictionary.fits():
        return big.join(F.broadcast(side), key, how)
    stored, hot = stored_with_heavy_keys(big, key, "looked")
    return salted_join(stored, side, key, how, hot=hot, slice_by=slice_by)


def lookup_texts(rows: DataFrame, dictionary: Dictionary | DataFrame, key: str, how: str = "inner") -> DataFrame:
    """:func:`lookup`, ``inner`` or ``left_semi``, for rows that hold whole texts and should stay where they are.

    Beyond the broadcast limit the dictionary's keys become a filter of a stated size that is broadcast in its place.
    Only keys travel then, each once: those of ``rows`` that pass meet the dictionary, which tells the known ones from
    the strays. If the known ones fit, they are broadcast; if the strays do (and ``how`` only tests), they are taken out
    of what passes. Otherwise the rows that pass, without strays where those fit, are dealt by key.
    """
    dictionary = as_dictionary(dictionary)
    side = dictionary.df if how == "inner" else dictionary.df.select(key)
    if dictionary.fits():
        return rows.join(F.broadcast(side), key, how)
    keys = KeyFilter.of(dictionary.df, key, dictionary.rows)
    passed = keys.passing(rows.select(key), key).distinct()
    met = materialize(passed.join(side.withColumn("known", F.lit(True)), key, "left"), "keys")
    known = Dictionary(met.where("known").drop("known"), dictionary.limit)
    if known.fits():
        return rows.join(F.broadcast(known.df), key, how)
    strays = Dictionary(met.where("known IS NULL").select(key), dictionary.limit)
    left = keys.passing(rows, key)
    if strays.fits():
        left = left.join(F.broadcast(strays.df), key, "left_anti")
        if how == "left_semi":
            return left.select(rows.columns)
    return salted_join(left.select(rows.columns), side, key, how, hot=heavy_keys(rows.select(key), key))


def spread(rows: DataFrame, partitions: int, *by: str) -> DataFrame:
    """``rows`` dealt to so many partitions by the columns ``by``; 0 leaves them where they are.

    For inputs whose files are fewer than the cores, when the caller knows it: text that is shuffled before it
    is taken apart costs its whole size on the network.
    """
    # By a hash of the columns, not the columns themselves: counting by document then keeps an exchange
    # of partial counts of its own, which plans that use the counts twice can share.
    return rows.repartition(partitions, F.xxhash64(*by)) if partitions else rows
