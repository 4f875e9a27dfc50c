"""Dictionaries that grow: ids given once stay, new words get the numbers that follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.lookup import Dictionary, as_dictionary
from termloom.sources.dictionary import dense_ids


def new_keys(dictionary: Dictionary | DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``(key)``: the distinct keys that the dictionary lacks. Null is no key.

    Beyond the broadcast limit both sides meet with one row per key.
    """
    dictionary = as_dictionary(dictionary)
    known = dictionary.df.select(key)
    given = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return given.join(F.broadcast(known) if dictionary.fits() else known, key, "left_anti")


def extend_ids(dictionary: Dictionary | DataFrame, keys: DataFrame, key: str, ident: str) -> DataFrame:
    """``(ident, key)``: the dictionary, and behind it the keys it lacks, in byte order.

    New ids are dense and begin after the largest one, so a matrix of old ids stays right. Ids that the dictionary
    skips, as those of repeated lines, stay unused. An empty dictionary gives ids from 1.
    """
    dictionary = as_dictionary(dictionary)
    last = dictionary.df.agg(F.coalesce(F.max(ident), F.lit(0)).alias("last"))
    ranked = dense_ids(new_keys(dictionary, keys, key), key, "rank")
    added = ranked.crossJoin(F.broadcast(last)).select((F.col("last") + F.col("rank")).alias(ident), key)
    return dictionary.df.select(ident, key).unionByName(added)
