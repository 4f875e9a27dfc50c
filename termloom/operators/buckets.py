"""Dictionaries stored in buckets of their ids: rows come to them, they themselves are never shuffled."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.lookup import Dictionary, as_dictionary, stored_with_heavy_keys
from termloom.session import materialize, scratch_path

# Bytes of a bucket, as measured for a broadcast.
BUCKET_BYTES = 64 << 20


class BucketedDictionary:
    """A dictionary written once as a bucketed table, for many lookups by id.

    There are at least as many buckets as shuffle partitions, so that Spark deals the other side of a join to the
    buckets. The table is one of the session's catalogue, with its files in the scratch folder; ``drop`` takes it out.
    """

    def __init__(self, dictionary: Dictionary | DataFrame, ident: str, buckets: int = 0):
        dictionary = as_dictionary(dictionary)
        spark = dictionary.df.sparkSession
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.ident = ident
        self.rows, size = dictionary.size
        self.buckets = buckets or max(least, math.ceil(size / BUCKET_BYTES))
        self.name = f"termloom_{uuid.uuid4().hex}"
        dealt = dictionary.df.repartition(self.buckets, ident)  # the hash of the buckets: a file each
        writer = dealt.write.bucketBy(self.buckets, ident).sortBy(ident)
        writer.option("path", scratch_path(spark, "buckets")).saveAsTable(self.name)
        self.df = spark.table(self.name)

    def drop(self) -> None:
        self.df.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")

    def entries(self, ids: list[int]) -> DataFrame:
        """Entries of a few ids; only their buckets are opened."""
        return self.df.where(F.col(self.ident).isin(ids))

    def lookup(self, rows: DataFrame, how: str = "inner") -> DataFrame:
        """Join with the dictionary by id: ``inner`` adds its columns, ``left_semi`` / ``left_anti`` only test the id.

        ``rows`` is evaluated once and written down, and its heavy ids are seen on the way. Those are fewer than
        there are shuffle partitions; their entries are broadcast and their rows stay where they are. All other
        rows go to the buckets. Rows without an id match nothing and are not moved either.
        """
        ident = self.ident
        stored, heavy = stored_with_heavy_keys(rows, ident, "looked")
        side = self.df if how == "inner" else self.df.select(ident)
        heavy = materialize(heavy.select(ident), "heavy")
        found = materialize(side.join(F.broadcast(heavy), ident), "found")
        often = stored.join(F.broadcast(heavy), ident, "left_semi").join(F.broadcast(found), ident, how)
        seldom = stored.where(F.col(ident).isNotNull()).join(F.broadcast(heavy), ident, "left_anti")
        joined = often.unionByName(seldom.join(side, ident, how))
        if how == "left_anti":
            joined = joined.unionByName(stored.where(F.col(ident).isNull()))
        return joined


def bucketed(dictionary: Dictionary, ident: str) -> Dictionary | BucketedDictionary:
    """The dictionary itself where it may be broadcast, else in buckets."""
    return dictionary if dictionary.fits() else BucketedDictionary(dictionary, ident)

