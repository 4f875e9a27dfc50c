"""Filters of keys: bitmaps that say which keys are surely not in a set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.session import materialize

# Bytes a filter may take, and bits per key below that.
FILTER_BYTES = 32 << 20
KEY_BITS = 12
# Places of a key, each found by a hash of its own.
HASHES = 2
# Fixed value: bits of one of Spark's bitmaps.
BITMAP_BITS = 32768


def _place(key: str, hash_: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(hash_), F.col(key)), F.lit(bits)) + 1


@dataclass
class KeyFilter:
    """``bitmaps (bucket, bits)`` of 4 KiB each. Every task sets bits of its own; the bitmaps of tasks merge by OR.

    A set of n keys in m bits lets a key that is not in it pass with a chance of (1 - exp(-2 n / m)) squared: 2 % at
    ``KEY_BITS``, more where ``FILTER_BYTES`` cuts m. A key that is in the set always passes; null never does.
    """

    bitmaps: DataFrame
    size: int

    @classmethod
    def of(cls, keys: DataFrame, key: str, n: int, max_bytes: int = FILTER_BYTES) -> KeyFilter:
        """The filter of ``n`` keys or so."""
        wanted = min(max_bytes * 8, max(1, n) * KEY_BITS)
        size = -(-wanted // BITMAP_BITS) * BITMAP_BITS
        places = keys.where(F.col(key).isNotNull()).select(
            F.explode(F.array(*[_place(key, h, size) for h in range(HASHES)])).alias("place")
        )
        bitmaps = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
        )
        return cls(materialize(bitmaps, "filter"), size)

    def passing(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows whose key may be in the set, by joins with the broadcast bitmaps."""
        left = rows.where(F.col(key).isNotNull())
        for h in range(HASHES):
            place = _place(key, h, self.size)
            side = self.bitmaps.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))
            bit = F.bitmap_bit_position(place)
            byte = F.conv(F.hex(F.substring("__bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            is_set = F.call_function("getbit", byte, (bit % 8).cast("int")) == 1
            met = left.join(F.broadcast(side), F.bitmap_bucket_number(place) == F.col("__bucket"))
            left = met.where(is_set).drop("__bucket", "__bits")
        return left
