"""Line deduplication that can be undone: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without white space at both ends, A-Z in lower case. The index keeps, for every key, the
number of documents that hold it: an exact table, kept by 128-bit digest of the key. Keys in ``min_docs`` documents
or more stand in cuckoo filters as well, one per shard of the digests, at some two bytes a key. Documents are added
and removed: counts go up or down, and only keys that cross the limit are put into, or taken out of, the filters
of their shards. A filter that is full is made again from the exact table. So an index after removing documents
cleans as one that never held them.

Texts are read where they lie and meet the filters there; nothing of them is shuffled or written down. A filter also
says yes to about one in 8,000 keys that it does not hold. All keys of indexed documents are in the table, so those
that it is wrong about are found there beforehand and sent along: what is dropped is exact. Filters beyond the
broadcast limit are sent in slices of whole shards, one pass over the texts each.

Defined results: a null or empty text is one empty line. Each row is a document, whether or not its id is null or
repeated, so equal rows count once each. Keys of fewer code points than ``min_chars`` are never dropped; an
empty key never is. A carriage return in front of a line end belongs to its line and stays with it. An empty table gives
an empty index and result; columns keep their names, new ones give way. Documents have to be in the index to be cleaned
or removed; removing what was never added is an error where a count falls below zero.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import column, free_name, numbered
from termloom.llm.workers import tidy
from termloom.operators.lookup import BROADCAST_LIMIT, Dictionary
from termloom.session import materialize

MIN_DOCS = 10
MIN_CHARS = 1
DIGEST = 16
_NO_KEY = bytes(DIGEST)
# Keys a shard is meant for, fingerprints in a bucket, and the share of them in use in a new filter.
SHARD_KEYS = 1 << 16
SLOTS = 4
LOAD = 0.85
# Fingerprints moved to make room for one before a filter counts as full.
KICKS = 500

_REFS = "key binary, n bigint"
_FILTERS = "shard int, full boolean, slots binary"


def line_digests(text: str, min_chars: int = MIN_CHARS) -> list[bytes]:
    """The digest of each line's key, zeros where the key is too short."""
    found = []
    for line in text.encode("utf-8", "replace").split(b"\n"):
        key = line.strip().lower()  # bytes: ASCII white space and letters only
        short = not key or (min_chars > 1 and len(key.decode()) < min_chars)
        found.append(_NO_KEY if short else blake2b(key, digest_size=DIGEST).digest())
    return found


# --- cuckoo filters ---------------------------------------------------------------------------------------


def _other(fingerprint):
    """Distance, as bits that differ, between the two buckets of a fingerprint."""
    return fingerprint * 0x5BD1E995


class CuckooFilter:
    """16-bit fingerprints in buckets of ``SLOTS``; a key may lie in two buckets. 0 marks a free slot."""

    def __init__(self, slots: list[int]):
        self.slots = slots
        self.mask = len(slots) // SLOTS - 1

    @classmethod
    def of(cls, keys: list[int]) -> CuckooFilter:
        """A filter that holds ``keys`` (64-bit numbers), as small as they allow."""
        buckets = 1 << max(0, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * LOAD)))))
        while True:
            new = cls([0] * (buckets * SLOTS))
            if all(map(new.add, keys)):
                return new
            buckets *= 2

    @classmethod
    def from_bytes(cls, stored: bytes) -> CuckooFilter:
        return cls(np.frombuffer(stored, "<u2").tolist())

    def to_bytes(self) -> bytes:
        return np.array(self.slots, "<u2").tobytes()

    def _place(self, key: int) -> tuple[int, int]:
        return (key >> 48) or 1, key & self.mask

    def _swap(self, bucket: int, old: int, new: int) -> bool:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if self.slots[slot] == old:
                self.slots[slot] = new
                return True
        return False

    def add(self, key: int) -> bool:
        """False if there is no room; the filter is not to be used any more then."""
        fingerprint, bucket = self._place(key)
        away = bucket ^ (_other(fingerprint) & self.mask)
        if self._swap(bucket, 0, fingerprint) or self._swap(away, 0, fingerprint):
            return True
        for kick in range(KICKS):
            slot = away * SLOTS + (kick + fingerprint) % SLOTS
            fingerprint, self.slots[slot] = self.slots[slot], fingerprint
            away ^= _other(fingerprint) & self.mask
            if self._swap(away, 0, fingerprint):
                return True
        return False

    def remove(self, key: int) -> None:
        """Take out a key that was added."""
        fingerprint, bucket = self._place(key)
        if not (self._swap(bucket, fingerprint, 0) or self._swap(bucket ^ (_other(fingerprint) & self.mask), fingerprint, 0)):
            raise ValueError("key is not in the filter")


class FilterSet:
    """Filters of some shards, asked for many keys at a time."""

    def __init__(self, bits: int, stored: dict[int, bytes]):
        self.bits = bits
        tables = [np.frombuffer(t, "<u2").reshape(-1, SLOTS) for t in stored.values()]
        self.table = np.concatenate([np.zeros((1, SLOTS), "<u2"), *tables])
        sizes = np.array([len(t) for t in tables], np.int64)
        # Shards without a filter here have one empty bucket, the first.
        self.start, self.mask = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.uint64)
        shards = np.array(list(stored), np.int64)
        self.start[shards] = np.cumsum(sizes) - sizes + 1
        self.mask[shards] = sizes - 1

    def holds(self, digests: list[bytes]) -> np.ndarray:
        """Per digest, whether its filter holds it, or seems to."""
        words = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)
        shard = (words[:, 0] >> np.uint64(1)) >> np.uint64(63 - self.bits)
        key, mask = words[:, 1], self.mask[shard]
        fingerprint = np.maximum(key >> np.uint64(48), np.uint64(1))
        bucket = key & mask
        away = bucket ^ (_other(fingerprint) & mask)
        start, wanted = self.start[shard], fingerprint.astype("<u2")[:, None]
        near = self.table[start + bucket.astype(np.int64)] == wanted
        far = self.table[start + away.astype(np.int64)] == wanted
        return near.any(axis=1) | far.any(axis=1)


def _numbers(keys: pd.Series) -> list[int]:
    """The half of each digest that filters are made of; the other half chooses the shard."""
    return [int.from_bytes(k[8:], "big") for k in keys]


def _shard(bits: int):
    """Shard of a ``key`` column: its first bits."""
    first = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("bigint")
    return F.shiftright(first, 32 - bits).cast("int")


def _filled(shard: int, made: CuckooFilter | None) -> pd.DataFrame:
    slots = None if made is None else made.to_bytes()
    return pd.DataFrame({"shard": [shard], "full": [made is None], "slots": [slots]})


def _make(rows: pd.DataFrame) -> pd.DataFrame:
    return _filled(rows["shard"].iloc[0], CuckooFilter.of(_numbers(rows["key"])))


def _update(stored: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after some keys have come (``up``) and some have gone."""
    if moved.empty:
        return stored
    shard, come = moved["shard"].iloc[0], moved["up"].to_numpy(bool)
    if stored.empty:
        return _filled(shard, CuckooFilter.of(_numbers(moved["key"][come])))
    changed = CuckooFilter.from_bytes(stored["slots"].iloc[0])
    for key in _numbers(moved["key"][~come]):
        changed.remove(key)
    room = all(map(changed.add, _numbers(moved["key"][come])))
    return _filled(shard, changed if room else None)


# --- the index --------------------------------------------------------------------------------------------


@dataclass
class LineIndex:
    """Exact counts ``refs (key, n)`` and the filters over keys in ``min_docs`` documents; see :func:`build`.

    An index is not changed: ``added`` and ``removed`` give a new one, and both stay usable. Tables are written below
    the scratch folder.
    """

    refs: DataFrame
    filters: DataFrame
    bits: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS
    limit: int = BROADCAST_LIMIT

    @classmethod
    def empty(cls, spark: SparkSession, **options) -> LineIndex:
        return cls(spark.createDataFrame([], _REFS), spark.createDataFrame([], _FILTERS), 0, **options)

    def added(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """The index with the rows of ``docs`` as further documents."""
        return self._moved(docs, text, 1)

    def removed(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """The index without the rows of ``docs``, which were added before."""
        return self._moved(docs, text, -1)

    def _moved(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        change = _line_counts(docs, text, self.min_chars).select("key", F.lit(0).cast("bigint"), F.col("n") * sign)
        both = self.refs.select("key", F.col("n").alias("was"), "n").union(change)
        now = both.groupBy("key").agg(F.sum("was").alias("was"), F.sum("n").alias("n"))
        below = F.raise_error(F.lit("a document was removed that the index does not hold")).cast("bigint")
        now = materialize(now.select("key", "was", F.when(F.col("n") >= 0, F.col("n")).otherwise(below).alias("n")), "refs")
        refs = now.where(F.col("n") > 0).select("key", "n")
        frequent, before = F.col("n") >= self.min_docs, F.col("was") >= self.min_docs
        n_frequent = now.where(frequent).count()
        bits = min(24, max(0, int(np.ceil(np.log2(max(1, n_frequent) / SHARD_KEYS)))))
        new = LineIndex(refs, self.filters, bits, self.min_docs, self.min_chars, self.limit)
        if bits != self.bits:
            new.filters = materialize(new._made(new.frequent), "filters")
            return new
        moved = now.where(frequent != before).select("key", frequent.alias("up"), _shard(bits).alias("shard"))
        grouped = self.filters.groupBy("shard").cogroup(moved.groupBy("shard"))
        updated = materialize(grouped.applyInPandas(_update, _FILTERS), "filters")
        full = updated.where("full").select("shard")
        again = new._made(new.frequent.withColumn("shard", _shard(bits)).join(full, "shard").select("key"))
        new.filters = materialize(updated.where(~F.col("full")).union(again), "filters")
        return new

    @property
    def frequent(self) -> DataFrame:
        """``(key)``: digests of the keys whose lines are dropped."""
        return self.refs.where(F.col("n") >= self.min_docs).select("key")

    def _made(self, keys: DataFrame) -> DataFrame:
        # A shard holds SHARD_KEYS keys or little more: digests spread evenly.
        return keys.withColumn("shard", _shard(self.bits)).groupBy("shard").applyInPandas(_make, _FILTERS)

    # Filters travel in slices of whole shards; a slice and the keys it is wrong about stay within the limit.

    def _sent(self, first: int, last: int) -> dict[int, bytes]:
        rows = self.filters.where(F.col("shard").between(first, last)).select("shard", "slots").collect()
        return {r["shard"]: bytes(r["slots"]) for r in rows}

    def _slices(self, sizes: dict[int, int]) -> list[tuple[int, int]]:
        """First and last shard of each slice; ``sizes`` has the bytes of each shard."""
        slices, used = [], 0
        for shard, size in sorted(sizes.items()):
            if not slices or used + size > self.limit:
                slices.append([shard, shard])
                used = 0
            slices[-1][1] = shard
            used += size
        return [tuple(s) for s in slices] or [(0, 0)]

    def _strays(self, sizes: dict[int, int]) -> DataFrame:
        """``(shard, key)``: keys in fewer documents that a filter seems to hold."""
        context, bits = self.refs.sparkSession.sparkContext, self.bits
        rare = self.refs.where(F.col("n") < self.min_docs).select(_shard(bits).alias("shard"), "key")

        def wrong(shared):
            def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                filters = None
                for batch in batches:
                    filters = filters or FilterSet(bits, shared.value)
                    yield batch[filters.holds(list(map(bytes, batch["key"])))] if len(batch) else batch

            return tidy(find)

        found = []
        for first, last in self._slices(sizes):
            part = rare.where(F.col("shard").between(first, last))
            shared = context.broadcast(self._sent(first, last))
            found.append(materialize(part.mapInPandas(wrong(shared), "shard int, key binary"), "strays"))
            shared.unpersist()
        table = found[0]
        for each in found[1:]:
            table = table.union(each)
        return table

    def clean(self, docs: DataFrame, text: str = "text", name: str = "lines") -> DataFrame:
        """``docs`` with a struct column more: ``n_lines``, ``n_dropped`` and ``kept``, the text without the lines
        that stand in many documents. ``docs`` are in the index."""
        sizes = {r["shard"]: r["size"] for r in self.filters.select("shard", F.length("slots").alias("size")).collect()}
        strays = self._strays(sizes)
        listed = {r["shard"]: r["n"] for r in strays.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        # A digest in a set takes some 100 bytes.
        slices = self._slices({s: size + 100 * listed.get(s, 0) for s, size in sizes.items()})
        senders = [self._tester(first, last, strays) for first, last in slices]
        new = free_name(docs, name)
        whole = F.coalesce(column(text), F.lit(""))
        if len(senders) == 1:
            return docs.withColumn(new, _cut_where(senders[0], self.min_chars)(whole))
        row, gone = free_name(docs, "row"), free_name(docs, "gone")
        rows = numbered(docs, row)
        places = None
        for sender in senders:
            found = rows.select(column(row).alias("row"), F.explode(_places_where(sender, self.min_chars)(whole)).alias("at"))
            found = materialize(found, "places")
            places = found if places is None else places.union(found)
        cuts = Dictionary(materialize(places.groupBy("row").agg(F.collect_list("at").alias(gone)), "cuts"), self.limit)
        side = cuts.df.withColumnRenamed("row", row)
        joined = rows.join(F.broadcast(side) if cuts.fits() else side, row, "left")
        cut = _cut_at()(whole, F.coalesce(column(gone), F.array().cast("array<int>")))
        return joined.select(*map(column, docs.columns), cut.alias(new))

    def _tester(self, first: int, last: int, strays: DataFrame):
        """A broadcast value: bits, filters, and the digests they are wrong about."""
        wrong = strays.where(F.col("shard").between(first, last)).select("key").collect()
        sent = (self.bits, self._sent(first, last), {bytes(r["key"]) for r in wrong})
        return self.refs.sparkSession.sparkContext.broadcast(sent)


def build(docs: DataFrame, text: str = "text", **options) -> LineIndex:
    """The index of all rows of ``docs``."""
    return LineIndex.empty(docs.sparkSession, **options).added(docs, text)


def _line_counts(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """``(key, n)``: documents that hold a key, summed per batch of documents."""

    @tidy
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[bytes] = Counter()
            for each in batch["text"]:
                found.update(set(line_digests(each, min_chars)))
            found.pop(_NO_KEY, None)
            yield pd.DataFrame({"key": pd.Series(list(found), dtype=object), "n": pd.Series(list(found.values()), dtype="int64")})

    texts = docs.select(F.coalesce(column(text), F.lit("")).alias("text"))
    return texts.mapInPandas(count, _REFS)


def _drops(texts: list[str], filters: FilterSet, strays: set[bytes], min_chars: int) -> list[np.ndarray]:
    """Per text, whether each line goes."""
    digests = [line_digests(t, min_chars) for t in texts]
    flat = [d for each in digests for d in each]
    gone = filters.holds(flat)
    for at in np.flatnonzero(gone):
        gone[at] = flat[at] not in strays and flat[at] != _NO_KEY
    return np.split(gone, np.cumsum([len(d) for d in digests])[:-1])


_CUT = "n_lines bigint, n_dropped bigint, kept string"


def _cut(texts: list[str], drops: list[np.ndarray]) -> pd.DataFrame:
    kept = [
        "\n".join(line for line, gone in zip(t.split("\n"), drop) if not gone) if drop.any() else t
        for t, drop in zip(texts, drops, strict=True)
    ]
    counts = {"n_lines": [len(d) for d in drops], "n_dropped": [int(d.sum()) for d in drops]}
    return pd.DataFrame({**counts, "kept": pd.Series(kept, dtype=object)})


def _cut_where(shared, min_chars: int):
    @tidy
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bits, stored, strays = shared.value
        filters = FilterSet(bits, stored)
        for batch in batches:
            texts = batch.tolist()
            yield _cut(texts, _drops(texts, filters, strays, min_chars) if texts else [])

    @F.pandas_udf(_CUT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from cut(batches)

    return of


def _places_where(shared, min_chars: int):
    @tidy
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits, stored, strays = shared.value
        filters = FilterSet(bits, stored)
        for batch in batches:
            drops = _drops(batch.tolist(), filters, strays, min_chars) if len(batch) else []
            yield pd.Series([np.flatnonzero(d).astype(np.int32) for d in drops], dtype=object)

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from find(batches)

    return of


def _cut_at():
    @F.pandas_udf(_CUT)
    def of(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        drops = [np.zeros(t.count("\n") + 1, bool) for t in texts]
        for drop, at in zip(drops, places):
            drop[np.asarray(at, np.int64)] = True
        return _cut(texts.tolist(), drops)

    return of


def drop_common_lines(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` cleaned by an index of themselves; see :meth:`LineIndex.clean`."""
    return build(docs, text, **options).clean(docs, text)
