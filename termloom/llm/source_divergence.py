"""How far the words of each source of a language lie from those of the others.

Each language keeps the terms that stand in ``min_docs`` of its documents. They are sorted by UTF-8 bytes and
numbered, and every run of ``SHARD_TERMS`` numbers becomes a minimal acyclic transducer (see :mod:`transducer`) that
knows its first number. The words of all texts are then streamed through the transducers of their language, equal ones of
a portion of ``PORTION`` bytes together, which gives the number of each kept term; counts per (language, source, number) are shuffled.

A group gives a term with ``count`` occurrences ``p = 1 + floor(SCALE * (count + ADDED) / (N + ADDED * V))``: whole
numbers, so nothing depends on the order of sums. Part ``pair`` sums ``|p - q|`` over all kept terms for every two sources
of a language; part ``term`` lists the terms a source has more of than its language. Sums over pairs are made in tiles of
``SOURCES`` by ``SOURCES`` sources and ``TERMS`` terms; terms that a source does not have have one known ``p`` there.

Transducers beyond the broadcast limit are sent in slices, one pass over the texts each; counts of passes add up.

Defined results: null text, language and source read as empty. A language without kept terms has pairs of value 0 and no
terms; so has a group without words, which gives all terms the same ``p``. Repeated rows count as often as they occur.
Equal values are ranked by the item's UTF-8 bytes, of terms by their numbers. An empty table gives an empty result. Columns
beside those named are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import column
from termloom.llm.transducer import Stepper, Transducer
from termloom.llm.workers import tidy
from termloom.operators.lookup import BROADCAST_LIMIT, Dictionary
from termloom.session import materialize
from termloom.sources.dictionary import dense_ids

MIN_DOCS = 30
TOP = 50
SCALE, ADDED = 1_000_000_000, 5
SHARD_TERMS = 1 << 12
SOURCES, TERMS = 128, 1 << 12
# Long texts are taken apart in pieces of so many bytes; a task gives out its counts at so many bytes of text.
PIECE, PORTION = 1 << 20, 1 << 24

# Bytes of UTF-8 text: A-Z in lower case, a-z and all beyond ASCII as they are, any other a blank.
_BYTES = bytes(ord(c.lower()) if (c := chr(b)).isascii() and c.isalpha() else b if b >= 0x80 else 0x20 for b in range(256))


def _pieces(text: str) -> Iterator[bytes]:
    """A text in lower case with blanks between its terms, piece by piece."""
    lowered = text.encode("utf-8", "replace").translate(_BYTES)
    at = 0
    while at < len(lowered):
        gap = lowered.find(b" ", at + PIECE)
        end = gap if gap >= 0 else len(lowered)
        yield lowered[at:end]
        at = end


def _terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in lower case, piece by piece."""
    for piece in _pieces(text):
        yield piece.split()


def _reduced(text: str) -> Iterator[bytes]:
    """A text as one piece; a long one with each of its terms once."""
    if 4 * len(text) <= PIECE:
        yield from _pieces(text)
    else:
        yield b" ".join(set().union(*_terms(text)))


@dataclass
class _Portion:
    """Terms of some texts: of each, the number of its piece, and of its word in ``words``, which has each word once."""

    keys: list[tuple]
    piece: np.ndarray
    word: np.ndarray
    words: pa.Array

    @classmethod
    def of(cls, keys: list[tuple], pieces: list[bytes]) -> _Portion:
        data = np.frombuffer(b" ".join(pieces) + b" ", np.uint8)
        blank = data == 0x20
        edges = np.flatnonzero(np.diff(blank, prepend=True))  # terms begin and end by turns
        start, end = edges[::2], edges[1::2]
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[~blank])]
        terms = pa.Array.from_buffers(pa.binary(), len(start), buffers).dictionary_encode()
        upto = np.searchsorted(start, np.cumsum([len(p) + 1 for p in pieces]))
        piece = np.repeat(np.arange(len(pieces)), np.diff(upto, prepend=0))
        return cls(keys, piece, terms.indices.to_numpy().astype(np.int64), terms.dictionary)

    def counts(self, distinct: bool) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Different keys; number of the key, of the word, and in how many terms, or pieces, the two occur."""
        number: dict[tuple, int] = {}
        of = np.array([number.setdefault(key, len(number)) for key in self.keys], np.int64)
        width = max(len(self.words), 1)
        piece, word = self.piece, self.word
        if distinct:
            pairs = np.sort(piece * width + word)
            piece, word = np.divmod(pairs[np.diff(pairs, prepend=-1) > 0], width)
        cells, n = np.unique(of[piece] * width + word, return_counts=True)
        return list(number), cells // width, cells % width, n


def _portions(batches: Iterator[pa.RecordBatch], pieces) -> Iterator[_Portion]:
    """Rows ``(*key, text)``, their texts taken apart by ``pieces``."""
    keys, held, size = [], [], 0
    for batch in batches:
        for *key, text in zip(*(column.to_pylist() for column in batch.columns)):
            for piece in pieces(text):
                keys.append(tuple(key))
                held.append(piece)
                size += len(piece) + 1
                if size >= PORTION:
                    yield _Portion.of(keys, held)
                    keys, held, size = [], [], 0
    if held:
        yield _Portion.of(keys, held)


def _read(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    names = {"text": text, "lang": lang, "source": source}
    return docs.select(*[F.coalesce(column(c), F.lit("")).alias(n) for n, c in names.items()])


# --- vocabulary -------------------------------------------------------------------------------------------


def kept_terms(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(ordinal, lang, term)``: terms in ``min_docs`` documents of a language, numbered by language and bytes."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in _portions(batches, _reduced):
            langs, lang, word, n = portion.counts(distinct=True)
            columns = [pa.array([k for (k,) in langs], pa.string()).take(pa.array(lang))]
            columns += [portion.words.take(pa.array(word)).cast(pa.string()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "n"])

    counts = texts.select("lang", "text").mapInArrow(count, "lang string, term string, n bigint")
    often = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
    # Terms hold no code point 0, so the key orders by language first.
    keyed = often.select(F.concat("lang", F.lit("\0"), "term").alias("key"), "lang", "term")
    return materialize(dense_ids(keyed, "key", "ordinal").drop("key"), "terms")


@dataclass
class Vocabulary:
    """``terms (ordinal, lang, term)`` and a transducer per shard, ``shards (lang, shard, base, size, transducer)``."""

    terms: DataFrame
    shards: DataFrame

    @classmethod
    def of(cls, terms: DataFrame) -> Vocabulary:
        firsts = Dictionary(materialize(terms.groupBy("lang").agg(F.min("ordinal").alias("first")), "firsts"))
        placed = terms.join(F.broadcast(firsts.df) if firsts.fits() else firsts.df, "lang")
        shard = F.floor((F.col("ordinal") - F.col("first")) / SHARD_TERMS).cast("int")

        def build(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("ordinal")
            made = Transducer.of(t.encode() for t in rows["term"])
            # Bytes it takes while texts are streamed through it.
            size = 64 * len(made.final) + 16 * len(made.label)
            ends = rows["lang"].iloc[0], rows["shard"].iloc[0], rows["ordinal"].iloc[0]
            return pd.DataFrame([(*ends, size, made.to_bytes())], columns=["lang", "shard", "base", "size", "transducer"])

        grouped = placed.select("lang", shard.alias("shard"), "ordinal", "term").groupBy("lang", "shard")
        schema = "lang string, shard int, base bigint, size bigint, transducer binary"
        return cls(terms, materialize(grouped.applyInPandas(build, schema), "transducers"))

    def _slices(self, limit: int) -> Iterator[list[tuple[str, int, bytes]]]:
        """Transducers, as many at a time as the limit allows, one at least."""
        listed = self.shards.select("base", "size").orderBy("base").collect()  # one row per SHARD_TERMS terms
        slices, used = [], 0
        for row in listed:
            if not slices or used + row["size"] > limit:
                slices.append([row["base"], row["base"]])
                used = 0
            slices[-1][1] = row["base"]
            used += row["size"]
        for first, last in slices:
            rows = self.shards.where(F.col("base").between(first, last)).orderBy("base").collect()
            yield [(r["lang"], r["base"], bytes(r["transducer"])) for r in rows]

    def count(self, texts: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
        """``(lang, source, ordinal, n)``: occurrences of kept terms in ``texts (lang, source, text)``."""
        context, schema = texts.sparkSession.sparkContext, "lang string, source string, ordinal bigint, n bigint"
        counted = None
        for some in self._slices(limit):
            part = texts.select("lang", "source", "text").mapInArrow(_counter(context.broadcast(some)), schema)
            counted = part if counted is None else counted.union(part)
        if counted is None:
            counted = texts.sparkSession.createDataFrame([], schema)
        return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _counter(shared):
    """A task function that counts numbers of terms per language and source.

    Equal terms of a portion of the texts go through the transducers together, as one with their number.
    """

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = shared.value
        stepper = Stepper([Transducer.from_bytes(t) for *_, t in sent])
        own: dict[str, list[tuple[int, int, bytes]]] = defaultdict(list)
        for (lang, base, stored), root in zip(sent, stepper.roots):
            own[lang].append((base, root, Transducer.from_bytes(stored).word(0)))
        for portion in _portions(batches, _pieces):
            keys, key, word, n = portion.counts(distinct=False)
            langs, sources = zip(*keys)
            ordinal = np.full(len(n), -1, np.int64)
            for name in own.keys() & set(langs):
                rows = np.flatnonzero(np.array([lang == name for lang in langs])[key])
                used, place = np.unique(word[rows], return_inverse=True)
                ordinal[rows] = _ordinals(stepper, own[name], portion.words.take(pa.array(used)))[place]
            known = np.flatnonzero(ordinal >= 0)
            of = pa.array(key[known])
            columns = [pa.array(names, pa.string()).take(of) for names in (langs, sources)]
            columns += [pa.array(ordinal[known]), pa.array(n[known])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "ordinal", "n"])

    return count


def _ordinals(stepper: Stepper, shards: list[tuple[int, int, bytes]], words: pa.Array) -> np.ndarray:
    """Numbers of words, -1 of those not known to one of the shards ``(first number, root, first word)``, in order."""
    found = np.full(len(words), -1, np.int64)
    if not len(words):
        return found
    order = pc.array_sort_indices(words).to_numpy()
    ordered = words.take(pa.array(order))
    offsets = np.frombuffer(ordered.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
    data = np.frombuffer(ordered.buffers()[2], np.uint8)
    start, length = offsets[:-1], np.diff(offsets)
    bounds = [bisect_left(range(len(words)), first, key=lambda i: ordered[i].as_py()) for *_, first in shards] + [len(words)]
    for (base, root, _), low, high in zip(shards, bounds, bounds[1:]):
        ranks = stepper.ranks(data, start[low:high], length[low:high], np.full(high - low, root))
        found[order[low:high]] = np.where(ranks >= 0, base + ranks, -1)
    return found


# --- shares and distances ---------------------------------------------------------------------------------


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + ADDED) / (total + ADDED * kept))`` in whole numbers."""
    exact = (n + ADDED).cast("decimal(38,0)") * F.lit(SCALE)
    return 1 + F.call_function("div", exact, (total + ADDED * kept).cast("decimal(38,0)"))


def _numbered_groups(texts: DataFrame, cells: DataFrame, terms: DataFrame) -> DataFrame:
    """``(lang, source, total, kept, first, no, n_sources, none)``: ``none`` is the share of a term that does not occur."""
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.min("ordinal").alias("first"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    zero = F.lit(0).cast("bigint")
    filled = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "first")])
    each = Window.partitionBy("lang")
    return filled.select(
        "*",
        (F.row_number().over(each.orderBy("source")) - 1).alias("no"),
        F.count(F.lit(1)).over(each).cast("int").alias("n_sources"),
        F.when(F.col("kept") > 0, share(zero, F.col("total"), F.col("kept"))).otherwise(zero).alias("none"),
    )


def _tile_sums(sources: int):
    """Distances within a tile; rows with place -1 give each source's share of absent terms and the tile's width."""

    def sums(rows: pd.DataFrame) -> pd.DataFrame:
        base = rows[rows["place"] < 0].sort_values("no")
        cells = rows[rows["place"] >= 0]
        no = base["no"].to_numpy()
        width = int(base["width"].iloc[0])
        shares = np.repeat(base["p"].to_numpy()[:, None], width, axis=1)
        shares[np.searchsorted(no, cells["no"].to_numpy()), cells["place"].to_numpy()] = cells["p"].to_numpy()
        low, high = base["low"].iloc[0], base["high"].iloc[0]
        found = [pd.DataFrame({"lang": pd.Series([], dtype=object), "a": [], "b": [], "value": []})]
        for i in np.flatnonzero(no // sources == low):
            others = np.flatnonzero((no // sources == high) & (no > no[i]))
            far = np.abs(shares[others] - shares[i]).sum(axis=1)
            found.append(pd.DataFrame({"lang": base["lang"].iloc[0], "a": no[i], "b": no[others], "value": far}))
        return pd.concat(found[1:] or found)

    return sums


def pair_distances(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` for every two sources of a language, by their numbers, ``a < b``."""
    block = F.floor(F.col("no") / SOURCES).cast("int")
    blocks = F.ceil(F.col("n_sources") / SOURCES).cast("int")
    widths = F.least(F.lit(TERMS), F.col("kept") - F.col("chunk") * TERMS).cast("int")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS)).cast("int")
    base = groups.select("*", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
    base = base.select("lang", "chunk", "no", F.lit(-1).alias("place"), F.col("none").alias("p"), widths.alias("width"), "n_sources")
    place = F.col("ordinal") - F.col("first")
    filled = cells.select(
        "lang",
        F.floor(place / TERMS).cast("int").alias("chunk"),
        "no",
        (place % TERMS).cast("int").alias("place"),
        "p",
        F.lit(0).alias("width"),
        "n_sources",
    )
    with_ = F.explode(F.sequence(F.lit(0), blocks - 1))
    tiled = base.union(filled).select("lang", "chunk", "no", "place", "p", "width", block.alias("block"), with_.alias("with"))
    tiles = tiled.select(
        "lang", "chunk", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "no", "place", "p", "width"
    )
    sums = tiles.groupBy("lang", "chunk", "low", "high").applyInPandas(_tile_sums(SOURCES), "lang string, a int, b int, value bigint")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _small(df: DataFrame, label: str) -> DataFrame:
    """A stored table, broadcast where its measured size allows."""
    table = Dictionary(materialize(df, label))
    return F.broadcast(table.df) if table.fits() else table.df


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: distances to other sources, and the ``top`` terms over-used."""
    texts = _read(docs, text, lang, source)
    terms = kept_terms(texts, min_docs)
    counts = materialize(Vocabulary.of(terms).count(texts, limit), "counts")
    groups = _small(_numbered_groups(texts, counts, terms), "groups")
    # A group has a row per kept term at most; a term, one per source.
    own = share(F.col("n"), F.col("total"), F.col("kept"))
    cells = materialize(counts.join(groups, ["lang", "source"]).withColumn("p", own), "cells")

    names = groups.select("lang", "no", "source")
    pairs = pair_distances(cells, groups)
    both = pairs.select("lang", "a", "b", "value").union(pairs.select("lang", F.col("b"), F.col("a"), "value"))
    named = both.join(names.withColumnRenamed("no", "a"), ["lang", "a"]).join(
        names.select("lang", F.col("no").alias("b"), F.col("source").alias("item")), ["lang", "b"]
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_part = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))

    whole = cells.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    lang_totals = _small(cells.groupBy("lang").agg(F.sum("n").alias("lang_total")), "totals")
    over = cells.join(whole, ["lang", "ordinal"]).join(lang_totals, "lang")
    more = over.withColumn("value", F.col("p") - share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))).where("value > 0")
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    ranked = more.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    listed = ranked.join(terms.select("ordinal", F.col("term").alias("item")), "ordinal")
    return pair_part.union(listed.select("lang", "source", F.lit("term"), "item", "value", "rank"))
