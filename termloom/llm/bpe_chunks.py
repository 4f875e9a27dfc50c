"""Byte-level BPE of whole texts in overlapping chunks, and decoding.

A text of more than ``CHUNK`` characters becomes rows of ``CHUNK`` characters that reach ``OVERLAP`` characters
into the next one, so one long text is worked on by many tasks. Each task splits its chunk into pre-tokens from
the chunk's first character, which may stand inside a pre-token; it also splits the overlap the way the next
chunk's task will. The first place where both have a boundary is where the chunk hands over: a pre-token depends
only on what follows its start, so from there on both agree. Pieces in front of that place are the earlier
chunk's, the rest the next one's. A chunk is encoded up to where it hands over; stitching drops the tokens of the
pieces it has in front of its own start. Where an overlap has no common boundary (one pre-token that long), the
text is split and encoded whole. Decoding concatenates the bytes of the tokens.

Defined results: a null text is empty and has no tokens. Repeated rows are encoded each. An empty table gives an
empty result. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.bpe import ID_TYPE, Vocabulary, vocabulary
from termloom.llm.common import column
from termloom.llm.workers import tidy
from termloom.session import materialize

CHUNK = 1 << 15
OVERLAP = 512
# Characters the pattern may need to see of a pre-token that starts with an apostrophe.
AHEAD = 4

Finish = Callable[[np.ndarray, Vocabulary], tuple]


def ids_only(ids: np.ndarray, vocab: Vocabulary) -> tuple:
    """``(ids)``: little-endian unsigned 32-bit integers."""
    return (ids.tobytes(),)


def boundaries(vocab: Vocabulary, text: str, complete: bool) -> np.ndarray:
    """Starts of pre-tokens behind the first one, and the end of the last; without ``complete`` only those
    that more text behind ``text`` could not move."""
    ends = [(m.start(), m.end()) for m in vocab.pattern.finditer(text)]
    if not complete:
        ends = [(s, e) for s, e in ends if e < len(text) and s + AHEAD <= len(text)]
    return np.array([e for _, e in ends], np.int64)


def encode_chunk(vocab: Vocabulary, body: str, last: bool, chunk: int = CHUNK) -> dict:
    """One chunk: its ids up to where it hands over, and what stitching needs.

    ``starts`` and ``tokens`` are the places, and token counts, of the pieces that start in the overlap with the
    chunk before; ``hands_over`` is the place in the next chunk, or null if there is no common boundary.
    """
    own = boundaries(vocab, body, last)
    if last:
        end, hands_over = len(body), 0
    else:
        fresh = np.concatenate([[0], boundaries(vocab, body[chunk:], False)]) + chunk
        common = np.intersect1d(own[own >= chunk], fresh)
        if not len(common):
            return {"ids": b"", "starts": b"", "tokens": b"", "hands_over": None}
        end, hands_over = int(common[0]), int(common[0]) - chunk
    places = np.concatenate([[0], own[own < end]])
    head = places[places < OVERLAP]
    stop = int(places[len(head)]) if len(head) < len(places) else end
    parts = [vocab.encode(body[a:b]) for a, b in zip(head, [*head[1:], stop])]
    # White space looks at what follows it: the text is cut behind other characters only, the pieces from there on
    # are encoded one by one.
    bounds = [*places[len(head) :].tolist(), end]
    cut = len(bounds) - 1
    while cut > 0 and not last and body[bounds[cut] - 1].isspace():
        cut -= 1
    rest = [vocab.encode(body[a:b]) for a, b in zip(bounds[cut:], bounds[cut + 1 :])]
    ids = np.concatenate([*parts, vocab.encode(body[stop : max(stop, bounds[cut])]), *rest])
    counts = np.array([len(p) for p in parts], np.int64)
    return {"ids": ids.tobytes(), "starts": head.tobytes(), "tokens": counts.tobytes(), "hands_over": hands_over}


def stitch(chunks: list[dict]) -> np.ndarray:
    """Ids of a text from its chunks in order, each with a place where it hands over."""
    parts, start = [], 0
    for part in chunks:
        starts, tokens = np.frombuffer(part["starts"], np.int64), np.frombuffer(part["tokens"], np.int64)
        skipped = int(tokens[starts < start].sum())
        parts.append(np.frombuffer(part["ids"], ID_TYPE)[skipped:])
        start = part["hands_over"]
    return np.concatenate(parts)


def _whole(docs: DataFrame, path: str, fields: str, finish: Finish, kind: str) -> DataFrame:
    """Texts encoded as single chunks."""

    @tidy
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vocab = vocabulary(path)
            rows = [finish(vocab.encode(text), vocab) for text in batch["text"]]
            frame = pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return docs.select("doc_id", "text").mapInPandas(encode, f"doc_id {kind}, {fields}")


def encode_documents(
    docs: DataFrame,
    path: str,
    fields: str = "ids binary",
    finish: Finish = ids_only,
    text: str = "text",
    doc_id: str = "doc_id",
    chunk: int = CHUNK,
) -> DataFrame:
    """``(doc_id, *fields)`` of every row; ``finish`` makes the fields from ids, in the task that has them."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(column(doc_id).alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))
    short = _whole(rows.where(F.length("text") <= chunk), path, fields, finish, kind)
    long = rows.where(F.length("text") > chunk).withColumn("content", F.xxhash64("text"))
    # Numbered in front of the explode, which would otherwise number chunks.
    numbered = long.withColumn("row", F.monotonically_increasing_id())
    last = F.ceil((F.length("text") - chunk) / chunk).cast("int")
    chunks = numbered.select(
        "doc_id",
        "content",
        "row",
        last.alias("last"),
        F.posexplode(
            F.transform(F.sequence(F.lit(0), last), lambda i: F.substring("text", i * chunk + 1, F.lit(chunk + OVERLAP)))
        ).alias("chunk", "body"),
    )

    @tidy
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vocab = vocabulary(path)
            found = [
                encode_chunk(vocab, body, at == last, chunk)
                for body, at, last in zip(batch["body"], batch["chunk"], batch["last"])
            ]
            frame = pd.DataFrame(found, columns=["ids", "starts", "tokens", "hands_over"])
            frame["hands_over"] = frame["hands_over"].astype("Int64")
            yield pd.concat([batch[["doc_id", "content", "row", "chunk"]].reset_index(drop=True), frame], axis=1)

    schema = (
        f"doc_id {kind}, content bigint, row bigint, chunk int, ids binary, starts binary, tokens binary, hands_over bigint"
    )
    # Dealt by chunk, so that the chunks of one text go to many tasks.
    dealt = chunks.repartition("row", "chunk")
    encoded = materialize(dealt.mapInPandas(encode, schema), "chunks")
    names = [f.split()[0] for f in fields.split(", ")]

    def stitched(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        vocab = vocabulary(path)
        parts = group.sort_values("chunk").to_dict("records")
        frame = pd.DataFrame([finish(stitch(parts), vocab)], columns=names)
        frame.insert(0, "doc_id", group["doc_id"].iloc[:1].to_numpy())
        return frame

    def stitch_all(encoded: DataFrame) -> DataFrame:
        return short.union(encoded.groupBy("row").applyInPandas(stitched, f"doc_id {kind}, {fields}"))

    apart = encoded.where(F.col("hands_over").isNull())
    if apart.isEmpty():
        return stitch_all(encoded)
    apart = apart.select(F.col("doc_id").alias("d"), F.col("content").alias("c")).distinct()
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("c") == F.col("content"))
    whole = _whole(long.join(apart, same, "left_semi"), path, fields, finish, kind)
    return stitch_all(encoded.join(apart, same, "left_anti")).union(whole)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the raw bytes of its tokens; null ids are null."""

    @F.pandas_udf("binary")
    def raw(column: pd.Series) -> pd.Series:
        vocab = vocabulary(path)
        return pd.Series([None if x is None else vocab.decode(np.frombuffer(x, ID_TYPE)) for x in column])

    return encoded.withColumn(name, raw(column(ids)))
