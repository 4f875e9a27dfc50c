"""Token ids in files of directly addressable codes.

An id is cut into chunks of ``WIDTH`` bits. Level 0 has the lowest chunk of every id, and a bit per id that says
whether there is more; level 1 has the next chunk of those ids that have more, and so on. The place of an id on
the next level is the number of set bits in front of it, and a rank directory holds that number for every
``BLOCK`` bits; so any token, and any run of tokens, is read with a few small reads and without decoding a block.

File, all numbers little-endian: magic, then counts of documents, tokens and levels; document ids; token starts
(one more than documents); and per level its number of ids, the chunks, the bits, the directory. Documents stand
in ascending id order within a file and over the files, whose order is that of the table of files.

Defined results: a null text is empty and has the end id only. A null id comes first. Repeated ids follow each
other in the order in which they are read. An empty table gives an empty table of files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.bpe import ID_TYPE, vocabulary
from termloom.llm.common import column
from termloom.llm.files import new_file, open_file
from termloom.llm.workers import tidy
from termloom.session import materialize, scratch_path

MAGIC = b"TLDAC001"
WIDTH = 8
BLOCK = 512
END_ID = 0
# Tokens a task gathers for one file.
FILE_TOKENS = 1 << 23
# What stands for a null document id, which sorts first.
NO_ID = np.iinfo(np.int64).min

_HEAD = np.dtype([("docs", "<u8"), ("tokens", "<u8"), ("levels", "<u8")])


def pack_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bits, directory) of each level."""
    levels, left = [], ids.astype(np.uint32)
    while len(left):
        more = left >> WIDTH > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK // 8)))
        per_block = np.bitwise_count(bits.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint64)
        directory = np.concatenate([[0], np.cumsum(per_block)]).astype("<u8")
        levels.append(((left & (1 << WIDTH) - 1).astype(np.uint8), bits, directory))
        left = left[more] >> WIDTH
    return levels


def write_file(stream, docs: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> None:
    levels = pack_levels(ids)
    stream.write(MAGIC + np.array([(len(docs), len(ids), len(levels))], _HEAD).tobytes())
    stream.write(docs.astype("<i8").tobytes() + starts.astype("<u8").tobytes())
    for chunks, bits, directory in levels:
        stream.write(np.array([len(chunks)], "<u8").tobytes())
        for part in (chunks, bits, directory):
            stream.write(part.tobytes())


class TokenFile:
    """Random access to one file."""

    def __init__(self, stream):
        self.stream = stream
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        head = np.frombuffer(stream.read(_HEAD.itemsize), _HEAD)[0]
        self.n_docs, self.n_tokens = int(head["docs"]), int(head["tokens"])
        self.docs_at = len(MAGIC) + _HEAD.itemsize
        at = self.docs_at + 8 * self.n_docs + 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(int(head["levels"])):
            n = int(self._array(at, 1, "<u8")[0])
            blocks = -(-n // BLOCK)
            chunks = at + 8
            bits = chunks + n
            directory = bits + blocks * BLOCK // 8
            self.levels.append((chunks, bits, directory))
            at = directory + 8 * (blocks + 1)

    def _array(self, at: int, n: int, kind: str) -> np.ndarray:
        self.stream.seek(at)
        kind = np.dtype(kind)
        return np.frombuffer(self.stream.read(n * kind.itemsize), kind)

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Document ids, and where the tokens of each start, with the end of the last."""
        return self._array(self.docs_at, self.n_docs, "<i8"), self._array(
            self.docs_at + 8 * self.n_docs, self.n_docs + 1, "<u8"
        ).astype(np.int64)

    def _rank(self, level: int, at: int) -> int:
        """Set bits of a level in front of ``at``."""
        _, bits, directory = self.levels[level]
        block = at // BLOCK
        before = int(self._array(directory + 8 * block, 1, "<u8")[0])
        inside = self._array(bits + block * BLOCK // 8, -(-(at % BLOCK) // 8), "u1")
        return before + int(np.unpackbits(inside, bitorder="little")[: at % BLOCK].sum())

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Tokens ``start`` to ``end``, the last not included."""
        result = np.zeros(end - start, ID_TYPE)
        where = np.arange(end - start)
        for level, (chunks, bits, _) in enumerate(self.levels):
            n = len(where)
            if not n:
                break
            result[where] |= self._array(chunks + start, n, "u1").astype(np.uint32) << np.uint32(level * WIDTH)
            first = start // 8
            more = np.unpackbits(self._array(bits + first, -(-(start + n) // 8) - first, "u1"), bitorder="little")
            more = more[start - 8 * first :][:n].astype(bool)
            where = where[more]
            start = self._rank(level, start) if len(where) else 0
        return result


def write_tokens(docs: DataFrame, path: str, folder: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(uri, base, n_docs, n_tokens)`` of the files written below ``folder``; ``base`` counts the tokens of all
    files before.

    Texts are dealt by ranges of the id and sorted, and tokenized where they are written. Rows of one id may
    be dealt to several ranges, as their place in the input breaks ties.
    """
    wanted = docs.select(
        column(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(column(text), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    ranged = wanted.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")

    @tidy
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], ID_TYPE)
        docs_held: list[int] = []
        ids_held: list[np.ndarray] = []
        held = number = 0

        def close() -> pd.DataFrame:
            nonlocal held, number
            uri, stream = new_file(folder, ".tokens")
            starts = np.cumsum([0, *map(len, ids_held)])
            with stream:
                write_file(stream, np.array(docs_held, np.int64), starts, np.concatenate(ids_held))
            row = {"part": [part], "number": [number], "uri": [uri], "n_docs": [len(docs_held)], "n_tokens": [held]}
            docs_held.clear(), ids_held.clear()
            held, number = 0, number + 1
            return pd.DataFrame(row)

        for batch in batches:
            encode = vocabulary(path).encode
            for doc, body in zip(batch["doc_id"].astype("Int64").fillna(NO_ID), batch["text"]):
                ids = np.concatenate([encode(body), end])
                docs_held.append(doc), ids_held.append(ids)
                held += len(ids)
                if held >= FILE_TOKENS:
                    yield close()
        if held:
            yield close()

    schema = "part int, number int, uri string, n_docs bigint, n_tokens bigint"
    files = materialize(ranged.select("doc_id", "text").mapInPandas(write, schema), "files")
    # One row per file.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("uri", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"), "n_docs", "n_tokens")


def read_documents(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files, each read by its own task."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, base in zip(batch["uri"], batch["base"]):
                with open_file(uri) as stream:
                    file = TokenFile(stream)
                    docs, starts = file.documents()
                    sums = [zlib.crc32(file.tokens(a, b).tobytes()) for a, b in zip(starts[:-1], starts[1:])]
                ids = pd.Series(docs).astype("Int64").mask(docs == NO_ID)
                yield pd.DataFrame(
                    {"doc_id": ids, "start": base + starts[:-1], "n_tokens": np.diff(starts), "ids_crc32": sums}
                )

    kept = materialize(files, "bases")
    spread = kept.repartition(max(1, kept.count()))
    return spread.mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(docs: DataFrame) -> str:
    """A new folder in the shared scratch space."""
    return scratch_path(docs.sparkSession, "tokens")
