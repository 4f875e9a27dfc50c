"""Packing of documents into sequences of a fixed number of tokens, by minimum bin slack.

A packing only depends on how many pieces there are of each length, so the tasks that tokenize also count, and
what reaches the driver is one number per length: at most ``capacity`` of them, however large the corpus. Bins
are then filled one pattern at a time: the longest piece left is taken, a subset-sum over the other lengths, as
a bit set of reachable fillings, finds the fullest combination, and that combination is used as often as there
are pieces for it. A pattern ends with one of its lengths nearly used up, so the number of patterns
follows from the number of lengths and not from that of documents. Every piece finds its place by its rank
among the pieces of its length: counts per task, a running sum over tasks, and one join with the patterns.

Defined results: a null text is empty and has the end id only. Documents of more than ``capacity`` tokens are
cut, the first piece taking what is left over; others stay whole. Repeated rows and repeated ids are packed
each. An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.bpe import ID_TYPE, vocabulary
from termloom.llm.common import column
from termloom.llm.workers import tidy
from termloom.operators.lookup import Dictionary
from termloom.session import materialize

CAPACITY = 2048
END_ID = 0

Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it), longest first


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; all but the first are full."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def fullest(available: dict[int, int], room: int) -> Pattern:
    """The combination of available lengths, each as often as it is there, that fills ``room`` best.

    Bit n of ``reached`` says that n tokens can be filled. Long pieces are tried first and the search ends
    with a full bin, so short ones are left for the bins that need them.
    """
    reached, whole = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((n for n in available if n <= room), reverse=True):
        left, portion = min(available[length], room // length), 1
        while left:
            portion = min(portion, left)
            more = (reached | reached << (portion * length)) & whole
            if more != reached:
                steps.append((length, portion, reached))
                reached = more
            left -= portion
            portion *= 2
        if reached >> room:
            break
    filled, used = reached.bit_length() - 1, Counter()
    for length, portion, before in reversed(steps):
        if not before >> filled & 1:
            filled -= portion * length
            used[length] += portion
    return tuple(sorted(used.items(), reverse=True))


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how many bins each fills; together they use up ``counts`` (pieces per length)."""
    left = {length: n for length, n in counts.items() if n}
    plan: list[tuple[Pattern, int]] = []
    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        used = Counter(dict(fullest({n: c for n, c in others.items() if c}, capacity - longest)))
        used[longest] += 1
        times = min(left[length] // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        plan.append((tuple(sorted(used.items(), reverse=True)), times))
    return plan


def tokenized_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """A row per piece, with its checksum, its task and its place among the task's pieces of that length."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint, ids binary"
    )

    @tidy
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, int] = defaultdict(int)
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], ID_TYPE)
        for batch in batches:
            encode = vocabulary(path).encode
            rows = []
            for doc, body in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([encode(body), end])
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    own = ids[start : start + length].tobytes()
                    kept = own if with_ids else None
                    rows.append((doc, piece, start, length, zlib.crc32(own), part, seen[length], kept))
                    seen[length] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", "ids"]
            frame = pd.DataFrame(rows, columns=names)
            if batch["doc_id"].dtype.kind == "f":  # a null among whole numbers
                frame["doc_id"] = frame["doc_id"].astype("Int64") if kind == "bigint" else frame["doc_id"]
            yield frame

    wanted = docs.select(column(doc_id).alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))
    return wanted.mapInPandas(pieces, schema)


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, with ``ids`` if asked for."""
    spark = docs.sparkSession
    pieces = materialize(tokenized_pieces(docs, path, capacity, text, doc_id, with_ids), "pieces")
    per_task = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(
        per_task.select("part", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "before"
    )
    counts = {row["length"]: row["n"] for row in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, taken, bins = [], defaultdict(int), 0
    for pattern, times in minimum_bin_slack(counts, capacity):
        offset = 0
        for length, n in pattern:
            rows.append((length, taken[length], taken[length] + n * times, n, bins, offset))
            taken[length] += n * times
            offset += n * length
        bins += times
    names = "length bigint, first bigint, past bigint, per_bin bigint, bin bigint, at bigint"
    patterns = spark.createDataFrame(pd.DataFrame(rows, columns=[x.split()[0] for x in names.split(", ")]), names)
    ranks = Dictionary(before.select("part", "length", "before"))
    ranked = pieces.join(F.broadcast(ranks.df) if ranks.fits() else ranks.df, ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("place"))
    nth = F.col("rank") - F.col("first")
    in_bin = F.expr("(rank - first) div per_bin")
    found = ranked.join(
        F.broadcast(patterns), (ranked["length"] == patterns["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past"))
    )
    return found.select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("bin") + in_bin).alias("sequence_id"),
        (F.col("at") + (nth - in_bin * F.col("per_bin")) * ranked["length"]).alias("offset"),
        *(["ids"] if with_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` of pieces packed ``with_ids``; ids are little-endian 32-bit integers."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
