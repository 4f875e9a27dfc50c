"""Exact top-k by inner product, in three phases with a uniform threshold.

The components of all vectors are cut into ``PARTS`` runs; each run is a node that only knows partial scores.

1. Every node lists, for each query, the rows with its ``k`` highest partial scores. The rows listed by any node
   are scored in full; the k-th highest of these scores is a cutoff no result can be below.
2. A row that reaches the cutoff has at least cutoff / PARTS in some node. That threshold goes with the queries to
   every node, which returns all rows that reach it. What a row may still have in the nodes that did not return it
   is less than the threshold, so a row whose sum is too low even with that is ruled out.
3. What the rows left lack is resolved exactly, in the task that has their vectors, so only rows that reach the
   cutoff travel; each query's k best are kept.

Queries and rows meet in blocks: rows are dealt to chunks of about ``CHUNK`` by a hash of the id and queries to
blocks of about ``BLOCK``, and one task multiplies one chunk with one block. No task holds more than that, and
neither queries nor rows are collected or broadcast.

Defined results: vectors that are null or hold a null or a component that is not finite take no part. A query is
compared with rows of its own length only, and never with a row of its own id. Rows that repeat an id are one
row, the smallest vector standing for it. Ties go to the smaller id. Fewer than k candidates are all returned;
without any, a query has no result. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import column
from termloom.session import materialize

K = 5
SCALE = 256
PARTS = 2
CHUNK, BLOCK = 1 << 14, 1 << 13
# Rows of a chunk that are multiplied with a block at a time.
SLICE = 1 << 8
_EXACT = float(2**53)
# Stands for the score of a query with itself; its negative is a 64-bit number, too.
_NO_SCORE = -(2**63) + 1


def quantized(vectors: DataFrame, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """``(vec_id, q)``: one row per id, components as whole numbers ``floor(SCALE * x)``."""
    v = column(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    q = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.where(v.isNotNull() & column(ident).isNotNull() & finite)
    return rows.groupBy(column(ident).cast("bigint").alias("vec_id")).agg(F.min(q).alias("q"))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), dtype=np.int64).reshape(len(rows), -1)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole-number products; doubles where no sum can leave their exact range, else Python's integers."""
    most = np.abs(queries).max(initial=0).astype(float) * np.abs(rows).max(initial=0).astype(float)
    if most * max(1, queries.shape[1]) < _EXACT:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    exact = queries.astype(object) @ rows.astype(object).T
    return exact.astype(np.int64)  # raises where 64 bits are too few


def _parts(width: int) -> list[slice]:
    edges = np.linspace(0, width, PARTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _slices(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(rows), SLICE):
        part = rows.iloc[at : at + SLICE]
        yield part["vec_id"].to_numpy(), _matrix(part["q"])


def _lists(k: int):
    """Phase 1 in one task: the k best partial scores per query and part."""

    def best(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "part", "vec_id", "score"]
        if not len(queries) or not len(rows):
            return pd.DataFrame(columns=names)
        ids, x = queries["query_id"].to_numpy(), _matrix(queries["q"])
        parts = _parts(x.shape[1])
        none = np.zeros((len(ids), 0), np.int64)
        listed = [(none, none) for _ in parts]  # scores and row ids of each part, k of each query
        for row_ids, y in _slices(rows):
            for i, part in enumerate(parts):
                scores = _products(x[:, part], y[:, part])
                scores[ids[:, None] == row_ids[None, :]] = _NO_SCORE
                scores = np.hstack([listed[i][0], scores])
                places = np.hstack([listed[i][1], np.broadcast_to(row_ids, (len(ids), len(row_ids)))])
                top = np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]
                listed[i] = (np.take_along_axis(scores, top, axis=1), np.take_along_axis(places, top, axis=1))
        frames = [
            pd.DataFrame(
                {
                    "query_id": np.repeat(ids, scores.shape[1]),
                    "part": number,
                    "vec_id": places.ravel(),
                    "score": scores.ravel(),
                }
            )
            for number, (scores, places) in enumerate(listed)
        ]
        found = pd.concat(frames)
        return found[found["score"] != _NO_SCORE]

    return best


def _reaching(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Phases 2 and 3 in one task: rows that reach the threshold in some part, and of those the ones whose
    resolved score reaches the cutoff."""
    out = []
    if len(queries) and len(rows):
        ids, x = queries["query_id"].to_numpy(), _matrix(queries["q"])
        none = queries["cutoff"].isna().to_numpy()  # fewer than k candidates are known: all are needed
        least = np.where(none, 0, queries["cutoff"].fillna(0).to_numpy(np.int64))
        threshold = -(-least // PARTS)  # a whole number reaches cutoff / PARTS if it reaches this
        for row_ids, y in _slices(rows):
            parts = [_products(x[:, part], y[:, part]) for part in _parts(x.shape[1])]
            reached = [scores >= threshold[:, None] for scores in parts]
            known = sum(np.where(r, scores, 0) for r, scores in zip(reached, parts))
            missing = PARTS - sum(r.astype(np.int64) for r in reached)
            most = known + missing * (threshold[:, None] - 1)
            left = ((missing < PARTS) & (most >= least[:, None])) | none[:, None]
            q, r = np.nonzero(left & (ids[:, None] != row_ids[None, :]))
            score = sum(scores[q, r] for scores in parts)
            enough = (score >= least[q]) | none[q]
            out.append(pd.DataFrame({"query_id": ids[q], "vec_id": row_ids[r], "score": score})[enough])
    return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "vec_id", "score"])


def _number(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def _place(ident: str, n: int) -> Column:
    return F.pmod(F.xxhash64(ident), F.lit(n)).cast("int")


def _score(pairs: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """``pairs (query_id, vec_id)`` with their full score."""
    both = pairs.join(rows.select("vec_id", "q"), "vec_id").join(
        queries.select("query_id", F.col("q").alias("p")), "query_id"
    )
    products = F.zip_with("p", "q", lambda a, b: a.cast("decimal(38,0)") * b)
    # Sums are exact in whole numbers; those of usual vectors are far inside 64 bits.
    usual = F.aggregate(
        F.zip_with("p", "q", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda total, x: total + x
    )
    big = F.array_max(F.transform("p", F.abs)).cast("double") * F.array_max(F.transform("q", F.abs)).cast("double")
    exact = F.aggregate(products, F.lit(0).cast("decimal(38,0)"), lambda t, x: (t + x).cast("decimal(38,0)"))
    fits = F.coalesce(big * F.size("p") < float(2**62), F.lit(True))
    return both.select("query_id", "vec_id", F.when(fits, usual).otherwise(exact.cast("bigint")).alias("score"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the rows for whose id (``vec_id``) ``is_query`` holds."""
    rows = materialize(quantized(vectors, vector, ident).withColumn("width", F.size("q")), "vectors")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "q", "width")
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    chunks, blocks = _number(counts[0], CHUNK), _number(counts[1], BLOCK)
    all_chunks, all_blocks = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (chunks, blocks))
    dealt_rows = rows.withColumn("chunk", _place("vec_id", chunks)).withColumn("block", all_blocks)
    keys = ["width", "chunk", "block"]

    def meet(queries: DataFrame, function, schema: str) -> DataFrame:
        dealt = queries.withColumn("block", _place("query_id", blocks)).withColumn("chunk", all_chunks)
        return dealt.groupBy(*keys).cogroup(dealt_rows.groupBy(*keys)).applyInPandas(function, schema)

    lists = meet(queries, _lists(k), "query_id bigint, part int, vec_id bigint, score bigint")
    first = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
    listed = lists.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
    known = _best(_score(listed.select("query_id", "vec_id").distinct(), queries, rows), k)
    cutoffs = known.where(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))
    with_cutoff = materialize(queries.join(cutoffs, "query_id", "left"), "cutoffs")
    found = meet(with_cutoff, _reaching, "query_id bigint, vec_id bigint, score bigint")
    return _best(found, k).select("query_id", "rank", "vec_id", "score")

