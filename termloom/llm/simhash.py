"""Near-duplicate groups by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints within ``RADIUS`` differing bits are linked. With the 64 bits cut into ``RADIUS + 2`` blocks, two
linked fingerprints agree in two blocks at least, so every fingerprint is dealt once for each pair of blocks, by
the bits of that pair: the top nodes of the index. Spark sorts each node's fingerprints by Gray rank; a task reads
them as a stream, factors the bits that neighbours share into nodes of ``FAN`` children and compares
nodes with nodes from the top: differences in shared bits add up on the way down, and a pair of nodes with more
than ``RADIUS`` of them is dropped whole. So is a pair that lies in one component already. What leaves a task is
one edge per fingerprint to a representative, never a list of pairs.

A top node with more than ``RUN`` fingerprints is cut into runs. Each run is linked within itself where it is
read, and pairs of runs that can still hold a link become tasks of their own. Equal fingerprints are one before
any of this, so exact copies weigh nothing. Components of the edges come from alternating star steps.

Defined results: a text without words, null included, has fingerprint zero and is linked like any other.
Repeated rows, and rows that repeat an id, are rows of their own with equal or different fingerprints; a null id
gets a component like any other row but names none, unless the whole component has no other. Ties do not exist:
a component is named by its smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from termloom.llm.common import column, first_of_each, free_name, numbered
from termloom.llm.workers import tidy
from termloom.operators.lookup import salted_join
from termloom.session import materialize

SHINGLE = 4
SEED = 42
RADIUS = 4
# Members of the lowest nodes, children of the upper ones.
FAN = 16
# Fingerprints of one top node that are linked in one task.
RUN = 1 << 15
# Rows a task gathers before it links them, and member pairs it compares at once.
BATCH, COMPARED = 1 << 17, 1 << 21

_CUTS = np.linspace(0, 64, RADIUS + 3).astype(int)
_BLOCKS = [((1 << int(b)) - (1 << int(a))) for a, b in zip(_CUTS, _CUTS[1:])]
MASKS = [a | b for a, b in combinations(_BLOCKS, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# --- fingerprints -----------------------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """SimHash of the shingles of a text, A-Z in lower case; unsigned."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    spans = zip(starts[:n].tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8", n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BATCH):
        bits = np.unpackbits(hashes[at : at + BATCH].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text as a signed 64-bit integer."""

    @tidy
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")

    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from fingerprints(batches)

    return docs.withColumn(free_name(docs, name), of(F.coalesce(column(text), F.lit(""))))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(fp: Column) -> Column:
    """Place of a code word in the Gray sequence, as signed 64 bits."""
    for by in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, by))
    return fp


# --- the index inside a task ------------------------------------------------------------------------------


class _Forest:
    """Components of rows by least row number."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def _cross(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each i, all places (x, y) with x below left[i] and y below right[i]; with i."""
    sizes = left * right
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, at // right[owner], at % right[owner]


class _Level:
    """Nodes over consecutive items: first item, number of items, and the bits all of them share."""

    def __init__(self, group: np.ndarray, every: np.ndarray, any_: np.ndarray):
        first_of_group = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
        place = np.arange(len(group)) - np.repeat(first_of_group, np.diff(first_of_group, append=len(group)))
        self.first = np.flatnonzero(place % FAN == 0)
        self.size = np.diff(self.first, append=len(group))
        self.group = group[self.first]
        self.every = np.bitwise_and.reduceat(every, self.first)
        self.any = np.bitwise_or.reduceat(any_, self.first)
        self.shared = ~(self.every ^ self.any)


def link(group: np.ndarray, fp: np.ndarray, radius: int = RADIUS, side: np.ndarray | None = None) -> np.ndarray:
    """Row number of the representative of each row; ``group`` ascends, ``fp`` is in Gray order within it.

    With ``side``, only rows of different sides are compared.
    """
    forest = _Forest(len(fp))
    if not len(fp):
        return forest.root
    levels = [_Level(group, fp, fp)]
    while len(levels[-1].group) > len(np.unique(levels[-1].group)):
        low = levels[-1]
        levels.append(_Level(low.group, low.every, low.any))
    top = np.arange(len(levels[-1].group))
    a = b = top
    seen, differences = np.zeros(len(a), np.uint64), np.zeros(len(a), np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        common = level.shared[a] & level.shared[b]
        differences = differences + np.bitwise_count((level.every[a] ^ level.every[b]) & common & ~seen)
        near = differences <= radius
        a, b, seen, differences = a[near], b[near], common[near], differences[near]
        if depth:
            owner, x, y = _cross(level.size[a], level.size[b])
            same = a[owner] == b[owner]
            keep = ~same | (x <= y)
            owner, x, y = owner[keep], x[keep], y[keep]
            seen, differences = seen[owner], differences[owner]
            a, b = level.first[a[owner]] + x, level.first[b[owner]] + y
    leaves = levels[0]
    order = np.argsort(b - a, kind="stable")  # neighbours first: they join what is dense
    a, b = a[order], b[order]
    step = max(1, COMPARED // FAN**2)
    while len(a):
        now_a, now_b = a[:step], b[:step]
        owner, x, y = _cross(leaves.size[now_a], leaves.size[now_b])
        i, j = leaves.first[now_a[owner]] + x, leaves.first[now_b[owner]] + y
        ahead = i < j if side is None else (i < j) & (side[i] != side[j])
        i, j = i[ahead], j[ahead]
        close = np.bitwise_count(fp[i] ^ fp[j]) <= radius
        forest.union(i[close], j[close])
        a, b = a[step:], b[step:]
        if len(a):
            least = np.minimum.reduceat(forest.root, leaves.first)
            one = least == np.maximum.reduceat(forest.root, leaves.first)
            apart = ~(one[a] & one[b] & (least[a] == least[b]))
            a, b = a[apart], b[apart]
    return forest.root


_EDGE = "a bigint, b bigint, node string, run int"


def _edges(fp: np.ndarray, root: np.ndarray) -> pd.DataFrame:
    moved = root != np.arange(len(root))
    return pd.DataFrame(
        {"a": fp[moved].view(np.int64), "b": fp[root[moved]].view(np.int64), "node": None, "run": -1}
    )


def _link_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges within top nodes, whose rows come one node after the other in Gray order.

    Of a node that is cut into runs the rows leave as well, with the node and their run.
    """
    held: list[tuple[np.ndarray, ...]] = []
    waiting = runs = 0  # rows held; runs already cut from the node they begin with

    def as_runs(node: str, fp: np.ndarray, first: int) -> Iterator[pd.DataFrame]:
        for number, at in enumerate(range(0, len(fp), RUN), first):
            rows = fp[at : at + RUN]
            yield _edges(rows, link(np.zeros(len(rows), np.int64), rows))
            yield pd.DataFrame({"a": rows.view(np.int64), "b": 0, "node": node, "run": number})

    def settle(last: bool) -> Iterator[pd.DataFrame]:
        """Link all nodes that are complete, and whole runs of the one that may go on."""
        nonlocal held, waiting, runs
        pair, bits, fp = (np.concatenate(x) for x in zip(*held))
        change = np.flatnonzero((np.diff(pair) != 0) | (np.diff(bits) != 0)) + 1
        bounds = np.concatenate([[0], change, [len(fp)]]).tolist()
        small = np.zeros(len(fp), bool)
        rest = len(fp)
        for start, end in zip(bounds, bounds[1:]):
            open_ended = end == len(fp) and not last
            if not open_ended and not runs and end - start <= RUN:
                small[start:end] = end - start > 1
                continue
            if open_ended:
                rest = start + (end - start) // RUN * RUN
                end = rest
            yield from as_runs(f"{pair[start]}:{bits[start]}" if end > start else "", fp[start:end], runs)
            runs = runs + (end - start) // RUN if open_ended else 0
        if small.any():
            group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[small]
            yield _edges(fp[small], link(group, fp[small]))
        held = [(pair[rest:], bits[rest:], fp[rest:])]
        waiting = len(fp) - rest

    for batch in batches:
        held.append((batch["pair"].to_numpy(), batch["bits"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)))
        waiting += len(batch)
        if waiting >= BATCH:
            yield from settle(False)
    if held:
        yield from settle(True)


def _gray(fp: np.ndarray) -> np.ndarray:
    for by in (1, 2, 4, 8, 16, 32):
        fp = fp ^ (fp >> np.uint64(by))
    return fp


def _link_runs(rows: pd.DataFrame) -> pd.DataFrame:
    """Edges between two runs of a node."""
    fp, run = rows["a"].to_numpy().view(np.uint64), rows["run"].to_numpy()
    order = np.argsort(_gray(fp), kind="stable")
    fp, run = fp[order], run[order]
    return _edges(fp, link(np.zeros(len(fp), np.int64), fp, side=run))[["a", "b"]]


def similarity_edges(fingerprints: DataFrame, fp: str = "fp") -> DataFrame:
    """``(a, b)``: edges that connect exactly the linked ones of distinct fingerprints."""
    dealt = fingerprints.select(
        F.col(fp).alias("fp"),
        F.posexplode(F.array(*[F.col(fp).bitwiseAND(F.lit(_signed(m))) for m in MASKS])).alias("pair", "bits"),
    )
    sorted_nodes = dealt.repartition("pair", "bits").sortWithinPartitions("pair", "bits", gray_rank(F.col("fp")))
    found = materialize(sorted_nodes.mapInPandas(tidy(_link_nodes), _EDGE), "edges")
    inner = found.where(F.col("node").isNull()).select("a", "b")
    return inner.union(_edges_between_runs(found.where(F.col("node").isNotNull()).drop("b"))).distinct()


def _edges_between_runs(rows: DataFrame) -> DataFrame:
    """``(a, b)`` for large top nodes: pairs of their runs that the bits each run shares do not rule out."""
    shared = rows.groupBy("node", "run").agg(F.bit_and("a").alias("every"), F.bit_or("a").alias("any"))
    other = shared.select("node", *[F.col(c).alias(f"{c}2") for c in ("run", "every", "any")])
    fixed = F.bitwise_not(F.col("every").bitwiseXOR(F.col("any"))).bitwiseAND(
        F.bitwise_not(F.col("every2").bitwiseXOR(F.col("any2")))
    )
    apart = F.bit_count(F.col("every").bitwiseXOR(F.col("every2")).bitwiseAND(fixed))
    tiles = (
        shared.join(other, "node")
        .where((F.col("run") < F.col("run2")) & (apart <= RADIUS))
        .select("node", F.explode(F.array("run", "run2")).alias("run"), F.struct("run", "run2").alias("tile"))
    )
    return (
        rows.join(tiles, ["node", "run"])
        .groupBy("node", "tile")
        .applyInPandas(_link_runs, "a bigint, b bigint")
    )


# --- components -------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge: the least node of its component.

    Large-star and small-star steps by turns until nothing changes; each turn is written down. Joins are on
    node keys, and nodes with very many edges are cut into slices.
    """

    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))

    def star(edges: DataFrame, label: str) -> DataFrame:
        """``edges (u, v)`` with u's least neighbour m, or u itself if that is less."""
        stats = materialize(least(edges), label)
        return salted_join(edges, stats.select("u", "m"), "u", rows_per_key=stats.select("u", "n"))

    now = materialize(edges.where(F.col("a") != F.col("b")).select(F.col("a").alias("u"), F.col("b").alias("v")), "cc")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
        large = star(both, "large").where(F.col("v") > F.col("u"))
        large = materialize(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc")
        small = star(large, "small")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        now = materialize(moved.union(small.select("u", F.col("m").alias("v"))).distinct(), "cc")
        sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = tuple(now.agg(F.count(F.lit(1)), sums).first())
        if state == before:
            break
        before = state
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row, the fingerprint as 64 signed bits."""
    rows = with_fingerprints(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")))
    rows = materialize(rows.select("doc_id", "fingerprint"), "fingerprints")
    groups = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    groups = materialize(groups, "distinct")
    roots = components(similarity_edges(groups, "fingerprint"))
    rooted = materialize(
        groups.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", "least", "n", F.coalesce("root", "fingerprint").alias("root")
        ),
        "rooted",
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    of_fingerprint = salted_join(
        rooted.select("fingerprint", "root", F.col("n").alias("rows")),
        named.select("root", "component_id"),
        "root",
        rows_per_key=named.select("root", "n"),
    )
    return salted_join(
        rows, of_fingerprint.select("fingerprint", "component_id"), "fingerprint", rows_per_key=groups.select("fingerprint", "n")
    ).select("doc_id", "fingerprint", "component_id")


def near_duplicate_filter(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, columns as in ``docs``: the one with the smallest id, null ids last, and of equal
    ids the first as numbered. Rows that repeat an id stay or go each by its own text."""
    row = free_name(docs, "row")
    rows = numbered(docs, row)
    found = near_duplicates(rows, text, row).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    ids = rows.select(column(row).alias("row"), column(doc_id).alias("id"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least")
    kept = found.join(ids, "row").groupBy("group").agg(least)
    return first_of_each(docs, rows, row, kept.select(F.col("least.row").alias("row")))
