"""SimHash groups, top-k search and WARC archives against brute force."""

import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from termloom.llm import simhash as S
from termloom.llm import topk_search as T
from termloom.llm import warc as W
from tests.llm.conftest import TEXTS


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, linked):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i + 1, len(values)):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(values))]


def clustered(n, centres, flips, seed):
    chooser = np.random.default_rng(seed)
    middle = chooser.integers(0, 2**64, centres, dtype=np.uint64)
    x = middle[chooser.integers(0, centres, n)]
    for _ in range(flips):
        bit = np.uint64(1) << chooser.integers(0, 64, n).astype(np.uint64)
        x = x ^ np.where(chooser.random(n) < 0.6, bit, np.uint64(0))
    return np.unique(x)


def in_gray_order(x):
    return x[np.argsort(S._gray(x))]


def test_fingerprints():
    for _, text, _, _ in TEXTS:
        assert S.fingerprint(text) == brute_fingerprint(text)
    assert S.fingerprint("A b\x0bC") == brute_fingerprint("a B\x0bc")


@pytest.mark.parametrize("n, centres, flips", [(500, 10, 4), (600, 3, 5), (3, 3, 1), (1, 1, 0), (0, 1, 0), (600, 600, 0)])
def test_index_finds_exactly_the_links(n, centres, flips):
    x = in_gray_order(clustered(n, centres, flips, n))
    side = np.arange(len(x)) % 2

    def near(i, j):
        return int(x[i] ^ x[j]).bit_count() <= 4

    one = np.zeros(len(x), int)
    assert S.link(one, x).tolist() == brute_roots(x, near)
    assert S.link(one, x, side=side).tolist() == brute_roots(x, lambda i, j: near(i, j) and side[i] != side[j])
    parts = np.sort(np.arange(len(x)) % 3)
    y = np.concatenate([in_gray_order(x[parts == k]) for k in range(3)]) if len(x) else x
    near_y = lambda i, j: int(y[i] ^ y[j]).bit_count() <= 4 and parts[i] == parts[j]
    assert S.link(parts, y).tolist() == brute_roots(y, near_y)


@pytest.mark.parametrize("run, batch", [(1 << 15, 1 << 17), (16, 64), (7, 10)])
def test_nodes_as_streams(run, batch, monkeypatch):
    """Large nodes leave in runs that hold each of their rows once; edges link what is near."""
    monkeypatch.setattr(S, "RUN", run)
    monkeypatch.setattr(S, "BATCH", batch)
    x = in_gray_order(clustered(400, 4, 4, 1))
    sizes = [1, 90, 2, 3, 120, 1, len(x) - 217]
    rows = pd.DataFrame({"pair": np.repeat([0, 0, 0, 1, 1, 2, 2], sizes), "bits": np.repeat(range(7), sizes), "fp": x.view(np.int64)})
    parts = [rows.iloc[i : i + 13] for i in range(0, len(rows), 13)]
    found = pd.concat([f for f in S._link_nodes(iter(parts)) if len(f)])
    cut = found[found["node"].notna()]
    for bits, group in rows.groupby("bits"):
        mine = cut[cut["node"].fillna("").str.endswith(f":{bits}")]
        if len(group) > run:
            assert sorted(mine["a"]) == sorted(group["fp"])
            assert mine.groupby("run").size().max() <= run
            assert sorted(mine["run"].unique()) == list(range(mine["run"].max() + 1))
        else:
            assert mine.empty
    edges = found[found["node"].isna()]
    for a, b in zip(edges["a"], edges["b"]):
        assert a != b


@pytest.mark.parametrize("run", [1 << 15, 20])
def test_edges_connect_what_is_linked(spark, run, monkeypatch):
    x = clustered(700, 12, 5, 3)
    found = [(int(v),) for v in x.view(np.int64)]
    df = spark.createDataFrame(found, "fp bigint").repartition(4)
    if run < 100:  # workers import the module anew, so the small run is passed inside the function
        monkeypatch.setattr(S, "MASKS", [0])
    edges = S.similarity_edges(df, "fp")
    roots = {r["node"]: r["root"] for r in S.components(edges).collect()}
    signed = [v for v, in found]
    expected = brute_roots(x, lambda i, j: int(x[i] ^ x[j]).bit_count() <= 4)
    groups = {}
    for value, root in zip(signed, expected):
        groups.setdefault(root, set()).add(value)
    for members in groups.values():
        names = {roots.get(m, m) for m in members}
        assert names == {min(members)}


def test_runs_of_a_node_are_linked(spark):
    x = in_gray_order(clustered(300, 2, 4, 9))
    rows = [(int(v), "n", i // 40) for i, v in enumerate(x.view(np.int64))]
    edges = S._edges_between_runs(spark.createDataFrame(rows, "a bigint, node string, run int")).collect()
    place = {r[0]: i for i, r in enumerate(rows)}
    root = brute_roots(x, lambda i, j: i // 40 != j // 40 and int(x[i] ^ x[j]).bit_count() <= 4)
    for e in edges:
        assert root[place[e["a"]]] == root[place[e["b"]]]
    joined = brute_roots(x, lambda i, j: any({rows[i][0], rows[j][0]} == {e["a"], e["b"]} for e in edges)) if len(x) < 80 else None
    assert joined is None or joined == root


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5, 5)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert all(roots[i] == 0 for i in range(41)) and all(roots[1000 + i] == 1000 for i in range(300))
    assert S.components(edges.where("false")).count() == 0


def test_near_duplicates_of_tricky_texts(tricky, empty):
    rows = S.near_duplicates(tricky).collect()
    prints = [brute_fingerprint(t) for _, t, _, _ in TEXTS]
    roots = brute_roots(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    expected = []
    for (d, _, _, _), fp, root in zip(TEXTS, prints, roots):
        ids = [x[0] for x, r in zip(TEXTS, roots) if r == root and x[0] is not None]
        expected.append((d, S._signed(fp), min(ids, default=None)))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    kept = S.near_duplicate_filter(tricky)
    assert kept.columns == tricky.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, {x[2] for x in expected if x[2] is not None} | {None}))
    assert S.near_duplicates(empty).count() == 0 and S.near_duplicate_filter(empty).count() == 0


def test_simhash_query(spark, small_docs):
    from termloom.llm.queries import op7_simhash

    docs = small_docs.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_fingerprint(r["text"]) for r in docs]
    roots = brute_roots(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    expected = {(d["doc_id"], f"{p:016x}", docs[r]["doc_id"]) for d, p, r in zip(docs, prints, roots)}
    assert {tuple(r) for r in op7_simhash(spark, "/root/testdata/sf0.001").collect()} == expected


# --- top-k ------------------------------------------------------------------------------------------------


def brute_top(rows, k=5):
    q = {}
    for ident, v in rows:
        if ident is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        q[ident] = min(q.get(ident, whole), whole)
    found = set()
    for a, x in q.items():
        if a % 50:
            continue
        scores = [(-sum(m * n for m, n in zip(x, y)), b) for b, y in q.items() if b != a and len(y) == len(x)]
        found |= {(a, i + 1, b, -s) for i, (s, b) in enumerate(sorted(scores)[:k])}
    return found


def vectors():
    chooser = np.random.default_rng(0)
    rows = [(i, chooser.normal(0, 0.3, 8).tolist()) for i in range(160)]
    rows += [(200 + i, [0.5] * 8) for i in range(30)]  # ties
    rows += [(250, [0.5] * 8), (250, [0.25] * 8), (300, None), (350, [float("nan")] * 8), (400, [float("inf")] + [0.0] * 7)]
    rows += [(450, [None] + [0.0] * 7), (None, [1.0] * 8), (500, [1.0, 2.0]), (501, [3.0, -2.0]), (550, [-1.0] * 8), (600, [])]
    return rows


def test_top_k(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").select("*", F.lit(1).alias("q"), F.lit(2).alias("score"))
    query = F.col("vec_id") % 50 == 0
    expected = brute_top(rows)
    assert {tuple(r) for r in T.top_k(df, query).collect()} == expected
    monkeypatch.setattr(T, "CHUNK", 20)
    monkeypatch.setattr(T, "BLOCK", 2)
    assert {tuple(r) for r in T.top_k(df, query).collect()} == expected
    assert T.top_k(df.where("false"), query).count() == 0


def test_products_are_exact():
    a = np.array([[2**40, -(2**40)]])
    assert T._products(a, np.array([[2**20, 2**19]])).tolist() == [[2**60 - 2**59]]
    with pytest.raises(OverflowError):
        T._products(a, np.array([[2**40, -(2**40)]]))


# --- WARC -------------------------------------------------------------------------------------------------


def test_archives_of_tricky_pages(spark, tmp_path, monkeypatch):
    same, short = "<p>the same</p>" * 20, "<p>short</p>"
    pages = [(5, "http://a/\r\nX: y", same), (3, None, same), (3, None, same), (9, "http://b", same), (None, "c", same)]
    pages += [(1, "d", short), (2, "e", short), (7, "f", None), (8, "", ""), (11, "g", "é漢\r\n\r\nWARC/1.1\r\n" * 30000)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").select(
        "*", F.lit("x").alias("digest"), F.lit("y").alias("first")
    )
    expected = []
    for page, _, html in pages:
        payload = (html or "").encode()
        revisit = html == same and page != 3
        expected.append((page, len(payload), "revisit" if revisit else "response", 3 if revisit else None))
    for limit in (True, False):
        monkeypatch.setattr(W.Dictionary, "fits", lambda self, limit=limit: limit)
        index = W.write_warc(df, f"file://{tmp_path}/w{limit}")
        rows = W.read_warc(index).collect()
        found = [(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in rows]
        assert sorted(map(str, found)) == sorted(map(str, expected))
    fetched = W.fetch(index, spark.createDataFrame([(11,), (9,), (12345,)], "page_id bigint")).collect()
    by_id = {r["page_id"]: r for r in fetched}
    assert set(by_id) == {9, 11} and by_id[11]["payload"].decode() == pages[-1][2] and by_id[9]["payload"] == b""
    assert W.read_warc(index, payloads=True).where("page_id = 1").first()["payload"] == short.encode()
    assert W.read_warc(W.write_warc(df.where("false"), f"file://{tmp_path}/e")).count() == 0


def test_bundles_are_plain_zstandard_with_an_index(tmp_path, monkeypatch):
    import zstandard

    monkeypatch.setattr(W, "FRAME", 1000)
    writer = W.BundleWriter(f"file://{tmp_path}")
    records = [W.record(i, f"u{i}", b"x" * 300, "d", 0 if i else None) for i in range(20)]
    for i, data in enumerate(records):
        writer.add(i, data)
    writer.close()
    path = writer.uri.removeprefix("file://")
    with open(path, "rb") as file:
        plain = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    assert plain == b"".join(records)
    with W.open_file(writer.uri) as stream:
        bundle = W.Bundle(stream)
        assert len(bundle.frames) > 3
        for page, frame, offset, length in bundle.index():
            assert bundle.frame(frame)[offset : offset + length] == records[page]
