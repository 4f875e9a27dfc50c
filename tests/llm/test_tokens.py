"""Encoding, token files and packing against the tokenizer libraries."""

import base64
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from termloom.llm import bpe, bpe_chunks, packing, token_store
from tests.llm.conftest import TEXTS

JSON = P.path("byte_bpe_50k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rank_library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == P.PATTERN


@settings(max_examples=300, deadline=None, database=None)
@given(st.text(max_size=40) | st.text(alphabet=" \n\t ab1'sé漢!<|>", max_size=40))
def test_encode_is_the_librarys(text):
    expected = Tokenizer.from_file(JSON) if not hasattr(test_encode_is_the_librarys, "t") else test_encode_is_the_librarys.t
    test_encode_is_the_librarys.t = expected
    expected.encode_special_tokens = True
    vocab = bpe.vocabulary(JSON)
    ids = vocab.encode(text)
    assert ids.tolist() == expected.encode(text, add_special_tokens=False).ids
    assert vocab.decode(ids) == text.encode()


def test_texts_the_splitter_gives_up_on():
    vocab = bpe.vocabulary(JSON)
    for text in (" " * 1_500_000 + "a", "\n \t" * 400_000, "a" * 300_000):
        ids = vocab.encode(text)
        assert vocab.decode(ids) == text.encode()
        pieces = [m[0] for m in vocab.pattern.finditer(text)]
        assert len(ids) == sum(len(vocab.core.encode_single_piece(p.encode())) for p in pieces)


ALPHABET = " \n\tab1'srelv é漢!<|"


@pytest.mark.parametrize("overlap", [6, 40])
def test_chunks_agree_with_whole_texts(overlap, monkeypatch):
    monkeypatch.setattr(bpe_chunks, "OVERLAP", overlap)
    vocab, chooser, whole = bpe.vocabulary(RANKS), random.Random(5), 0
    for _ in range(400):
        text = "".join(chooser.choice(ALPHABET) for _ in range(chooser.randint(1, 300)))
        size = chooser.randint(overlap + 1, 90)
        n = max(1, -(-len(text) // size))
        parts = []
        for i in range(n):
            body = text[i * size : (i + 1) * size + overlap]
            parts.append(bpe_chunks.encode_chunk(vocab, body, i == n - 1, size))
        if any(p["hands_over"] is None for p in parts):
            whole += 1
            continue
        assert bpe_chunks.stitch(parts).tolist() == vocab.encode(text).tolist(), repr(text)
    assert whole < 400


@pytest.mark.parametrize("overlap", [6, 40])
def test_chunks_cut_in_unicode_white_space(overlap, monkeypatch):
    monkeypatch.setattr(bpe_chunks, "OVERLAP", overlap)
    vocab, chooser = bpe.vocabulary(RANKS), random.Random(7)
    texts = ["x" * 20 + "foo \u00a0bar" + " b" * 40]
    texts += ["".join(chooser.choice(" \n\u00a0\u2009\u2028ab1") for _ in range(chooser.randint(1, 300))) for _ in range(600)]
    compared = 0
    for k, text in enumerate(texts):
        size = 25 + overlap if k else 25
        n = max(1, -(-len(text) // size))
        parts = [bpe_chunks.encode_chunk(vocab, text[i * size : (i + 1) * size + overlap], i == n - 1, size) for i in range(n)]
        if all(p["hands_over"] is not None for p in parts):
            compared += 1
            assert bpe_chunks.stitch(parts).tolist() == vocab.encode(text).tolist(), repr(text)
    assert compared > 300


@pytest.mark.parametrize("chunk", [600, 5000, bpe_chunks.CHUNK])
def test_documents_in_chunks(chunk, tricky, rank_library):
    rows = bpe_chunks.encode_documents(tricky, RANKS, chunk=chunk)
    decoded = bpe_chunks.decode_documents(rows, RANKS).collect()
    found = sorted((str(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in decoded)
    expected = sorted(
        (str(d), np.array(rank_library(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t, _, _ in TEXTS
    )
    assert found == expected


def test_bpe_query(spark, small_docs, rank_library):
    from termloom.llm.queries import op5_bpe

    found = {r["doc_id"]: r for r in op5_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == small_docs.count()
    for doc_id, text in small_docs.select("doc_id", "text").collect():
        ids = rank_library(text)
        assert found[doc_id]["n_tokens"] == len(ids)
        assert found[doc_id]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_encode_empty_table(empty):
    assert bpe_chunks.encode_documents(empty, RANKS).count() == 0


# --- token files ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [1, 200, 60_000, 2**31])
def test_random_access(most):
    chooser = np.random.default_rng(most)
    ids = chooser.integers(0, most, 5000).astype(np.uint32)
    ids[::3] = ids[::3] % 256
    stream = io.BytesIO()
    token_store.write_file(stream, np.array([7]), np.array([0, len(ids)]), ids)
    stream.seek(0)
    file = token_store.TokenFile(stream)
    for at in (0, 1, 511, 512, 513, 4095, 4999, *chooser.integers(0, 5000, 200)):
        assert file.tokens(at, at + 1)[0] == ids[at]
        end = int(chooser.integers(at, 5001))
        assert (file.tokens(at, end) == ids[at:end]).all()
    assert [x.tolist() for x in file.documents()] == [[7], [0, 5000]]


def test_token_query(spark, small_docs, library):
    from termloom.llm.queries import op6_token_store

    start, expected = 0, []
    for doc_id, text in small_docs.select("doc_id", "text").orderBy("doc_id").collect():
        ids = np.array([*library(text), 0], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op6_token_store(spark, "/root/testdata/sf0.001").collect())) == expected


def test_token_files_of_tricky_texts(tricky, empty, library, monkeypatch, tmp_path):
    monkeypatch.setattr(token_store, "FILE_TOKENS", 50)
    files = token_store.write_tokens(tricky, JSON, f"file://{tmp_path}/t")
    rows = sorted(map(tuple, token_store.read_documents(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    assert [r[1] for r in rows] == np.cumsum([0, *[r[2] for r in rows]])[:-1].tolist()
    sums = Counter(zlib.crc32(np.array([*library(t), 0], "<u4").tobytes()) for _, t, _, _ in TEXTS)
    assert Counter(r[3] for r in rows) == sums
    assert token_store.read_documents(token_store.write_tokens(empty, JSON, f"file://{tmp_path}/e")).count() == 0


# --- packing ----------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None, database=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), max_size=6), st.integers(0, 20))
def test_fullest_combination(available, room):
    pattern = packing.fullest(available, room)
    assert all(n <= available[length] for length, n in pattern)
    reachable = {0}
    for length, n in available.items():
        reachable = {r + k * length for r in reachable for k in range(n + 1)}
    assert sum(length * n for length, n in pattern) == max(r for r in reachable if r <= room)


def test_plan_uses_every_piece_once_and_few_bins():
    chooser = random.Random(3)
    for n in (0, 1, 30, 5000):
        counts = Counter(min(2048, int(chooser.lognormvariate(6, 1)) + 1) for _ in range(n))
        plan = packing.minimum_bin_slack(dict(counts))
        used = Counter()
        for pattern, times in plan:
            assert sum(a * b for a, b in pattern) <= 2048
            for length, k in pattern:
                used[length] += k * times
        assert used == counts
        least = -(-sum(a * b for a, b in counts.items()) // 2048)
        assert sum(t for _, t in plan) <= least * 1.01 + 1


def check_packing(rows, tokens):
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset); tokens by document, several if repeated."""
    bins, pieces = defaultdict(list), Counter()
    for doc, piece, start, length, crc, sequence, offset in rows:
        bins[sequence].append((offset, length))
        pieces[doc, piece, start, length, crc] += 1
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
        assert sum(n for _, n in parts) <= 2048
    expected = Counter()
    for doc, ids in tokens:
        for piece, (start, length) in enumerate(packing.cuts(len(ids))):
            own = np.array(ids[start : start + length], "<u4").tobytes()
            expected[doc, piece, start, length, zlib.crc32(own)] += 1
    assert pieces == expected
    least = -(-sum(len(ids) for _, ids in tokens) // 2048)
    assert len(bins) <= least * 1.02 + 1


def test_packing_query(spark, small_docs, library):
    from termloom.llm.queries import op8_packing

    tokens = [(d, [*library(t), 0]) for d, t in small_docs.select("doc_id", "text").collect()]
    check_packing(map(tuple, op8_packing(spark, "/root/testdata/sf0.001").collect()), tokens)


def test_packing_of_tricky_texts(tricky, empty, library):
    packed = packing.pack(tricky, JSON, with_ids=True)
    tokens = [(d, [*library(t), 0]) for d, t, _, _ in TEXTS]
    check_packing([tuple(r)[:7] for r in packed.collect()], tokens)
    whole = packing.sequences(packed).collect()
    assert Counter(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in whole]).tolist()) == Counter(
        i for _, ids in tokens for i in ids
    )
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 4 * 2048 for r in whole)
    assert packing.pack(empty, JSON).count() == 0


def test_packing_ranks_beyond_the_broadcast_limit(small_docs, library, monkeypatch):
    monkeypatch.setattr(packing.Dictionary, "fits", lambda self: False)
    tokens = [(d, [*library(t), 0]) for d, t in small_docs.select("doc_id", "text").collect()]
    check_packing(map(tuple, packing.pack(small_docs.repartition(5), JSON).collect()), tokens)


def test_cuts():
    assert packing.cuts(2048) == [(0, 2048)] and packing.cuts(1) == [(0, 1)]
    assert packing.cuts(5000) == [(0, 904), (904, 2048), (2952, 2048)]
