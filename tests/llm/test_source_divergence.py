"""Transducers against sorted lists, and the audit against exact brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.llm import source_divergence as S
from termloom.llm.transducer import Stepper, Transducer

WORDS = st.lists(st.text("abcéß", min_size=1, max_size=7), unique=True, max_size=60)


def minimal_states(words):
    """States of the smallest automaton: distinct sets of endings, the root apart."""
    prefixes = {w[:i] for w in words for i in range(1, len(w) + 1)}
    return 1 + len({frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes})


@settings(max_examples=60, deadline=None)
@given(WORDS, WORDS)
def test_ranks_words_and_size(mine, others):
    mine, others = (sorted(w.encode() for w in words) for words in (mine, others))
    made = [Transducer.from_bytes(Transducer.of(words).to_bytes()) for words in (mine, others)]
    assert [made[0].word(i) for i in range(len(mine))] == mine
    assert len(made[0].final) == minimal_states(mine)
    asked = [*mine, *others, b"zz", b"ab"]
    data = np.frombuffer(b"\0".join(asked) + b"\0", np.uint8)
    length = np.array([len(w) for w in asked])
    start = np.cumsum(length + 1) - length - 1
    stepper = Stepper(made)
    for own, root in zip((mine, others), stepper.roots):
        found = stepper.ranks(data, start, length, np.full(len(asked), root))
        assert found.tolist() == [own.index(w) if w in own else -1 for w in asked]


def brute(rows, min_docs, top=S.TOP):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for text, lang, source in rows]
    docs = [(a, b, ["".join(c.lower() if c.isascii() else c for c in t) for t in terms]) for a, b, terms in docs]
    spread, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        spread[lang].update(set(terms))
        groups[lang, source].update(terms)
    found = []
    for lang in {d[0] for d in docs}:
        kept = sorted((t for t, n in spread[lang].items() if n >= min_docs), key=lambda t: t.encode())

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + (1_000_000_000 * (counts[t] + 5)) // (total + 5 * len(kept)) for t in kept}

        own = {s: shares(c) for (x, s), c in groups.items() if x == lang}
        every = shares(sum((c for (x, _), c in groups.items() if x == lang), Counter()))
        for source, p in own.items():
            pairs = [(sum(abs(p[t] - q[t]) for t in kept), item) for item, q in own.items() if item != source]
            more = [(p[t] - every[t], t) for t in kept if groups[lang, source][t] and p[t] > every[t]]
            for part, items in (("pair", pairs), ("term", more)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                ranked = ranked[:top] if part == "term" else ranked
                found += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(map(str, found))


def got(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    words = ["The", "the", "THE", "été", "Été", "ab", "a", "b", "漢字", "zz9zz", "o'clock", *[f"w{c}" for c in "abcdefgh"]]
    langs, sources = ["en", "de", "", None, "xx\0yy"], ["s1", "s2", "s3", None, "é", "", "S1"]
    made = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(langs[:4]), rng.choice(sources)) for _ in range(150)]
    return [*made, (None, "en", "only null"), ("rare", "alone", "x"), ("rare", "alone", "y"), ("b", "xx\0yy", "s1")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)


def test_as_brute_force(spark, rows):
    assert got(S.source_divergence(frame(spark, rows), min_docs=4)) == brute(rows, 4)
    assert got(S.source_divergence(frame(spark, rows), min_docs=2, top=3)) == brute(rows, 2, 3)


def test_many_shards_slices_and_tiles(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "SHARD_TERMS", 3)
    monkeypatch.setattr(S, "SOURCES", 2)
    monkeypatch.setattr(S, "TERMS", 4)
    for limit in (S.BROADCAST_LIMIT, 1):
        assert got(S.source_divergence(frame(spark, rows), min_docs=2, limit=limit)) == brute(rows, 2)


def test_counts_beyond_64_bits_of_the_product(spark):
    cells = spark.range(1).select(F.lit(5 * 10**17).alias("n"), F.lit(10**18).alias("t"), F.lit(3).cast("bigint").alias("v"))
    assert cells.select(S.share(F.col("n"), F.col("t"), F.col("v"))).first()[0] == 1 + 10**9 * (5 * 10**17 + 5) // (10**18 + 15)


def test_tricky_and_empty(spark, tricky, empty):
    rows = [(r["text"], r["lang"], r["source"]) for r in tricky.collect()]
    assert got(S.source_divergence(tricky, min_docs=2)) == brute(rows, 2)
    assert S.source_divergence(empty).count() == 0


def test_pieces_of_long_texts_hold_whole_terms(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 5)
    text = "Ab cde-fghijklmno pé漢 x" * 3 + "y" * 50
    whole = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)
    assert [t.decode() for piece in S._terms(text) for t in piece] == ["".join(c.lower() if c.isascii() else c for c in t) for t in whole]


def test_portions_of_texts_are_counted_as_arrays(monkeypatch):
    texts = ["Up up, DOWN", "", "!?", "ünder up-\u00c9t\u00e9 up", "a b " * 40 + "Up", "\x0b\u0085up\ud800x up"]
    rows = [("en", f"s{i % 2}", t) for i, t in enumerate(texts * 2)] + [("de", "s0", t) for t in texts[:4]] + [("fr", "s0", "!")]
    found = [(*k, [b.lower().decode() for b in re.findall(rb"[A-Za-z\x80-\xff]+", t.encode("utf-8", "replace"))]) for *k, t in rows]
    occurring = Counter((lang, source, w) for lang, source, words in found for w in words)
    documents = Counter((lang, w) for lang, _, words in found for w in set(words))
    for portion, piece in ((1 << 24, 1 << 20), (60, 8), (1, 1)):
        monkeypatch.setattr(S, "PORTION", portion)
        monkeypatch.setattr(S, "PIECE", piece)
        for pieces, distinct, width, want in ((S._pieces, False, 2, occurring), (S._reduced, True, 1, documents)):
            # Arrow takes no lone surrogates, rows of a batch are taken as they come.
            batch = type("Batch", (), {"columns": [pa.array([r[i] for r in rows]) for i in range(width)] + [_Texts([r[2] for r in rows])]})
            seen, given = Counter(), 0
            for part in S._portions(iter([batch]), pieces):
                keys, key, word, n = part.counts(distinct)
                given += len(n)
                for k, w, times in zip(key, part.words.take(pa.array(word)).to_pylist(), n):
                    seen[(*keys[k], w.decode())] += int(times)
            assert seen == want
            if portion > 60:
                assert given == len(want)  # equal words of a key come as one


class _Texts(list):
    def to_pylist(self):
        return list(self)
