"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom.llm import spelling_variants as V


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, factor=V.FACTOR):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    found = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        found[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return found


def got(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def frame(spark, counts):
    return spark.createDataFrame(list(counts), "word string, n bigint")


def test_all_pairs_of_random_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 6))) for _ in range(260)}
    counts = {w: 10 ** rng.randint(0, 4) * rng.randint(1, 3) for w in words}
    assert got(V.variants(frame(spark, counts.items()))) == brute(counts)
    assert got(V.variants(frame(spark, counts.items()), factor=2)) == brute(counts, 2)


def test_runs_ties_chains_and_repeated_rows(spark):
    counts = {"aaaa": 1, "aaa": 10, "aa": 100, "aab": 100, "aba": 1000, "abc": 10_000, "": 3, "z": 30, "y": 30, "😀": 2, "😀a": 900}
    rows = [*counts.items(), ("aaaa", 0), (None, 5), (None, 5)]
    found = got(V.variants(frame(spark, rows)))
    assert found == brute(counts)
    assert found["aaaa"][2] == "aaa" and found[""][2] == "y" and found["aaaa"][4] == "abc"


def expected_words(rows, min_length=V.MIN_LENGTH):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            check = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if check % V.DAMAGE == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    return dict(counts)


def test_words_of_texts(spark, tricky, small_docs):
    for docs in (tricky, small_docs):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        found = {r["word"]: r["n"] for r in V.text_words(docs).collect()}
        assert found == expected_words(rows)
    special = [(1, "ÀÉÎõüÿ× ÀÉÎÕÜ÷y x" + "Ab" * 5000), (2, "Résumés RÉSUMÉS résumés"), (None, "Résumés")]
    found = {r["word"]: r["n"] for r in V.text_words(spark.createDataFrame(special, "doc_id bigint, text string")).collect()}
    assert found == expected_words(special)


def test_whole_query(spark, tricky, empty):
    rows = [(r["doc_id"], r["text"]) for r in tricky.collect()]
    counts = {w: n for w, n in expected_words(rows * 3).items() if n >= V.MIN_COUNT}
    assert got(V.spelling_variants(tricky.union(tricky).union(tricky))) == brute(counts)
    assert V.spelling_variants(empty).count() == 0


def test_groups_are_bounded_by_the_alphabet(spark):
    words = [(f"word{a}{b}", 1) for a in "abcdefghij" for b in "abcdefghij"]
    entries = V._rotations(frame(spark, words))
    assert entries.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] <= 11
    assert entries.count() == sum(2 * len(w) + 1 for w, _ in words)


def test_a_word_with_the_terminator_is_an_error(spark):
    with pytest.raises(Exception, match="terminator"):
        V.variants(frame(spark, [("a\0b", 1)])).collect()
