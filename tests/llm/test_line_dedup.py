"""Line deduplication against brute force: whole texts, additions, removals, slices of filters."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.llm import line_dedup as D

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANKS))


def brute(texts, min_docs=D.MIN_DOCS, min_chars=D.MIN_CHARS):
    split = [(t or "").split("\n") for t in texts]
    counts = Counter(k for lines in split for k in {key_of(x) for x in lines})
    result = []
    for lines in split:
        kept = [x for x in lines if len(key_of(x)) < min_chars or counts[key_of(x)] < min_docs]
        result.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return result


def cleaned(df):
    return sorted(map(str, (tuple(r) for r in df.select("doc_id", "lines.*").collect())))


def wanted(rows, **options):
    found = brute([t for _, t in rows], **options)
    return sorted(str((i, *f)) for (i, _), f in zip(rows, found))


def corpus(n, seed):
    rng = random.Random(seed)
    lines = ["", " ", "Home", "home ", "\tHOME\r", "É", "é", "nav  ", "nav", *[f"line {i}" for i in range(300)]]
    return [(i, rng.choice([None, ""]) if i % 17 == 0 else "\n".join(rng.choices(lines, k=rng.randint(1, 9)))) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    return corpus(240, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_as_brute_force(spark, rows):
    for options in ({"min_docs": 3}, {"min_docs": 4, "min_chars": 5}):
        assert cleaned(D.drop_common_lines(frame(spark, rows), **options)) == wanted(rows, **options)


def test_added_in_batches_and_removed(spark, rows):
    first, second, third = rows[:100], rows[100:180], rows[180:]
    index = D.build(frame(spark, first), min_docs=3).added(frame(spark, second))
    assert cleaned(index.clean(frame(spark, first + second))) == wanted(first + second, min_docs=3)
    more = index.added(frame(spark, third))
    assert cleaned(more.clean(frame(spark, rows))) == wanted(rows, min_docs=3)
    less = more.removed(frame(spark, first))
    assert cleaned(less.clean(frame(spark, second + third))) == wanted(second + third, min_docs=3)
    back = less.added(frame(spark, first)).removed(frame(spark, third))
    assert cleaned(back.clean(frame(spark, first + second))) == wanted(first + second, min_docs=3)
    assert sorted(map(str, back.refs.collect())) == sorted(map(str, index.refs.collect()))
    nothing = back.removed(frame(spark, first + second))
    assert nothing.refs.isEmpty()


def test_shards_slices_and_filters_that_fill(spark, rows, monkeypatch):
    monkeypatch.setattr(D, "SHARD_KEYS", 16)
    index = D.build(frame(spark, rows[:120]), min_docs=2, limit=200)
    assert index.bits > 1 and index.filters.count() > 2
    assert cleaned(index.clean(frame(spark, rows[:120]))) == wanted(rows[:120], min_docs=2)
    grown = index.added(frame(spark, rows[120:]))
    assert cleaned(grown.clean(frame(spark, rows))) == wanted(rows, min_docs=2)
    monkeypatch.setattr(D, "SHARD_KEYS", 1 << 16)
    one = D.LineIndex(index.refs, index._made(index.frequent), 0, 2)
    one.bits = 0
    one.filters = one._made(one.frequent)
    full = one.added(frame(spark, rows[120:]))  # one small filter, which has to be made again
    assert cleaned(full.clean(frame(spark, rows))) == wanted(rows, min_docs=2)


def test_removing_what_was_not_added(spark):
    index = D.build(frame(spark, [(1, "a"), (2, "b")]))
    with pytest.raises(Exception, match="does not hold"):
        index.removed(frame(spark, [(3, "c")]))


def test_tricky_rows(spark, tricky, empty):
    rows = [(r["doc_id"], r["text"]) for r in tricky.collect()]
    found = D.drop_common_lines(tricky.withColumn("lines", F.lit("taken")), min_docs=2)
    assert "lines" in found.columns and "lines_" in found.columns
    got = sorted(map(str, (tuple(r) for r in found.select("doc_id", "lines_.*").collect())))
    assert got == wanted(rows, min_docs=2)
    assert D.drop_common_lines(empty).count() == 0
    with_none = D.build(empty).added(tricky.select("text"), "text")
    assert with_none.clean(empty).count() == 0


def test_wrong_answers_of_filters_are_known(spark, rows):
    """Filters that hold every key say yes to all lines; the result stays exact."""
    index = D.build(frame(spark, rows), min_docs=3)
    index.filters = index._made(index.refs.select("key"))
    assert index._strays({0: 8}).count() == index.refs.where("n < 3").count() > 0
    assert cleaned(index.clean(frame(spark, rows))) == wanted(rows, min_docs=3)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=400, unique=True), st.randoms())
def test_cuckoo_filter_holds_what_it_should(keys, rng):
    made = D.CuckooFilter.of(keys)
    gone = set(rng.sample(keys, len(keys) // 2))
    for key in gone:
        made.remove(key)
    again = D.CuckooFilter.from_bytes(made.to_bytes())
    left = [k for k in keys if k not in gone]
    assert sum(s != 0 for s in again.slots) == len(left)
    digests = [bytes(8) + k.to_bytes(8, "big") for k in left]
    if digests:
        assert D.FilterSet(0, {0: again.to_bytes()}).holds(digests).all()
