"""Dictionaries that grow, dictionaries in buckets, matrices in ranges."""

import pytest
from pyspark.sql import functions as F

from termloom.operators.buckets import BucketedDictionary, bucketed
from termloom.operators.counts import term_doc_counts
from termloom.operators.lookup import Dictionary
from termloom.sinks import ranges
from termloom.sources.dictionary import vocabulary_ids
from termloom.sources.growth import extend_ids, new_keys


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def plain(spark):
    """No join but those asked for."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


# --- growth


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_old_ids_stay_and_new_ones_are_dense(spark, limit):
    old = spark.createDataFrame([(1, "b"), (2, "a"), (5, "z")], "term_id bigint, term string")  # 3, 4: repeated lines
    keys = spark.createDataFrame([("z",), ("c",), ("B",), ("é",), ("c",), (None,), ("a",)], "term string")
    grown = extend_ids(Dictionary(old, limit), keys, "term", "term_id")
    assert grown.columns == ["term_id", "term"]
    assert sorted(map(tuple, grown.collect())) == [(1, "b"), (2, "a"), (5, "z"), (6, "B"), (7, "c"), (8, "é")]
    again = extend_ids(Dictionary(grown, limit), keys, "term", "term_id")
    same(again, grown)


def test_nothing_old_and_nothing_new(spark):
    none = spark.createDataFrame([], "term_id bigint, term string")
    keys = spark.createDataFrame([("x",), ("w",)], "term string")
    assert sorted(map(tuple, extend_ids(none, keys, "term", "term_id").collect())) == [(1, "w"), (2, "x")]
    assert extend_ids(none, none, "term", "term_id").isEmpty()
    old = spark.createDataFrame([(1, "x"), (2, "w")], "term_id bigint, term string")
    same(extend_ids(old, keys, "term", "term_id"), old)
    assert new_keys(old, keys, "term").isEmpty()


def test_encode_extend_encode_again(spark):
    schema = "doc_name string, text string"
    first = spark.createDataFrame([("c.1", "one two two"), ("c.2", "three one")], schema)
    second = spark.createDataFrame([("c.3", "two four five five"), ("c.4", "one zero")], schema)
    docs = spark.createDataFrame([(i, f"c.{i}") for i in range(1, 5)], "doc_id bigint, doc_name string")

    def words(rows):
        return rows.select(F.explode(F.split("text", " ")).alias("term"))

    terms = vocabulary_ids(words(first))
    grown = extend_ids(terms, words(second), "term", "term_id")
    before = term_doc_counts(first, terms, docs)
    after = term_doc_counts(first.union(second), grown, docs)
    same(after.where("doc_id <= 2"), before)
    assert {r["term_id"] for r in after.where("doc_id > 2").collect()} - set(range(1, 4)) == {4, 5, 6}


# --- buckets


@pytest.fixture
def sides(spark):
    """A third of the rows under one id, another third under an id that no dictionary knows, some under none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(99_999))
    key = F.when(F.col("id") % 17 == 0, F.lit(None)).otherwise(F.coalesce(key, F.col("id") % 900))
    rows = spark.range(6000).select(key.cast("bigint").alias("term_id"), F.col("id").alias("place"))
    words = spark.range(1, 800).select(F.col("id").alias("term_id"), F.concat(F.lit("w"), "id").alias("term"))
    return rows, words


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_bucketed_lookup_equals_the_join(spark, sides, how):
    rows, words = sides
    stored = BucketedDictionary(words, "term_id")
    same(stored.lookup(rows, how), rows.join(words, "term_id", how))
    assert stored.lookup(rows.limit(0), how).isEmpty()
    stored.drop()


def test_the_dictionary_is_not_shuffled(spark, sides, plain):
    rows, words = sides
    stored = BucketedDictionary(words, "term_id", buckets=16)
    plan = plan_of(stored.lookup(rows))
    # Only rows travel: one exchange to the buckets, none over the scan of the table.
    assert plan.count("Exchange hashpartitioning(term_id") == 1
    assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning")
    assert "Bucketed: true" in plan[plan.index("Exchange hashpartitioning") :]
    # A bucket is a file; a scan of one has one task.
    assert stored.entries([5]).rdd.getNumPartitions() == 1 < stored.df.rdd.getNumPartitions()
    assert stored.entries([5, 6, 5000]).count() == 2
    stored.drop()


def test_small_dictionaries_stay_as_they_are(spark, sides):
    small = Dictionary(sides[1])
    assert bucketed(small, "term_id") is small
    large = bucketed(Dictionary(sides[1], 0), "term_id")
    assert isinstance(large, BucketedDictionary) and large.rows == 799
    large.drop()


# --- ranges


def test_ranges_are_in_order_and_a_point_opens_one_file(spark, out):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 100).cast("bigint").alias("term_id"),
        F.col("id").alias("doc_id"),
        F.lit(1).cast("bigint").alias("freq"),
    )
    ranges.write_ranges(rows, out, rows_per_file=100)
    same(ranges.read_ranges(spark, out), rows)
    files = ranges.manifest(spark, out).orderBy("file").collect()
    assert sum(f["n"] for f in files) == 4000 and max(f["n"] for f in files) <= 100
    ends = sorted((f["first_term_id"], f["last_term_id"]) for f in files)
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    for term in (3, 50, 97):
        found = ranges.rows_of_term(spark, out, term)
        same(found, rows.where(F.col("term_id") == term))
        opened = {r[0].rsplit("/", 1)[-1] for r in found.select("_metadata.file_path").distinct().collect()}
        assert len(found.inputFiles()) <= len(opened) + 2
    assert ranges.rows_of_term(spark, out, 12_345).isEmpty()


def test_ranges_of_nothing(spark, out):
    none = spark.createDataFrame([], "term_id bigint, doc_id bigint, freq bigint")
    ranges.write_ranges(none, out)
    assert ranges.read_ranges(spark, out).isEmpty() and ranges.rows_of_term(spark, out, 1).isEmpty()
