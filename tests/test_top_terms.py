"""The most frequent terms from candidates of a summary, against totals of all words."""

import re

import pytest
from pyspark.sql import functions as F

from termloom import TermStatistics
from termloom.operators import counts as C
from termloom.operators.lookup import Dictionary, frequent_items


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Sixty frequent words, 40 of them known, over many rare ones."""
    path = str(tmp_path_factory.mktemp("texts") / "corpus")
    word = F.when(F.col("id") % 3 == 0, F.concat(F.lit("rare"), F.hash("id"))).otherwise(
        F.concat(F.lit("w"), F.floor(F.pow(F.pmod(F.hash("id"), F.lit(1000)) / 1000.0, 2.0) * 60).cast("int"))
    )
    words = spark.range(60_000).select((F.col("id") % 500).alias("src_id"), word.alias("w"))
    texts = words.groupBy("src_id").agg(F.array_join(F.collect_list("w"), " ").alias("text"))
    texts.withColumn("doc_name", F.concat(F.lit("c."), "src_id")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sides(spark):
    words = [f"w{i}" for i in range(60) if i % 3] + [f"x{i}" for i in range(5000)]
    terms = spark.createDataFrame([(i, w) for i, w in enumerate(words, 1)], "term_id bigint, term string")
    docs = spark.range(0, 500, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("c."), "id").alias("doc_name"))
    return terms, docs, spark.createDataFrame([("w1",), ("w2",)], "term string")


@pytest.mark.parametrize("k", [1, 5, 10, 38])
def test_equal_to_all_totals(spark, corpus, sides, k):
    terms, docs, stops = sides
    small = TermStatistics(corpus, terms, docs, stops)
    large = TermStatistics(corpus, Dictionary(terms, 0), docs, stops)
    assert large._top_totals(k) is not None and small._top_totals(k) is None
    assert large.top_terms_of(k).collect() == small.top_terms_of(k).collect()


def test_tasks_send_candidates_only(spark, corpus, sides):
    terms, docs, stops = sides
    totals = C.top_term_totals(corpus, Dictionary(terms, 0), docs, stops, 5)
    every = C.corpus_term_totals(corpus, Dictionary(terms, 0), docs, stops)
    assert totals.count() < 15 < every.count()
    plan = plan_of(totals)
    assert plan.index("Exchange hashpartitioning(term_id") < plan.index("partial_count") < plan.index("BroadcastHashJoin [term")
    assert not re.search(r"hashpartitioning\(term#", plan)
    wanted = {r["term_id"]: r["total"] for r in every.collect()}
    assert all(wanted[r["term_id"]] == r["total"] for r in totals.collect())


def test_ties_at_the_cut_are_all_candidates(spark):
    text = " ".join(f"t{i % 12}" for i in range(1200))
    corpus = spark.createDataFrame([("c.1", text)], "doc_name string, text string")
    terms = spark.createDataFrame([(i, f"t{i}") for i in range(12)], "term_id bigint, term string")
    docs = spark.createDataFrame([(1, "c.1")], "doc_id bigint, doc_name string")
    found = C.top_term_totals(corpus, Dictionary(terms, 0), docs, k=4)
    assert {(r["term_id"], r["total"]) for r in found.collect()} == {(i, 100) for i in range(12)}


def test_no_word_stands_out(spark, sides):
    """The summary cannot tell, so all words are counted."""
    terms, _, _ = sides
    corpus = spark.range(40).select(
        F.lit("c.0").alias("doc_name"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4999)), lambda i: F.concat(F.lit("x"), i)), " ").alias("text")
    )
    docs = spark.createDataFrame([(1, "c.0")], "doc_id bigint, doc_name string")
    assert C.top_term_totals(corpus, Dictionary(terms, 0), docs, k=5) is None
    run = TermStatistics(corpus, Dictionary(terms, 0), docs)
    best = {(r["term"], r["frequency"]) for r in run.top_terms_of(3).collect()}
    assert best == {("x0", 40), ("x1", 40), ("x10", 40)}


def test_numbers_are_within_the_error(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 5 == 0, F.lit("a")).otherwise(F.col("id").cast("string")).alias("k"))
    found = frequent_items(rows.union(spark.sql("SELECT CAST(NULL AS STRING)")), "k", 64)
    numbers = dict(found.items)
    assert abs(numbers["a"] - 40_000) <= found.error and found.missing >= 2 * found.error
    assert frequent_items(rows.limit(0), "k").items == []
