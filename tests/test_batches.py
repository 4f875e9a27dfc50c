"""A matrix kept up to date by batches equals one run over the documents that are left."""

import os

import pytest
from pyspark.sql import functions as F

from termloom import TermStatistics
from termloom.operators import counts as C
from termloom.operators import toplists as L
from termloom.operators.lookup import Dictionary
from termloom.plans.batches import CountStore

CORPUS = "doc_name string, text string"


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Two classes; documents of several rows, empty and null texts, documents that no dictionary knows."""
    path = str(tmp_path_factory.mktemp("texts") / "corpus")
    word = F.concat(F.lit("w"), F.floor(F.pow(F.pmod(F.hash("id"), F.lit(1000)) / 1000.0, 2.0) * 90).cast("int"))
    words = spark.range(20_000).select((F.col("id") % 300).alias("d"), (F.col("id") % 2).alias("part"), word.alias("w"))
    texts = words.groupBy("d", "part").agg(F.array_join(F.array_sort(F.collect_list("w")), " ").alias("text"))
    text = F.when(F.col("d") % 50 == 0, F.lit("")).when(F.col("d") % 50 == 1, F.lit(None)).otherwise(F.col("text"))
    name = F.concat(F.when(F.col("d") % 3 == 0, "a.").otherwise("b."), F.col("d"))
    texts.select("d", name.alias("doc_name"), text.alias("text")).write.parquet(path)
    return spark.read.parquet(path)


def sides(spark, limit):
    words = [f"w{i}" for i in range(90) if i % 7]
    terms = spark.createDataFrame([(i, w) for i, w in enumerate(words, 1)], "term_id bigint, term string")
    names = [(i, ("a." if i % 3 == 0 else "b.") + str(i)) for i in range(1, 280)]
    docs = spark.createDataFrame(names, "doc_id bigint, doc_name string")
    return Dictionary(terms, limit), Dictionary(docs, limit)


def equal_to_one_run(store, corpus, terms, docs):
    run = TermStatistics(corpus, terms, docs)
    same(store.counts, run.counts)
    same(store.totals, run.totals)
    same(store.term_stats, C.term_stats(run.counts))
    same(store.corpus_size, run.corpus_size)
    same(store.kept(terms=terms), run.kept)
    weights = store.tfidf(terms=terms, docs=docs)
    same(weights, run.tfidf)
    same(L.avg_tfidf_by_class(weights, docs, terms), run.class_averages)
    run.close()


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_batches_equal_one_run(spark, corpus, out, limit):
    terms, docs = sides(spark, limit)
    store = CountStore(spark, out, limit)
    for k in range(3):
        store.add_corpus(corpus.where(F.col("d") % 3 == k), terms, docs)
    equal_to_one_run(store, corpus, terms, docs)
    # Replaced by other texts, then by the right ones; a removed batch, added again.
    wrong = corpus.where("d % 10 < 4").withColumn("text", F.concat_ws(" ", "text", F.lit("w1 w2 w999")))
    store.add_corpus(wrong, terms, docs)
    assert sorted(store.counts.collect()) != sorted(TermStatistics(corpus, terms, docs).counts.collect())
    store.add_corpus(corpus.where("d % 10 < 4"), terms, docs)
    store.remove(corpus.where("d % 5 = 1").select(F.col("doc_name").alias("doc_key")))
    equal_to_one_run(store, corpus.where("d % 5 <> 1"), terms, docs)
    store.compact()
    assert len(store.batches()) == 1
    store.prune()
    equal_to_one_run(store, corpus.where("d % 5 <> 1"), terms, docs)
    store.add_corpus(corpus.where("d % 5 = 1"), terms, docs)
    equal_to_one_run(store, corpus, terms, docs)


def test_a_batch_that_dies_changes_nothing(spark, corpus, out):
    terms, docs = sides(spark, 64 << 20)
    store = CountStore(spark, out)
    store.add_corpus(corpus.where("d < 100"), terms, docs)
    before, n = store.counts.collect(), store.corpus_size.first()[0]
    fails = spark.range(10).select(
        F.lit(1).cast("bigint").alias("term_id"),
        F.raise_error(F.lit("lost")).cast("bigint").alias("doc_id"),
        F.lit(1).cast("bigint").alias("freq"),
    )
    with pytest.raises(Exception, match="lost"):
        store.add(fails, corpus.select(F.col("doc_name").alias("doc_key"), F.lit(1).cast("bigint").alias("doc_id")))
    assert sorted(store.counts.collect()) == sorted(before) and store.corpus_size.first()[0] == n
    store.prune()
    assert sorted(store.counts.collect()) == sorted(before)
    assert len([f for f in os.listdir(out) if f.startswith("docs-")]) == 1


def test_empty_stores_and_batches(spark, out):
    terms, docs = sides(spark, 64 << 20)
    store = CountStore(spark, out)
    assert store.counts.isEmpty() and store.term_stats.isEmpty() and store.corpus_size.first()[0] == 0
    assert store.tfidf(terms=terms, docs=docs).isEmpty()
    store.compact()
    store.remove(spark.createDataFrame([("a.3",)], "doc_key string"))
    store.add_corpus(spark.createDataFrame([], CORPUS), terms, docs)
    assert store.counts.isEmpty() and store.corpus_size.first()[0] == 0
    texts = spark.createDataFrame([("a.3", "w1 w1"), ("a.3", "w2"), (None, "w1"), ("x.900", "w1")], CORPUS)
    store.add_corpus(texts, terms, docs)
    assert sorted(map(tuple, store.counts.collect())) == [(1, 3, 2), (2, 3, 1)]
    assert store.corpus_size.first()[0] == 2
    store.remove(spark.createDataFrame([("a.3",), ("a.3",), ("none",), (None,)], "doc_key string"))
    assert store.counts.isEmpty() and store.term_stats.isEmpty() and store.corpus_size.first()[0] == 1
