"""Lookups beyond the broadcast limit: heavy keys seen in the scan, filters of keys, texts that stay."""

import re

import pytest
from pyspark.sql import functions as F

from termloom.operators import lookup as J
from termloom.operators import tokens as T
from termloom.operators.filters import BITMAP_BITS, KeyFilter
from termloom.operators.lookup import Dictionary


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    assert a.columns == b.columns
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


# --- heavy keys


def skewed(spark, n=30_000):
    third = F.when(F.col("id") % 3 == 0, F.lit("the")).when(F.col("id") % 4 == 0, F.lit("of"))
    key = third.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("w"), F.col("id") % 9000))
    return spark.range(n).select(key.alias("term"), "id")


def test_heavy_keys_are_those_counted(spark):
    rows = skewed(spark)
    counted = J.hot_keys(rows.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term").where("term IS NOT NULL")
    stored, seen = J.stored_with_heavy_keys(rows, "term", "rows")
    wanted = {r["term"]: r["salts"] for r in counted.collect()}
    for found in (seen, J.heavy_keys(rows, "term")):
        got = {r["term"]: r["salts"] for r in found.collect()}
        assert set(got) == set(wanted) == {"the", "of"}
        assert all(abs(got[k] - wanted[k]) <= 1 for k in got)
    same(stored, rows)


def test_heavy_keys_of_nothing_and_of_other_types(spark):
    none = spark.createDataFrame([], "k string, v int")
    stored, seen = J.stored_with_heavy_keys(none, "k", "rows")
    assert stored.isEmpty() and seen.isEmpty() and J.heavy_keys(none, "k").isEmpty()
    for cast in ("binary", "date", "decimal(20,2)", "int", "bigint"):
        key = F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id"))
        key = F.date_add(F.lit("2000-01-01"), key.cast("int")) if cast == "date" else key.cast("string" if cast == "binary" else cast)
        rows = spark.range(4000).select(key.cast(cast).alias("k"), "id")
        assert J.heavy_keys(rows, "k").count() == 1, cast
        assert J.stored_with_heavy_keys(rows, "k", "rows")[1].count() == 1, cast


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_one_tokenizing_pass(spark, plain, monkeypatch, how):
    """The only plan that takes texts apart is that of the stored tokens; the join reads those."""
    stored = []
    keep = J.materialize

    def watched(df, label):
        stored.append((label, plan_of(df)))
        return keep(df, label)

    monkeypatch.setattr(J, "materialize", watched)
    texts = skewed(spark, 3000).select("id", F.concat_ws(" ", "term", F.lit("the end of it")).alias("text"))
    tokens = T.clean_tokens(texts)
    terms = spark.createDataFrame([("the", 1), ("of", 2), ("w5", 3), ("none", 4)], "term string, term_id bigint")
    found = J.lookup(tokens, Dictionary(terms, 0), "term", how)
    assert [label for label, _ in stored] == ["looked"]
    assert len(re.findall("Generate explode", stored[0][1])) == 1 and "CollectMetrics" in stored[0][1]
    assert "Generate explode(split" not in plan_of(found)
    same(found, tokens.join(terms if how == "inner" else terms.select("term"), "term", how))


def test_rows_without_a_key_are_cut(spark, plain):
    rows = spark.range(8000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), "id")
    small = spark.range(100).select(F.col("id").alias("k"))
    joined = J.salted_join(rows, small, "k", "left_anti")
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 8000 - 25 and max(sizes) < sum(sizes) / 3


# --- filters


@pytest.mark.parametrize("max_bytes", [1, 1 << 20])
def test_filter_lets_all_keys_pass_and_few_others(spark, max_bytes):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") * 2).alias("k"))
    rows = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("k"), "id").union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    made = KeyFilter.of(keys, "k", 20_000, max_bytes)
    assert made.size % BITMAP_BITS == 0 and made.bitmaps.count() <= made.size // BITMAP_BITS
    passed = made.passing(rows, "k")
    assert passed.columns == ["k", "id"]
    assert rows.join(keys, "k", "left_semi").join(passed, "k", "left_anti").isEmpty()
    wrong = passed.join(keys, "k", "left_anti").count()
    assert passed.where("k IS NULL").isEmpty() and passed.count() == passed.select("id").distinct().count()
    assert wrong < 0.04 * 40_000 if max_bytes > 1 else wrong < 40_000


def test_filter_of_nothing(spark):
    made = KeyFilter.of(spark.createDataFrame([], "k string"), "k", 0)
    assert made.passing(spark.createDataFrame([("a",), (None,)], "k string"), "k").isEmpty()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts") / "corpus")
    name = F.when(F.col("id") % 3 == 0, F.lit("d1")).when(F.col("id") % 5 > 0, F.concat(F.lit("d"), "id"))
    spark.range(3000).select(name.alias("doc_name"), F.concat(F.lit("text of "), "id").alias("text")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(0, 9000, 3).select(F.concat(F.lit("d"), F.col("id") + 1).alias("doc_name"), F.col("id").alias("doc_id"))


# Known documents fit; only the strays do; nothing does.
@pytest.mark.parametrize("limit", [40_000, 4_000, 0])
def test_texts_meet_large_dictionaries(spark, plain, corpus, names, limit):
    docs = Dictionary(names, limit)
    assert not docs.fits()
    same(T.known_documents(corpus, docs), corpus.join(names.select("doc_name"), "doc_name", "left_semi"))
    same(T.encode_documents(corpus, docs), corpus.join(names, "doc_name"))


def test_no_exchange_carries_text(spark, plain, corpus, names):
    for limit in (40_000, 4_000):
        docs = Dictionary(names, limit)
        plan = plan_of(T.known_documents(corpus, docs))
        assert "text#" in plan and not re.search(r"(?m)\bExchange (hash|range|single)", plan)
    assert not re.search(r"(?m)\bExchange (hash|range|single)", plan_of(T.encode_documents(corpus, Dictionary(names, 40_000))))
