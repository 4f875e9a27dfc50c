"""What the physical plans must and must not contain."""

import re

import pytest

from catalog import fixtures as X
from catalog.queries import QUERIES
from termloom.operators import counts as C
from termloom.operators import tokens as T
from termloom.operators.lookup import Dictionary

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = plan_of(df)
    return text[: text.index("Initial Plan")]


@pytest.fixture(scope="module")
def run(spark):
    return X.statistics(spark, SF_DIR)


@pytest.fixture(scope="module")
def big_run(spark):
    """The same run with dictionaries that may not be broadcast."""
    base = X.statistics(spark, SF_DIR)
    base.terms = Dictionary(base.terms.df, 0)
    base.docs = Dictionary(base.docs.df, 0)
    return base


def test_no_python_in_any_plan(spark):
    for name, build in QUERIES.items():
        assert not re.search(r"Python|Pandas|Arrow", plan_of(build(spark, SF_DIR))), name


def test_scans_are_pruned(run):
    text = plan_of(run.tfidf)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "lang" not in re.sub(r"/\S+", "", text)
    size = plan_of(run.corpus_size)
    assert "ReadSchema: struct<doc_id:bigint>" in size


def test_counts_are_combined_before_the_shuffle(run):
    assert "partial_count" in plan_of(run.counts)


def test_totals_form_no_pairs(run):
    text = plan_of(run.totals)
    assert "hashpartitioning(term_id" in text
    assert not re.search(r"hashpartitioning\(term_id#\d+L, doc_id", text)


@pytest.mark.parametrize("result", ["kept", "frequencies", "tfidf", "report"])
def test_matrix_is_counted_once(run, result):
    text = final_plan_of(getattr(run, result))
    assert len(re.findall(r"Generate explode", text)) == 1
    assert "ReusedExchange" in text


@pytest.mark.parametrize("result", ["frequencies", "tfidf"])
def test_matrix_is_exchanged_once_and_no_document_is_a_window(run, result):
    text = final_plan_of(getattr(run, result))
    # Of all exchanges only the one that counts has a row per term and document.
    keys = set(re.findall(r"hashpartitioning\((.*?), \d+\), \w+, \[plan_id", text))
    keys = {re.sub(r"#\d+L?", "", k) for k in keys}
    assert sum("term_id" in k and "doc_id" in k for k in keys) == 1
    assert keys <= {"term_id, doc_id", "term_id", "doc_id", "src_id", "xxhash64(doc_id, text, 42)"}
    counting = [x for x in text.split("\n") if re.search(r"Exchange hashpartitioning\(term_id#\d+L, doc_id#\d+L", x)]
    assert len([x for x in counting if "ReusedExchange" not in x]) == 1
    assert "Window" not in text


def test_large_document_dictionary_is_joined_once(spark):
    base = X.statistics(spark, SF_DIR)
    base.docs = Dictionary(base.docs.df, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(base.tfidf)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert "explode(split" not in text and "src_id" not in re.sub(r"/\S+", "", text), "counts are read as stored"
    base.close()


def test_stop_words_leave_before_the_count(spark):
    base = X.statistics(spark, SF_DIR)
    base.terms = Dictionary(base.terms.df, 0)
    text = plan_of(C.word_doc_counts(base.corpus, base.docs, base.stopwords, doc_key="src_id"))
    partial, anti = text.index("partial_count"), text.index("LeftAnti")
    assert partial < anti, "operators below others are printed after them"


def test_texts_are_not_shuffled_unless_asked(spark):
    corpus = X.corpus(spark, SF_DIR).select("src_id", "text")
    assert "Exchange" not in plan_of(T.clean_tokens(corpus))
    assert "xxhash64(src_id" in plan_of(T.clean_tokens(corpus, partitions=4))


def test_beyond_broadcast_results_scan_stored_pairs(big_run):
    text = plan_of(big_run.tfidf)
    assert "explode(split" not in text
    assert len(re.findall(r"FileScan parquet \[term#", text)) <= 6


def test_top_lists_are_limited_early(run):
    assert "TakeOrderedAndProject" in plan_of(run.top_terms)
    text = plan_of(run.top_by_class())
    assert re.search(r"WindowGroupLimit .* Partial", text) and re.search(r"WindowGroupLimit .* Final", text)


def test_no_broadcast_beyond_the_limit(spark, big_run):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        texts = {"term": plan_of(big_run.kept), "doc_id": plan_of(big_run.tfidf)}
        pairs = plan_of(big_run._word_pairs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for key, text in texts.items():
        joins = re.findall(r"(\w+Join) \[(\w+)#\d+L?(?:, (salt)#\d+)?", text)
        assert ("SortMergeJoin", key, "salt") in joins
        # All that is broadcast is the list of hot keys, once for each side of the salted join.
        assert [j for j in joins if j[0] == "BroadcastHashJoin"] == [("BroadcastHashJoin", key, "")] * 2
    assert "Broadcast" not in pairs


def test_windows_are_partitioned(run):
    for result in (run.tfidf, run.report, run.kept, run.counts):
        for spec in re.findall(r"Window \[.*?\], (\[[^\]]*\])", plan_of(result)):
            assert spec != "[]"
