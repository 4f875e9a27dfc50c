"""Top terms overall and by class, and the class report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.sums import exact_sum
from termloom.functions.text import class_of
from termloom.operators.lookup import Dictionary, as_dictionary, lookup
from termloom.operators.tokens import decode_terms
from termloom.session import materialize

TOP_TERMS = 10
TOP_PER_CLASS = 5


def top_terms(totals: DataFrame, terms: Dictionary | DataFrame, k: int = TOP_TERMS) -> DataFrame:
    """``(rk, term, frequency)``: the ``k`` largest totals, listed in ascending order.

    Equal totals are ordered by term. ``rk`` is numbered after the limit, over ``k`` rows.
    """
    terms = as_dictionary(terms)
    words = terms.df.select("term_id", "term")
    # One row per term on both sides, so nothing can be skewed.
    named = totals.join(F.broadcast(words) if terms.fits() else words, "term_id")
    best = named.select("term", F.col("total").alias("frequency")).orderBy(F.desc("frequency"), "term").limit(k)
    rank = F.row_number().over(Window.orderBy("frequency", F.desc("term")))
    return best.select(rank.alias("rk"), "term", "frequency").orderBy("rk")


def doc_classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, class)`` of a document dictionary."""
    return docs.select("doc_id", class_of(F.col("doc_name")).alias("class"))


def class_sizes(docs: DataFrame) -> DataFrame:
    """``(class, n_docs)`` counted in the document dictionary, documents without kept terms included."""
    return doc_classes(docs).groupBy("class").agg(F.count(F.lit(1)).alias("n_docs"))


def sum_tfidf_by_class(weights: DataFrame, docs: Dictionary | DataFrame) -> DataFrame:
    """``(class, term_id, sum_tfidf)``; weights of unknown documents are dropped.

    Sums are exact before they are rounded, so they, and ranks by them, are the same however rows are dealt.
    """
    docs = as_dictionary(docs)
    classes = doc_classes(docs.df)
    # Beyond the broadcast limit both sides meet on doc_id, where a document has at most one row per
    # dictionary term and where the weights are partitioned already.
    labelled = weights.join(F.broadcast(classes) if docs.fits() else classes, "doc_id")
    return labelled.groupBy("class", "term_id").agg(exact_sum(F.col("tfidf")).alias("sum_tfidf"))


def avg_tfidf_by_class(
    weights: DataFrame, docs: Dictionary | DataFrame, terms: Dictionary | DataFrame
) -> DataFrame:
    """``(class, term, avg_tfidf)``: the sum over a class divided by all its dictionary documents."""
    docs, terms = as_dictionary(docs), as_dictionary(terms)
    sums = sum_tfidf_by_class(weights, docs)
    if not terms.fits():
        sums = materialize(sums, "sums")
    sums = decode_terms(sums, terms)
    sizes = docs.summary(class_sizes(docs.df))  # a class name is the beginning of a document name
    return lookup(sums, sizes, "class").select(
        "class", "term", (F.col("sum_tfidf") / F.col("n_docs")).alias("avg_tfidf")
    )


def top_terms_by_class(averages: DataFrame, k: int = TOP_PER_CLASS) -> DataFrame:
    """``(class, rk, term, avg_tfidf)``: the ``k`` largest averages of each class, best first.

    The rank limit is applied inside each task before the shuffle, so a class of any size sends at most
    ``k`` rows per task to its window. Equal averages are ordered by term.
    """
    order = Window.partitionBy("class").orderBy(F.desc("avg_tfidf"), "term")
    return (
        averages.withColumn("rk", F.row_number().over(order))
        .where(F.col("rk") <= k)
        .select("class", "rk", "term", "avg_tfidf")
    )


def class_report(top: DataFrame, number_format: str | None = None) -> DataFrame:
    """``(class, top_terms)``: one line ``term:value, term:value, …`` per class, best first.

    Values are whole doubles unless a ``number_format`` such as ``%.6f`` is given.
    """

    def value(number: Column) -> Column:
        return number.cast("string") if number_format is None else F.format_string(number_format, number)

    entry = F.struct("rk", "term", "avg_tfidf")
    listed = top.groupBy("class").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    shown = F.transform("entries", lambda e: F.concat(e.term, F.lit(":"), value(e.avg_tfidf)))
    return listed.select("class", F.array_join(shown, ", ").alias("top_terms"))
