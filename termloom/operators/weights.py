"""Term weights: tf, df, idf and tf-idf."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.scores import inverse_document_frequency, term_frequency
from termloom.operators.counts import MIN_TOTAL, frequent_terms, join_term_stats, reusable, term_stats
from termloom.operators.lookup import Dictionary, salted_join
from termloom.session import materialize


def corpus_size(corpus: DataFrame, doc_key: str = "src_id") -> DataFrame:
    """``(n_docs)``, one row: documents of the raw corpus, in a dictionary or not."""
    return corpus.agg(F.count_distinct(doc_key).alias("n_docs"))


def doc_lengths(kept: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens)``: kept tokens of each document."""
    return kept.groupBy("doc_id").agg(F.sum("freq").alias("n_tokens"))


def document_frequency(kept: DataFrame) -> DataFrame:
    """``(term_id, df)``; (term, document) is unique in a count matrix, so rows are documents."""
    return kept.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))


def term_weight_tf(kept: DataFrame, docs: Dictionary | None = None, terms: Dictionary | None = None) -> DataFrame:
    """``(term_id, doc_id, tf)``: share of the document's kept tokens.

    ``docs`` is the dictionary the matrix was built with; with it and ``terms`` small enough the matrix is not
    shuffled for this, else it is written down.
    """
    return _with_tf(kept, docs, terms).select("term_id", "doc_id", "tf")


def _with_tf(kept: DataFrame, docs: Dictionary | None, terms: Dictionary | None) -> DataFrame:
    """Rows with ``tf``. Lengths are one number per document: an aggregate over the counts' own exchange,
    broadcast where the dictionary bounds them, else joined with long documents cut into slices."""
    if docs is not None and docs.fits_per_row(2 * 8):
        kept = kept if docs.fits() and (terms is None or terms.fits_per_row(4 * 8)) else materialize(kept, "kept")
        rows = kept.join(F.broadcast(doc_lengths(kept)), "doc_id")
    else:
        kept = materialize(kept, "kept")
        count = F.count(F.lit(1)).alias("n")
        lengths = materialize(kept.groupBy("doc_id").agg(F.sum("freq").alias("n_tokens"), count), "lengths")
        rows_per_key = lengths.select("doc_id", "n")
        rows = salted_join(kept, lengths.drop("n"), "doc_id", rows_per_key=rows_per_key)
    return rows.withColumn("tf", term_frequency(F.col("freq"), F.col("n_tokens")))


def weigh(kept: DataFrame, docs: Dictionary | None = None, terms: Dictionary | None = None) -> DataFrame:
    """``(term_id, doc_id, tfidf)`` of kept matrix rows that carry the ``idf`` of their term."""
    weighted = _with_tf(kept, docs, terms)
    return weighted.select("term_id", "doc_id", (F.col("tf") * F.col("idf")).alias("tfidf"))


def idf(stats: DataFrame, n_docs: DataFrame, smooth: bool = True) -> DataFrame:
    """``stats`` with an ``idf`` column; ``n_docs`` is the one-row corpus size."""
    weight = inverse_document_frequency(F.col("n_docs"), F.col("df"), smooth)
    one_row = n_docs.agg(F.max("n_docs").alias("n_docs"))
    return stats.crossJoin(F.broadcast(one_row)).withColumn("idf", weight).drop("n_docs")


def tfidf(
    matrix: DataFrame,
    n_docs: DataFrame,
    min_total: int | None = MIN_TOTAL,
    terms: Dictionary | None = None,
    smooth: bool = True,
    docs: Dictionary | None = None,
) -> DataFrame:
    """``(term_id, doc_id, tfidf)`` of the terms with a corpus total of at least ``min_total``, or of all.

    Filter and idf come from one aggregate per term and reach the matrix in one join; the weight is
    computed once per term. A matrix filtered before may be passed with the same or a lower threshold.
    """
    matrix = reusable(matrix, terms)
    stats = idf(frequent_terms(term_stats(matrix), min_total), n_docs, smooth).select("term_id", "df", "idf")
    return weigh(join_term_stats(matrix, stats, terms), docs, terms)
