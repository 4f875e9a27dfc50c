"""The term-by-document count matrix and the filter on rare terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import TERM_CHARS
from termloom.operators.lookup import HEAVY_ITEMS, Dictionary, as_dictionary, frequent_items, salted_join, spread
from termloom.operators.tokens import clean_tokens, remove_stopwords, vocabulary
from termloom.session import materialize

MIN_TOTAL = 3


def _entries(dictionary: Dictionary, *columns: str) -> DataFrame:
    """Dictionary columns with the absence of nulls spelled out.

    Catalyst would otherwise infer it in some branches of a plan and not in others, and exchanges of
    branches that differ in a filter are not shared.
    """
    entries = dictionary.df.select(*columns)
    for column in columns:
        entries = entries.where(F.col(column).isNotNull())
    return entries


def _dictionary_texts(
    corpus: DataFrame, docs: Dictionary, doc_key: str, text: str, partitions: int
) -> tuple[DataFrame, str]:
    """Text rows with their document column, narrowed to dictionary documents where that is cheap.

    With a broadcast dictionary the rows are narrowed, and get their ``doc_id``, before any text is
    tokenized. Without one that join would shuffle raw text, so it waits until the tokens are counted.
    """
    texts, doc = corpus.select(doc_key, text), doc_key
    if docs.fits():
        texts = texts.join(F.broadcast(_entries(docs, doc_key, "doc_id")), doc_key).select("doc_id", text)
        doc = "doc_id"
    return spread(texts, partitions, doc, text), doc


def _with_doc_ids(counts: DataFrame, docs: Dictionary, doc: str, salted: bool = False) -> DataFrame:
    """``doc_id`` in place of the document key, unless the texts have it already.

    One row per document and term is left here. Terms of a dictionary that fits bound the rows of a document;
    of words from any text a document may have more, so they are written down and its rows cut (``salted``).
    """
    if doc == "doc_id":
        return counts
    if salted:
        return salted_join(materialize(counts, "words"), _entries(docs, doc, "doc_id"), doc).drop(doc)
    return counts.join(_entries(docs, doc, "doc_id"), doc).drop(doc)


def word_doc_counts(
    corpus: DataFrame,
    docs: Dictionary | DataFrame,
    stopwords: DataFrame | None = None,
    *,
    doc_key: str = "doc_name",
    text: str = "text",
    keep: str = TERM_CHARS,
    lowercase: bool = False,
    partitions: int = 0,
) -> DataFrame:
    """``(term, doc_id, freq)`` of every word that is no stop word, before any term dictionary.

    Stop words are the most frequent words of all, so they leave before anything is counted.
    """
    docs = as_dictionary(docs)
    texts, doc = _dictionary_texts(corpus, docs, doc_key, text, partitions)
    tokens = clean_tokens(texts, text, keep, lowercase)
    if stopwords is not None and (stops := as_dictionary(stopwords)).fits():
        tokens = remove_stopwords(tokens, stops)
    counts = tokens.groupBy("term", doc).agg(F.count(F.lit(1)).alias("freq"))
    return _with_doc_ids(counts, docs, doc, salted=True).select("term", "doc_id", "freq")


def term_doc_counts(
    corpus: DataFrame,
    terms: Dictionary | DataFrame,
    docs: Dictionary | DataFrame,
    stopwords: DataFrame | None = None,
    *,
    doc_key: str = "doc_name",
    text: str = "text",
    keep: str = TERM_CHARS,
    lowercase: bool = False,
    partitions: int = 0,
) -> DataFrame:
    """``(term_id, doc_id, freq)``: how often each dictionary term stands in each dictionary document.

    ``corpus`` has any number of rows per document. The only shuffle of the usual case is that of partial
    counts by (term, document), which no single term or document can skew. Words meet a dictionary beyond
    the broadcast limit after they are counted, in a salted join.
    """
    docs = as_dictionary(docs)
    vocab = vocabulary(terms, stopwords)
    if not vocab.fits():
        options = dict(doc_key=doc_key, text=text, keep=keep, lowercase=lowercase, partitions=partitions)
        pairs = materialize(word_doc_counts(corpus, docs, stopwords, **options), "pairs")
        return salted_join(pairs, _entries(vocab, "term", "term_id"), "term").select("term_id", "doc_id", "freq")
    texts, doc = _dictionary_texts(corpus, docs, doc_key, text, partitions)
    tokens = clean_tokens(texts, text, keep, lowercase)
    known = tokens.join(F.broadcast(_entries(vocab, "term", "term_id")), "term")
    counts = known.groupBy("term_id", doc).agg(F.count(F.lit(1)).alias("freq"))
    return _with_doc_ids(counts, docs, doc).select("term_id", "doc_id", "freq")


def corpus_term_totals(
    corpus: DataFrame,
    terms: Dictionary | DataFrame,
    docs: Dictionary | DataFrame,
    stopwords: DataFrame | None = None,
    *,
    doc_key: str = "doc_name",
    text: str = "text",
    keep: str = TERM_CHARS,
    lowercase: bool = False,
    partitions: int = 0,
) -> DataFrame:
    """``(term_id, total)`` straight from the tokens.

    The sum over documents of the counts is the number of tokens, so no (term, document) pair has to be
    formed or shuffled: what travels is one partial count per term and task. Only a document dictionary
    beyond the broadcast limit needs the pairs.
    """
    docs = as_dictionary(docs)
    vocab = vocabulary(terms, stopwords)
    options = dict(doc_key=doc_key, text=text, keep=keep, lowercase=lowercase, partitions=partitions)
    if not docs.fits():
        return term_totals(term_doc_counts(corpus, terms, docs, stopwords, **options))
    texts, _ = _dictionary_texts(corpus, docs, doc_key, text, partitions)
    tokens = clean_tokens(texts.select(text), text, keep, lowercase)
    total = F.count(F.lit(1)).alias("total")
    if vocab.fits():
        return tokens.join(F.broadcast(_entries(vocab, "term", "term_id")), "term").groupBy("term_id").agg(total)
    # Both sides have one row per word by now.
    words = tokens.groupBy("term").agg(total)
    return words.join(_entries(vocab, "term", "term_id"), "term").select("term_id", "total")


def top_term_totals(
    corpus: DataFrame,
    terms: Dictionary | DataFrame,
    docs: Dictionary | DataFrame,
    stopwords: DataFrame | None = None,
    k: int = 10,
    *,
    items: int = HEAVY_ITEMS,
    doc_key: str = "doc_name",
    text: str = "text",
    keep: str = TERM_CHARS,
    lowercase: bool = False,
    partitions: int = 0,
) -> DataFrame | None:
    """``(term_id, total)`` of all terms that can be among the ``k`` most frequent, totals exact; or None.

    A first look makes one summary of frequent words per task, which merge: of N words in all, each number in it is
    wrong by ``SUMMARY_ERROR * N / items`` at most, and a word that it lacks has no more than twice that. The words in
    it meet the dictionary; the k-th largest number among the known ones, less the error, is one that the k-th of
    all terms reaches. Words that cannot reach it are out. A second look counts the others: a task sends one number per
    candidate, not one per word.

    None says that the summary cannot decide: fewer than k known words stand out. So it is for texts whose top words
    are rare, and then all words have to be counted, see :func:`corpus_term_totals`. Documents beyond the
    broadcast limit cannot be told apart before words are counted and give None, too.
    """
    docs, terms = as_dictionary(docs), as_dictionary(terms)
    stops = None if stopwords is None else as_dictionary(stopwords)
    if not docs.fits() or (stops is not None and not stops.fits()):
        return None
    texts, _ = _dictionary_texts(corpus, docs, doc_key, text, partitions)
    tokens = clean_tokens(texts.select(text), text, keep, lowercase)
    if stops is not None:
        tokens = remove_stopwords(tokens, stops)
    found = frequent_items(tokens, "term", items)
    seen = corpus.sparkSession.createDataFrame(found.items, "term string, seen bigint")
    # At most ``items`` words against the whole dictionary, which stays where it is.
    known = _entries(terms, "term", "term_id").join(F.broadcast(seen), "term")
    known = known.orderBy(F.desc("seen"), "term").limit(items)
    listed = materialize(known.select("term", "term_id", "seen"), "candidates")
    kth = listed.orderBy(F.desc("seen")).select("seen").limit(k).agg(F.min("seen").alias("seen"), F.count(F.lit(1)).alias("n")).first()
    if kth["n"] < k or kth["seen"] - found.error <= found.missing:
        return None
    candidates = listed.where(F.col("seen") + found.error >= kth["seen"] - found.error).select("term", "term_id")
    return tokens.join(F.broadcast(candidates), "term").groupBy("term_id").agg(F.count(F.lit(1)).alias("total"))


def term_totals(matrix: DataFrame) -> DataFrame:
    """``(term_id, total)``: corpus total of each term of a count matrix."""
    return matrix.groupBy("term_id").agg(F.sum("freq").alias("total"))


def term_stats(matrix: DataFrame, by: str = "term_id") -> DataFrame:
    """``(term_id, total, df)``: corpus total and document frequency in one aggregate.

    The rare-term filter drops whole terms, so a kept term's ``df`` is the same before and after it.
    """
    return matrix.groupBy(by).agg(F.sum("freq").alias("total"), F.count(F.lit(1)).alias("df"))


def frequent_terms(totals: DataFrame, min_total: int | None = MIN_TOTAL) -> DataFrame:
    """Rows whose total is at least ``min_total``; all of them without one."""
    return totals if min_total is None else totals.where(F.col("total") >= min_total)


def rare_terms(totals: DataFrame, min_total: int = MIN_TOTAL) -> DataFrame:
    return totals.where(F.col("total") < min_total)


def _may_broadcast_stats(terms: Dictionary | None) -> bool:
    """Whether statistics of a few numbers per term are small, going by the dictionary of the matrix."""
    return terms is not None and terms.fits_per_row(4 * 8)


def reusable(matrix: DataFrame, terms: Dictionary | None) -> DataFrame:
    """The matrix itself where one plan can use it several times, else a stored copy.

    With broadcast statistics the aggregate and the join share the exchange that counted the matrix.
    """
    return matrix if _may_broadcast_stats(terms) else materialize(matrix, "matrix")


def join_term_stats(
    matrix: DataFrame, stats: DataFrame, terms: Dictionary | None = None, by: str = "term_id"
) -> DataFrame:
    """Matrix rows with the columns of ``stats``, one row per term there, whose ``df`` counts matrix rows.

    ``terms`` is the dictionary the matrix was built with and bounds the number of statistics; with it small
    enough they are broadcast and the matrix is not shuffled. Otherwise frequent terms are salted.
    """
    if _may_broadcast_stats(terms):
        return matrix.join(F.broadcast(stats), by)
    stats = materialize(stats, "stats")
    return salted_join(matrix, stats, by, rows_per_key=stats.select(by, F.col("df").alias("n")))


def low_frequency_filter(
    matrix: DataFrame, min_total: int | None = MIN_TOTAL, terms: Dictionary | None = None
) -> DataFrame:
    """Matrix rows of terms that occur at least ``min_total`` times in the corpus."""
    matrix = reusable(matrix, terms)
    kept = frequent_terms(term_stats(matrix), min_total)
    return join_term_stats(matrix, kept, terms).select("term_id", "doc_id", "freq")


def dedupe_triples(matrix: DataFrame) -> DataFrame:
    """A foreign matrix with repeated (term, document) entries summed."""
    return matrix.groupBy("term_id", "doc_id").agg(F.sum("freq").alias("freq"))
