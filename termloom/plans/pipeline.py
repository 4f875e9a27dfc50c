"""The five result sets of a labelled corpus, as one object of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import TERM_CHARS
from termloom.operators import counts as C
from termloom.operators import toplists as L
from termloom.operators import weights as W
from termloom.operators.lookup import BROADCAST_LIMIT, Dictionary, as_dictionary, hot_keys, salted_join
from termloom.operators.tokens import decode_documents, vocabulary
from termloom.session import Scratch, materialize, scratch_root
from termloom.sinks.text import write_matrix, write_per_document, write_rows
from termloom.sources.corpus import count_corpus_files, read_corpus
from termloom.sources.dictionary import load_doc_dictionary, load_stopwords, load_term_dictionary


def _scoped(method):
    """What a method writes down is deleted by ``close``."""

    @wraps(method)
    def within(self, *args, **kwargs):
        with self._scratch:
            return method(self, *args, **kwargs)

    return within


@dataclass
class TermStatistics:
    """A corpus with its dictionaries; each attribute below is a result of that corpus.

    ``corpus`` has the document key and ``text``; ``doc_key`` is also a column of ``docs``. ``n_docs`` is a
    one-row DataFrame that replaces the number of documents scanned. ``partitions`` deals the texts to so many
    tasks before they are taken apart, for inputs of few files; by default they stay where they are scanned.

    Attributes measure dictionaries when they are asked for, and with a dictionary beyond its broadcast limit
    they run jobs and write tables then. ``close`` deletes those tables; results may not be used after it.
    """

    corpus: DataFrame
    terms: Dictionary
    docs: Dictionary
    stopwords: DataFrame | None = None
    doc_key: str = "doc_name"
    n_docs: DataFrame | None = None
    min_total: int | None = C.MIN_TOTAL
    keep: str = TERM_CHARS
    lowercase: bool = False
    smooth: bool = True
    top: int = L.TOP_TERMS
    top_per_class: int = L.TOP_PER_CLASS
    report_format: str | None = None
    partitions: int = 0
    _stored: DataFrame | None = field(default=None, init=False, repr=False)
    _scratch: Scratch = field(default_factory=Scratch, init=False, repr=False)

    def __post_init__(self):
        self.terms = as_dictionary(self.terms)
        self.docs = as_dictionary(self.docs)
        scratch_root(self.corpus.sparkSession)  # large dictionaries need it: better to know now

    @classmethod
    def from_files(
        cls,
        spark: SparkSession,
        corpus: str,
        terms: str,
        docs: str,
        stopwords: str,
        broadcast_limit: int = BROADCAST_LIMIT,
        **options,
    ):
        """Class folders of text files, two dictionary files and a stop list."""
        options.setdefault("n_docs", count_corpus_files(spark, corpus))
        with Scratch() as scratch:
            run = cls(
                read_corpus(spark, corpus),
                load_term_dictionary(spark, terms, broadcast_limit),
                load_doc_dictionary(spark, docs, broadcast_limit),
                load_stopwords(spark, stopwords),
                **options,
            )
        run._scratch.paths.extend(scratch.paths)
        return run

    def close(self) -> None:
        """Delete what was written down for this run."""
        self._scratch.close()

    @property
    def _inputs(self) -> tuple:
        return self.corpus, self.terms, self.docs, self.stopwords

    @property
    def _options(self) -> dict:
        return {
            "doc_key": self.doc_key,
            "keep": self.keep,
            "lowercase": self.lowercase,
            "partitions": self.partitions,
        }

    # A term dictionary beyond the broadcast limit: words are counted and written down first, their
    # statistics meet the dictionary (one row per word on both sides), and a single salted join takes
    # ids, filter and weights back to the word counts.

    @cached_property
    @_scoped
    def _word_pairs(self) -> DataFrame:
        words = C.word_doc_counts(self.corpus, self.docs, self.stopwords, **self._options)
        return materialize(words, "pairs")

    @cached_property
    @_scoped
    def _word_stats(self) -> DataFrame:
        known = vocabulary(self.terms, self.stopwords).df.select("term", "term_id")
        return materialize(C.term_stats(self._word_pairs, "term").join(known, "term"), "stats")

    @cached_property
    @_scoped
    def _hot_words(self) -> DataFrame:
        return hot_keys(self._word_stats.select("term", F.col("df").alias("n")), "term")

    def _rows_with(self, stats: DataFrame) -> DataFrame:
        return salted_join(self._word_pairs, stats, "term", hot=self._hot_words)

    @property
    @_scoped
    def counts(self) -> DataFrame:
        """``(term_id, doc_id, freq)``."""
        if self._stored is not None:
            return self._stored
        if not self.terms.fits():
            return self._rows_with(self._word_stats).select("term_id", "doc_id", "freq")
        counts = C.term_doc_counts(*self._inputs, **self._options)
        if not self.docs.fits():
            # Documents are joined here; what uses the counts several times must not join them again.
            counts = self._stored = materialize(counts, "counts")
        return counts

    @_scoped
    def store_counts(self) -> None:
        """Write the counts down once, for several results in a row."""
        if not self.terms.fits():
            self._word_stats  # noqa: B018 - stored by being asked for
        elif self._stored is None:
            counts = self.counts
            self._stored = counts if self._stored is not None else materialize(counts, "counts")

    @cached_property
    def corpus_size(self) -> DataFrame:
        if self.n_docs is not None:
            return self.n_docs
        return W.corpus_size(self.corpus, "src_id" if "src_id" in self.corpus.columns else self.doc_key)

    @property
    @_scoped
    def totals(self) -> DataFrame:
        """``(term_id, total)``."""
        if self._stored is not None:
            return C.term_totals(self._stored)
        # With neither dictionary small the words have to be counted by document anyway.
        if "_word_stats" in self.__dict__ or not (self.terms.fits() or self.docs.fits()):
            return self._word_stats.select("term_id", "total")
        if not self.docs.fits():
            return C.term_totals(self.counts)
        return C.corpus_term_totals(*self._inputs, **self._options)

    @property
    @_scoped
    def kept(self) -> DataFrame:
        """``(term_id, doc_id, freq)`` without rare terms."""
        if not self.terms.fits():
            kept = self._rows_with(C.frequent_terms(self._word_stats, self.min_total))
            return kept.select("term_id", "doc_id", "freq")
        return C.low_frequency_filter(self.counts, self.min_total, self.terms)

    @property
    @_scoped
    def frequencies(self) -> DataFrame:
        """``(term_id, doc_id, tf)``."""
        return W.term_weight_tf(self.kept, self.docs, self.terms)

    @property
    def top_terms(self) -> DataFrame:
        """``(rk, term, frequency)``."""
        return self.top_terms_of(self.top)

    @_scoped
    def top_terms_of(self, k: int) -> DataFrame:
        totals = self._top_totals(k)
        return L.top_terms(C.frequent_terms(self.totals if totals is None else totals, self.min_total), self.terms, k)

    def _top_totals(self, k: int) -> DataFrame | None:
        """Totals of candidates alone, where a large vocabulary would have all its words counted for the list."""
        if self.terms.fits() or self._stored is not None or "_word_stats" in self.__dict__:
            return None
        return C.top_term_totals(*self._inputs, k=k, **self._options)

    @property
    @_scoped
    def tfidf(self) -> DataFrame:
        """``(term_id, doc_id, tfidf)``."""
        if not self.terms.fits():
            kept = C.frequent_terms(self._word_stats, self.min_total)
            rows = self._rows_with(W.idf(kept, self.corpus_size, self.smooth))
            return W.weigh(rows.select("term_id", "doc_id", "freq", "idf"), self.docs, self.terms)
        return W.tfidf(self.counts, self.corpus_size, self.min_total, self.terms, self.smooth, self.docs)

    @property
    @_scoped
    def class_averages(self) -> DataFrame:
        """``(class, term, avg_tfidf)``."""
        return L.avg_tfidf_by_class(self.tfidf, self.docs, self.terms)

    @_scoped
    def top_by_class(self, k: int | None = None) -> DataFrame:
        """``(class, rk, term, avg_tfidf)``."""
        return L.top_terms_by_class(self.class_averages, k or self.top_per_class)

    @property
    def report(self) -> DataFrame:
        """``(class, top_terms)``."""
        return L.class_report(self.top_by_class(), self.report_format)

    @_scoped
    def write_per_document(self, path: str) -> None:
        """Counts as one folder per document."""
        if not self.docs.fits():
            self.store_counts()  # the lookup of names reads them twice
        write_per_document(decode_documents(self.counts, self.docs), path)

    @_scoped
    def write_all(self, out: str, ordered: bool = False) -> None:
        """The five results as text below ``out``; the corpus is read once."""
        self.store_counts()
        out = out.rstrip("/")
        write_matrix(self.counts, f"{out}/term_frequency", ordered)
        write_matrix(self.kept, f"{out}/low_frequency", ordered)
        write_rows(self.top_terms.select("term", "frequency"), f"{out}/top_frequency")
        write_matrix(self.tfidf, f"{out}/tfidf", ordered)
        write_rows(self.report, f"{out}/top_avg_tfidf")
