"""From text rows to term rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import TERM_CHARS, clean_text, split_tokens
from termloom.operators.lookup import Dictionary, as_dictionary, lookup, lookup_texts, spread


def _explode(texts: DataFrame, text: str, tokens: Column, name: str, partitions: int, place: str | None) -> DataFrame:
    others = [c for c in texts.columns if c != text]
    if place is None:
        rows = spread(texts, partitions, *texts.columns)
        return rows.select(*others, F.explode(tokens).alias(name)).where(F.col(name) != "")
    # Rows are numbered where they are scanned, which gives the same numbers when a task runs again.
    numbered = texts.withColumn(place, F.monotonically_increasing_id())
    rows = spread(numbered, partitions, *numbered.columns)
    found = rows.select(*others, place, F.posexplode(tokens).alias("nth", name)).where(F.col(name) != "")
    return found.select(*others, F.xxhash64(place, "nth").alias(place), name)


def tokenize(texts: DataFrame, text: str = "text", partitions: int = 0, place: str | None = None) -> DataFrame:
    """One row per whitespace-delimited token, the other columns kept.

    ``partitions`` deals the texts to so many tasks first, for inputs of few files; by all columns, so the lines
    of one document go to many. ``place`` names a column more that tells equal tokens apart, for ``slice_by``
    of lookups beyond the broadcast limit; ``texts`` has to be a scan then.
    """
    return _explode(texts, text, split_tokens(F.col(text)), "token", partitions, place)


def clean_tokens(
    texts: DataFrame,
    text: str = "text",
    keep: str = TERM_CHARS,
    lowercase: bool = False,
    partitions: int = 0,
    place: str | None = None,
) -> DataFrame:
    """One row per non-empty cleaned token, in column ``term``; options as for :func:`tokenize`."""
    return _explode(texts, text, split_tokens(clean_text(F.col(text), keep, lowercase)), "term", partitions, place)


def remove_stopwords(tokens: DataFrame, stopwords: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Exact match, case kept; applied to cleaned tokens."""
    return lookup(tokens, stopwords, "term", "left_anti", slice_by)


def vocabulary(terms: Dictionary | DataFrame, stopwords: DataFrame | None) -> Dictionary:
    """The term dictionary less the stop words.

    A token counts when it is in the dictionary and not in the stop list, so taking the stop words out of
    the dictionary once spares a second lookup for every token.
    """
    terms = as_dictionary(terms)
    return terms if stopwords is None else terms.without(stopwords, "term")


def known_terms(tokens: DataFrame, terms: Dictionary | DataFrame, slice_by: str | None = None) -> DataFrame:
    """Tokens found in the term dictionary."""
    return lookup(tokens, terms, "term", "left_semi", slice_by)


def out_of_vocabulary(tokens: DataFrame, terms: Dictionary | DataFrame, slice_by: str | None = None) -> DataFrame:
    """Tokens missing from the term dictionary."""
    return lookup(tokens, terms, "term", "left_anti", slice_by)


def known_documents(corpus: DataFrame, docs: Dictionary | DataFrame, doc_key: str = "doc_name") -> DataFrame:
    """Corpus rows whose document is in the document dictionary; texts stay where they are."""
    return lookup_texts(corpus, docs, doc_key, "left_semi")


def encode_terms(tokens: DataFrame, terms: Dictionary | DataFrame, slice_by: str | None = None) -> DataFrame:
    """``term_id`` added by term; unknown terms dropped."""
    return lookup(tokens, as_dictionary(terms).select("term", "term_id"), "term", slice_by=slice_by)


def encode_documents(
    rows: DataFrame, docs: Dictionary | DataFrame, doc_key: str = "doc_name"
) -> DataFrame:
    """``doc_id`` added by document name (or another unique key); unknown documents dropped.

    Texts stay where they are unless the known documents alone are beyond the broadcast limit.
    """
    return lookup_texts(rows, as_dictionary(docs).select(doc_key, "doc_id"), doc_key)


def decode_terms(rows: DataFrame, terms: Dictionary | DataFrame) -> DataFrame:
    """``term`` added by ``term_id``; unknown ids dropped, see :func:`unknown_terms`."""
    return lookup(rows, as_dictionary(terms).select("term_id", "term"), "term_id")


def decode_documents(rows: DataFrame, docs: Dictionary | DataFrame) -> DataFrame:
    """``doc_name`` added by ``doc_id``; unknown ids dropped, see :func:`unknown_documents`."""
    return lookup(rows, as_dictionary(docs).select("doc_id", "doc_name"), "doc_id")


def unknown_terms(rows: DataFrame, terms: Dictionary | DataFrame, slice_by: str | None = None) -> DataFrame:
    return lookup(rows, terms, "term_id", "left_anti", slice_by)


def unknown_documents(rows: DataFrame, docs: Dictionary | DataFrame, slice_by: str | None = None) -> DataFrame:
    return lookup(rows, docs, "doc_id", "left_anti", slice_by)
