"""name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import fixtures as X
from termloom.functions.text import class_of, doc_name_of, folder_of
from termloom.operators import counts as C
from termloom.operators import tokens as T
from termloom.operators import toplists as L
from termloom.operators import weights as W
from termloom.operators.buckets import BucketedDictionary
from termloom.plans.batches import CountStore
from termloom.session import scratch_path
from termloom.sinks import ranges
from termloom.sinks import text as sinks
from termloom.sources import corpus as corpora
from termloom.sources import dictionary as dictionaries
from termloom.sources import growth, triples

QUERIES = {}
# Tells equal rows apart, should a dictionary be too large to broadcast.
PLACE = "place"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 9))


def _paths(spark, sf_dir, extension: str) -> DataFrame:
    """Where each document would lie as a file of a class folder."""
    path = F.concat(F.lit("file:/corpus/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(extension))
    return X.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("src_id"), path.alias("path"))


# Sources


@query
def corpus_scan(spark, sf_dir):
    return X.corpus(spark, sf_dir)


@query
def doc_identity(spark, sf_dir):
    paths = _paths(spark, sf_dir, ".part.txt")
    return paths.select("src_id", doc_name_of(F.col("path")).alias("doc_name"), folder_of(F.col("path")).alias("class"))


@query
def dictionary_load(spark, sf_dir):
    # Far fewer names than lines: every repeated line moves the id of its name.
    path = scratch_path(spark, "dictionary")
    lines = X.table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(".", "lang", "source").alias("doc_name"))
    sinks.write_dictionary(lines, "doc_name", "doc_id", path)
    return dictionaries.load_ids(spark, path, "doc_name", "doc_id")


@query
def dictionary_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "dictionary")
    sinks.write_dictionary(X.terms(spark, sf_dir).df, "term", "term_id", path)
    return dictionaries.load_ids(spark, path, "term", "term_id")


@query
def dense_doc_ids(spark, sf_dir):
    return dictionaries.dense_ids(X.labelled_documents(spark, sf_dir), "src_id", "doc_id")


@query
def stopword_load(spark, sf_dir):
    path = scratch_path(spark, "stopwords")
    X.benchmark_tokens(spark, sf_dir).select("term").write.text(path)
    return dictionaries.load_stopwords(spark, path)


@query
def triples_strict(spark, sf_dir):
    return triples.parse_strict(X.matrix_lines(spark, sf_dir), triples.COUNTS)[0]


@query
def triples_strict_rejects(spark, sf_dir):
    return triples.parse_strict(X.matrix_lines(spark, sf_dir), triples.COUNTS)[1]


@query
def triples_lenient(spark, sf_dir):
    return triples.parse_lenient(X.matrix_lines(spark, sf_dir), triples.WEIGHTS)[0]


@query
def triples_lenient_rejects(spark, sf_dir):
    return triples.parse_lenient(X.matrix_lines(spark, sf_dir), triples.WEIGHTS)[1]


@query
def pairs_strict(spark, sf_dir):
    return triples.parse_strict(X.matrix_lines(spark, sf_dir), triples.TOTALS)[0]


@query
def corpus_size(spark, sf_dir):
    return W.corpus_size(X.corpus(spark, sf_dir))


@query
def corpus_inventory(spark, sf_dir):
    return corpora.inventory(_paths(spark, sf_dir, ".txt"))


# Tokens and filters


@query
def tokenize(spark, sf_dir):
    return T.tokenize(X.corpus(spark, sf_dir).select("src_id", "text"), partitions=X.PARTITIONS)


def _tokens(spark, sf_dir, place=PLACE):
    return T.clean_tokens(X.corpus(spark, sf_dir).select("src_id", "text"), partitions=X.PARTITIONS, place=place)


@query
def clean_tokens(spark, sf_dir):
    return _tokens(spark, sf_dir, place=None)


@query
def stopword_filter(spark, sf_dir):
    return T.remove_stopwords(_tokens(spark, sf_dir), X.stopwords(spark), PLACE).select("src_id", "term")


@query
def vocab_filter(spark, sf_dir):
    return T.known_terms(_tokens(spark, sf_dir), X.terms(spark, sf_dir), PLACE).select("src_id", "term")


@query
def oov_tokens(spark, sf_dir):
    return T.out_of_vocabulary(_tokens(spark, sf_dir), X.terms(spark, sf_dir), PLACE).select("src_id", "term")


@query
def doc_filter(spark, sf_dir):
    rows = X.corpus(spark, sf_dir).select("src_id", "doc_name", "class")
    return T.known_documents(rows, X.docs(spark, sf_dir), "doc_name").select("src_id", "doc_name", "class")


@query
def doc_class(spark, sf_dir):
    return X.docs(spark, sf_dir).df.select("doc_name", class_of(F.col("doc_name")).alias("class"))


# Lookups


@query
def encode_terms(spark, sf_dir):
    return T.encode_terms(_tokens(spark, sf_dir), X.terms(spark, sf_dir), PLACE).select("src_id", "term_id")


@query
def encode_docs(spark, sf_dir):
    rows = X.corpus(spark, sf_dir).select("src_id", "doc_name")
    return T.encode_documents(rows, X.docs(spark, sf_dir), "doc_name").select("src_id", "doc_id")


@query
def decode_terms(spark, sf_dir):
    counts = X.statistics(spark, sf_dir).counts.select("term_id", "doc_id")
    return T.decode_terms(counts, X.terms(spark, sf_dir)).select("term_id", "doc_id", "term")


@query
def decode_docs(spark, sf_dir):
    counts = X.statistics(spark, sf_dir).counts.select("term_id", "doc_id")
    return T.decode_documents(counts, X.docs(spark, sf_dir)).select("term_id", "doc_id", "doc_name")


@query
def unknown_terms(spark, sf_dir):
    rows = X.foreign_matrix(spark, sf_dir)
    return T.unknown_terms(rows, X.terms(spark, sf_dir), PLACE).select("term_id", "doc_id", "freq")


@query
def unknown_docs(spark, sf_dir):
    rows = X.foreign_matrix(spark, sf_dir)
    return T.unknown_documents(rows, X.docs(spark, sf_dir), PLACE).select("term_id", "doc_id", "freq")


# Counts


@query
def term_doc_counts(spark, sf_dir):
    return X.statistics(spark, sf_dir).counts


@query
def term_doc_counts_lowercase(spark, sf_dir):
    return X.statistics(spark, sf_dir, lowercase=True).counts


@query
def term_totals(spark, sf_dir):
    return X.statistics(spark, sf_dir).totals


@query
def frequent_terms(spark, sf_dir):
    return C.frequent_terms(X.statistics(spark, sf_dir).totals)


@query
def rare_terms(spark, sf_dir):
    return C.rare_terms(X.statistics(spark, sf_dir).totals)


@query
def low_frequency_filter(spark, sf_dir):
    return X.statistics(spark, sf_dir).kept


@query
def kept_term_totals(spark, sf_dir):
    return C.term_totals(X.statistics(spark, sf_dir).kept)


@query
def dedupe_triples(spark, sf_dir):
    rows = X.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("term_id"),
        F.col("l_suppkey").alias("doc_id"),
        F.col("l_quantity").cast("bigint").alias("freq"),
    )
    return C.dedupe_triples(rows)


# Weights


@query
def doc_lengths(spark, sf_dir):
    return W.doc_lengths(X.statistics(spark, sf_dir).kept)


@query
def term_weight_tf(spark, sf_dir):
    return rounded(X.statistics(spark, sf_dir).frequencies, "tf")


@query
def document_frequency(spark, sf_dir):
    return W.document_frequency(X.statistics(spark, sf_dir).kept)


def _idf(spark, sf_dir, smooth):
    run = X.statistics(spark, sf_dir)
    kept = C.frequent_terms(C.term_stats(run.counts))
    return rounded(W.idf(kept, run.corpus_size, smooth).select("term_id", "idf"), "idf")


@query
def idf(spark, sf_dir):
    return _idf(spark, sf_dir, True)


@query
def idf_plain(spark, sf_dir):
    return _idf(spark, sf_dir, False)


@query
def tfidf(spark, sf_dir):
    return rounded(X.statistics(spark, sf_dir).tfidf, "tfidf")


@query
def tfidf_foreign(spark, sf_dir):
    """No threshold: terms that occur nowhere have weights, too, and a document of length zero has none."""
    matrix = X.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("term_id"),
        F.col("l_orderkey").alias("doc_id"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("freq"),
    )
    n_docs = W.corpus_size(matrix, "doc_id")
    return rounded(W.tfidf(C.dedupe_triples(matrix), n_docs, min_total=None), "tfidf")


# Top lists


@query
def top_terms(spark, sf_dir):
    return X.statistics(spark, sf_dir).top_terms


@query
def class_sizes(spark, sf_dir):
    return L.class_sizes(X.docs(spark, sf_dir).df)


@query
def sum_tfidf_by_class(spark, sf_dir):
    weights = X.statistics(spark, sf_dir).tfidf
    return rounded(L.sum_tfidf_by_class(weights, X.docs(spark, sf_dir)), "sum_tfidf")


@query
def avg_tfidf_by_class(spark, sf_dir):
    return rounded(X.statistics(spark, sf_dir).class_averages, "avg_tfidf")


@query
def top_terms_by_class(spark, sf_dir):
    return rounded(X.statistics(spark, sf_dir).top_by_class(), "avg_tfidf")


@query
def top_terms_by_source(spark, sf_dir):
    return rounded(X.statistics(spark, sf_dir, "source").top_by_class(), "avg_tfidf")


@query
def class_report(spark, sf_dir):
    return X.statistics(spark, sf_dir).report


# Sinks, each written to the scratch folder and read back


@query
def mtx_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "mtx")
    sinks.write_matrix(X.statistics(spark, sf_dir).kept, path)
    return triples.read_counts(spark, path)[0]


@query
def mtx_sorted(spark, sf_dir):
    path = scratch_path(spark, "sorted")
    sinks.write_matrix(X.statistics(spark, sf_dir).counts, path, ordered=True)
    lines = dictionaries.numbered_lines(spark, path)
    fields = F.split("value", "\t")
    return lines.select("line", *[fields[i].cast("bigint").alias(n) for i, n in enumerate(triples.COUNTS)])


@query
def tfidf_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tfidf")
    sinks.write_matrix(X.statistics(spark, sf_dir).tfidf, path)
    return rounded(triples.read_weights(spark, path)[0], "tfidf")


@query
def pairs_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    totals = C.frequent_terms(X.statistics(spark, sf_dir).totals)
    sinks.write_rows(T.decode_terms(totals, X.terms(spark, sf_dir)).select("term", "total"), path)
    return triples.parse_strict(triples.read_lines(spark, path), triples.TOP_LIST)[0]


@query
def report_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report")
    sinks.write_rows(X.statistics(spark, sf_dir).report, path)
    fields = F.split("value", "\t")
    return spark.read.text(path).select(fields[0].alias("class"), fields[1].alias("top_terms"))


@query
def per_document_tf(spark, sf_dir):
    path = scratch_path(spark, "documents")
    X.statistics(spark, sf_dir).write_per_document(path)
    return sinks.read_per_document(spark, path)


# Kept up to date


@query
def extended_dictionary(spark, sf_dir):
    words = T.clean_tokens(X.table(spark, sf_dir, "documents").select("text"), partitions=X.PARTITIONS)
    return growth.extend_ids(X.terms(spark, sf_dir), words, "term", "term_id")


@query
def decode_terms_bucketed(spark, sf_dir):
    terms = BucketedDictionary(X.terms(spark, sf_dir), "term_id")
    return terms.lookup(X.statistics(spark, sf_dir).counts.select("term_id", "doc_id"))


@query
def matrix_ranges(spark, sf_dir):
    path = scratch_path(spark, "ranges")
    ranges.write_ranges(X.statistics(spark, sf_dir).counts, path)
    return ranges.read_ranges(spark, path)


def _batched(spark, sf_dir) -> CountStore:
    """A batch for each two classes that follow each other, so all but the outer ones come twice and are replaced."""
    corpus, terms, docs = X.corpus(spark, sf_dir), X.terms(spark, sf_dir), X.docs(spark, sf_dir)
    label = F.coalesce("class", F.lit(""))
    classes = sorted(r[0] for r in corpus.select(label).distinct().collect())
    store = CountStore(spark, scratch_path(spark, "store"))
    for pair in zip(classes, classes[1:] or classes):
        texts = corpus.where(label.isin(*pair))
        store.add_corpus(texts, terms, docs, X.stopwords(spark), doc_key="src_id", partitions=X.PARTITIONS)
    return store


@query
def batched_counts(spark, sf_dir):
    return _batched(spark, sf_dir).counts


@query
def batched_tfidf(spark, sf_dir):
    store = _batched(spark, sf_dir)
    return rounded(store.tfidf(terms=X.terms(spark, sf_dir), docs=X.docs(spark, sf_dir)), "tfidf")
