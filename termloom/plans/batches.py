"""A count matrix kept up to date: batches of documents come, are replaced and go, without a run over all of them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from termloom.operators import weights as W
from termloom.operators.counts import MIN_TOTAL, frequent_terms, join_term_stats, term_doc_counts
from termloom.operators.lookup import BROADCAST_LIMIT, Dictionary, as_dictionary

_ENTRY = "generation int, batch int, rows string, docs string, gone string, stats string, n_docs bigint"
_ROWS = "batch int, term_id bigint, doc_id bigint, freq bigint"
_STATS = "term_id bigint, total bigint, df bigint"


class CountStore:
    """A matrix below ``path``: tables of batches, and a manifest with one row per batch.

    A batch brings whole documents. One that the store has already, by its key, replaces the older one. A batch writes
    its matrix rows, its documents, the documents that go for it, and by how much totals and document frequencies
    change; so totals, frequencies and the number of documents are sums over batches, and a batch reads no more of the
    older matrix than the rows of batches in which documents go. What k batches leave equals one run over the documents
    that are left, bit for bit in all weights and averages, given the same dictionaries.

    Tables are named by the manifest row, which is written last: a run that dies before leaves files that nothing
    names, and the store as it was. One writer at a time. The driver holds one manifest row per batch since the last
    ``compact``.

    A document is known by its key; ``doc_id`` is its dictionary id or null, and belongs to one key. Documents
    outside the dictionary count for the corpus size only. Null keys are no documents. A word that the term dictionary gets later is
    not counted in older batches; extend the dictionary by each batch's own words before adding it.
    """

    def __init__(self, spark: SparkSession, path: str, limit: int = BROADCAST_LIMIT):
        self.spark = spark
        self.path = path.rstrip("/")
        self.limit = limit

    # --- the manifest

    def _file_system(self, path: str):
        context = self.spark.sparkContext
        jvm_path = context._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path, jvm_path.getFileSystem(context._jsc.hadoopConfiguration())

    def batches(self) -> list[Row]:
        """Manifest rows in force, oldest first."""
        jvm_path, files = self._file_system(f"{self.path}/manifest")
        if not files.exists(jvm_path):
            return []
        entries = self.spark.read.schema(_ENTRY).parquet(f"{self.path}/manifest").collect()
        newest = max((e["generation"] for e in entries), default=0)
        return sorted((e for e in entries if e["generation"] == newest), key=lambda e: e["batch"])

    def _put(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _read(self, kind: str, entries: list[Row], schema: str | None = None) -> DataFrame:
        paths = [f"{self.path}/{e[kind]}" for e in entries if e[kind] is not None]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read if schema is None else self.spark.read.schema(schema)).parquet(*paths)

    def _commit(self, **entry) -> None:
        row = self.spark.createDataFrame([Row(**entry)], _ENTRY)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    # --- what is in force

    def _gone(self, entries: list[Row]) -> Dictionary | None:
        """``(batch, doc_key, doc_id)`` of documents no longer in force, each in the batch that brought it."""
        listed = [e for e in entries if e["gone"] is not None]
        return Dictionary(self._read("gone", listed), self.limit) if listed else None

    def _less(self, df: DataFrame, gone: Dictionary | None, key: str) -> DataFrame:
        """A document has one row for each dictionary term at most, so no key here is heavy."""
        if gone is None:
            return df
        keys = gone.df.select("batch", key).where(F.col(key).isNotNull())
        return df.join(F.broadcast(keys) if gone.fits() else keys, ["batch", key], "left_anti").select(df.columns)

    def _live_rows(self, entries: list[Row]) -> DataFrame:
        return self._less(self._read("rows", entries, _ROWS), self._gone(entries), "doc_id")

    def _live_docs(self, entries: list[Row]) -> DataFrame:
        return self._less(self._read("docs", entries), self._gone(entries), "doc_key")

    @property
    def counts(self) -> DataFrame:
        """``(term_id, doc_id, freq)``."""
        return self._live_rows(self.batches()).select("term_id", "doc_id", "freq")

    @property
    def term_stats(self) -> DataFrame:
        """``(term_id, total, df)``, from the changes of each batch alone."""
        changes = self._read("stats", self.batches(), _STATS)
        summed = changes.groupBy("term_id").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
        return summed.where(F.col("df") > 0)

    @property
    def totals(self) -> DataFrame:
        """``(term_id, total)``."""
        return self.term_stats.select("term_id", "total")

    @property
    def corpus_size(self) -> DataFrame:
        """``(n_docs)``, one row."""
        return self.spark.createDataFrame([(sum(e["n_docs"] for e in self.batches()),)], "n_docs bigint")

    def kept(self, min_total: int | None = MIN_TOTAL, terms: Dictionary | None = None) -> DataFrame:
        """``(term_id, doc_id, freq)`` without rare terms."""
        stats = frequent_terms(self.term_stats, min_total)
        return join_term_stats(self.counts, stats, terms).select("term_id", "doc_id", "freq")

    def tfidf(
        self,
        min_total: int | None = MIN_TOTAL,
        terms: Dictionary | None = None,
        docs: Dictionary | None = None,
        smooth: bool = True,
    ) -> DataFrame:
        """``(term_id, doc_id, tfidf)``; statistics are not counted again."""
        stats = W.idf(frequent_terms(self.term_stats, min_total), self.corpus_size, smooth)
        rows = join_term_stats(self.counts, stats.select("term_id", "df", "idf"), terms)
        return W.weigh(rows, docs, terms)

    # --- changes

    def _write(self, counts: DataFrame | None, documents: DataFrame | None, leaving: DataFrame) -> None:
        """One batch: ``counts`` and ``documents`` come, documents in force with a key of ``leaving`` go."""
        entries = self.batches()
        number = max((e["batch"] for e in entries), default=0) + 1
        generation = entries[0]["generation"] if entries else 1
        entry = dict(generation=generation, batch=number, rows=None, docs=None, gone=None, stats=None, n_docs=0)
        changes = []
        if documents is not None:
            entry["docs"] = self._put(documents.select(F.lit(number).alias("batch"), "doc_key", "doc_id"), "docs")
            entry["rows"] = self._put(counts.select(F.lit(number).alias("batch"), "term_id", "doc_id", "freq"), "rows")
            entry["n_docs"] += self._read("docs", [Row(**entry)]).count()
            changes.append(self._change(self._read("rows", [Row(**entry)], _ROWS), 1))
        if any(e["docs"] is not None for e in entries):
            keys = Dictionary(leaving if entry["docs"] is None else self._read("docs", [Row(**entry)]).select("doc_key"), self.limit)
            old = self._live_docs(entries)
            found = old.join(F.broadcast(keys.df) if keys.fits() else keys.df, "doc_key", "left_semi")
            name = self._put(found.select("batch", "doc_key", "doc_id"), "gone")
            gone = Dictionary(self.spark.read.parquet(f"{self.path}/{name}"), self.limit)
            touched = {r["batch"] for r in gone.df.select("batch").distinct().collect()}  # batches, not documents
            if touched:
                entry["gone"] = name
                entry["n_docs"] -= gone.rows
                known = gone.df.select("batch", "doc_id").where(F.col("doc_id").isNotNull())
                rows = self._read("rows", [e for e in entries if e["batch"] in touched], _ROWS)
                rows = rows.join(F.broadcast(known) if gone.fits() else known, ["batch", "doc_id"], "left_semi")
                changes.append(self._change(rows, -1))
        if changes:
            summed = reduce(DataFrame.unionByName, changes).groupBy("term_id")
            stats = summed.agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
            entry["stats"] = self._put(stats.where("total <> 0 OR df <> 0"), "stats")
        self._commit(**entry)

    @staticmethod
    def _change(rows: DataFrame, sign: int) -> DataFrame:
        total, df = F.sum("freq") * sign, F.count(F.lit(1)) * sign
        return rows.groupBy("term_id").agg(total.alias("total"), df.alias("df"))

    def add(self, counts: DataFrame, documents: DataFrame) -> None:
        """A batch: ``counts (term_id, doc_id, freq)`` of ``documents (doc_key, doc_id)``, those without counts included.

        Repeated rows of a document are one.
        """
        once = documents.where(F.col("doc_key").isNotNull()).groupBy("doc_key").agg(F.max("doc_id").alias("doc_id"))
        self._write(counts, once, once.select("doc_key"))

    def add_corpus(
        self,
        corpus: DataFrame,
        terms: Dictionary | DataFrame,
        docs: Dictionary | DataFrame,
        stopwords: DataFrame | None = None,
        *,
        doc_key: str = "doc_name",
        **options,
    ) -> None:
        """A batch from texts; options as for :func:`termloom.operators.counts.term_doc_counts`."""
        docs = as_dictionary(docs)
        counts = term_doc_counts(corpus, terms, docs, stopwords, doc_key=doc_key, **options)
        keys = corpus.select(doc_key).distinct()
        known = docs.df.select(doc_key, "doc_id")
        named = keys.join(F.broadcast(known) if docs.fits() else known, doc_key, "left")
        self.add(counts, named.select(F.col(doc_key).alias("doc_key"), "doc_id"))

    def remove(self, keys: DataFrame) -> None:
        """Documents with a key of ``keys (doc_key)`` go; keys that the store does not have change nothing."""
        self._write(None, None, keys.select("doc_key").where(F.col("doc_key").isNotNull()).distinct())

    def compact(self) -> None:
        """All batches as one. Older tables stay for readers that began before; ``prune`` deletes them."""
        entries = self.batches()
        if not any(e["docs"] is not None for e in entries):
            return
        one = F.lit(1).alias("batch")
        docs = self._put(self._live_docs(entries).select(one, "doc_key", "doc_id"), "docs")
        rows = self._put(self._live_rows(entries).select(one, "term_id", "doc_id", "freq"), "rows")
        stats = self._put(self.term_stats, "stats")
        n_docs = sum(e["n_docs"] for e in entries)
        generation = entries[0]["generation"] + 1
        self._commit(generation=generation, batch=1, rows=rows, docs=docs, gone=None, stats=stats, n_docs=n_docs)

    def prune(self) -> None:
        """Delete tables that no manifest row in force names; no reader or writer may be at work."""
        named = {e[kind] for e in self.batches() for kind in ("rows", "docs", "gone", "stats")}
        root, files = self._file_system(self.path)
        for status in files.listStatus(root):
            name = status.getPath().getName()
            if name.split("-")[0] in ("rows", "docs", "gone", "stats") and name not in named:
                files.delete(status.getPath(), True)
