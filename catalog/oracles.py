"""The same queries in plain SQL over the test tables."""

from __future__ import annotations

from catalog.fixtures import STOPWORDS

WORDS = ", ".join(f"('{word}')" for word in STOPWORDS)
SPACES = r"[ \t\n\r\f]+"


def _split(text: str) -> str:
    return f"unnest(string_split_regex({text}, '{SPACES}'))"


def _clean(token: str) -> str:
    return f"regexp_replace({token}, '[^a-zA-Z0-9]', '', 'g')"


def _relations(label: str = "lang", lower: bool = False) -> str:
    text = "lower(text)" if lower else "text"
    return f"""
WITH corpus AS (
  SELECT doc_id AS src_id, {label} || '.' || doc_id AS doc_name, {label} AS class, text FROM documents
), stopwords(term) AS (VALUES {WORDS}
), benchmark_tokens AS (
  SELECT term FROM (SELECT {_clean("token")} AS term FROM (SELECT {_split("text")} AS token FROM benchmark))
  WHERE term <> ''
), terms AS (
  SELECT row_number() OVER (ORDER BY term) AS term_id, term FROM (SELECT DISTINCT term FROM benchmark_tokens)
), docs AS (
  SELECT row_number() OVER (ORDER BY c.src_id) AS doc_id, c.src_id, c.doc_name
  FROM corpus c JOIN labels l ON l.doc_id = c.src_id
), raw_tokens AS (
  SELECT src_id, token FROM (SELECT src_id, {_split(text)} AS token FROM corpus) WHERE token <> ''
), tokens AS (
  SELECT src_id, term FROM (SELECT src_id, {_clean("token")} AS term FROM raw_tokens) WHERE term <> ''
), counts AS (
  SELECT t.term_id, d.doc_id, count(*) AS freq
  FROM tokens k JOIN terms t ON t.term = k.term JOIN docs d ON d.src_id = k.src_id
  WHERE k.term NOT IN (SELECT term FROM stopwords)
  GROUP BY t.term_id, d.doc_id
), totals AS (
  SELECT term_id, CAST(sum(freq) AS BIGINT) AS total FROM counts GROUP BY term_id
), kept AS (
  SELECT c.term_id, c.doc_id, c.freq FROM counts c JOIN totals t ON t.term_id = c.term_id WHERE t.total >= 3
), lengths AS (
  SELECT doc_id, CAST(sum(freq) AS BIGINT) AS n_tokens FROM kept GROUP BY doc_id
), dfs AS (
  SELECT term_id, count(*) AS df FROM kept GROUP BY term_id
), size AS (
  SELECT count(DISTINCT src_id) AS n_docs FROM corpus
), weights AS (
  SELECT k.term_id, k.doc_id,
         (CAST(k.freq AS DOUBLE) / l.n_tokens) * (ln((n_docs + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) + 1.0::DOUBLE) AS tfidf
  FROM kept k JOIN lengths l ON l.doc_id = k.doc_id JOIN dfs f ON f.term_id = k.term_id CROSS JOIN size
), classes AS (
  SELECT split_part(doc_name, '.', 1) AS class, count(*) AS n_docs FROM docs GROUP BY 1
), sums AS (
  SELECT split_part(d.doc_name, '.', 1) AS class, w.term_id, sum(w.tfidf) AS sum_tfidf
  FROM weights w JOIN docs d ON d.doc_id = w.doc_id GROUP BY 1, 2
), averages AS (
  SELECT s.class, t.term, s.sum_tfidf / c.n_docs AS avg_tfidf
  FROM sums s JOIN classes c ON c.class = s.class JOIN terms t ON t.term_id = s.term_id
), ranked AS (
  SELECT class, CAST(row_number() OVER (PARTITION BY class ORDER BY avg_tfidf DESC, term) AS INTEGER) AS rk, term, avg_tfidf
  FROM averages
), top AS (
  SELECT * FROM ranked WHERE rk <= 5
), report AS (
  SELECT class, string_agg(term || ':' || printf('%.6f', avg_tfidf), ', ' ORDER BY rk) AS top_terms
  FROM top GROUP BY class
), foreign_matrix AS (
  SELECT l_partkey AS term_id, l_orderkey AS doc_id, CAST(l_quantity AS BIGINT) AS freq FROM lineitem
), lines AS (
  SELECT l_partkey AS a, l_suppkey AS b, CAST(l_quantity AS BIGINT) AS q, l_linenumber % 6 AS shape,
         l_returnflag <> 'A' AS numeric_field,
         l_partkey || chr(9) || l_suppkey AS two,
         l_partkey || chr(9) || l_suppkey || chr(9)
           || CASE WHEN l_returnflag = 'A' THEN 'x' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS three
  FROM lineitem
), value_lines AS (
  SELECT *, CASE shape WHEN 2 THEN two WHEN 3 THEN three || chr(9) || '9' WHEN 4 THEN ' ' || three
            WHEN 5 THEN three || ' ' ELSE three END AS value
  FROM lines
)
"""


def _over(select: str, **options) -> str:
    return _relations(**options) + select


# A leading blank gives four fields of which the first is empty, so such a line is never a good one.
_STRICT = "numeric_field AND shape IN (0, 1, 5)"
_LENIENT = "numeric_field AND shape IN (0, 1, 3, 5)"

ORACLES = {
    "corpus_scan": _over("SELECT src_id, doc_name, class, text FROM corpus"),
    "doc_identity": _over("SELECT src_id, doc_name, class FROM corpus"),
    "dictionary_load": """
SELECT max(line) AS doc_id, doc_name
FROM (SELECT row_number() OVER (ORDER BY doc_id) AS line, lang || '.' || source AS doc_name FROM documents)
GROUP BY doc_name""",
    "dictionary_roundtrip": _over("SELECT term_id, term FROM terms"),
    "dense_doc_ids": _over("SELECT doc_id, src_id, doc_name FROM docs"),
    "stopword_load": _over("SELECT DISTINCT term FROM benchmark_tokens"),
    "triples_strict": _over(f"SELECT a AS term_id, b AS doc_id, q AS freq FROM lines WHERE {_STRICT}"),
    "triples_strict_rejects": _over(f"SELECT value FROM value_lines WHERE NOT ({_STRICT})"),
    "triples_lenient": _over(
        f"SELECT a AS term_id, b AS doc_id, CAST(q AS DOUBLE) AS tfidf FROM lines WHERE {_LENIENT}"
    ),
    "triples_lenient_rejects": _over(f"SELECT value FROM value_lines WHERE NOT ({_LENIENT})"),
    "pairs_strict": _over("SELECT a AS term_id, b AS total FROM lines WHERE shape = 2"),
    "corpus_size": _over("SELECT n_docs FROM size"),
    "corpus_inventory": """
SELECT DISTINCT lang AS class, doc_id || '.txt' AS file_name, lang || '.' || doc_id || '.txt' AS doc_name
FROM documents""",
    "tokenize": _over("SELECT src_id, token FROM raw_tokens"),
    "clean_tokens": _over("SELECT src_id, term FROM tokens"),
    "stopword_filter": _over("SELECT src_id, term FROM tokens WHERE term NOT IN (SELECT term FROM stopwords)"),
    "vocab_filter": _over("SELECT src_id, term FROM tokens WHERE term IN (SELECT term FROM terms)"),
    "oov_tokens": _over("SELECT src_id, term FROM tokens WHERE term NOT IN (SELECT term FROM terms)"),
    "doc_filter": _over("SELECT src_id, doc_name, class FROM corpus WHERE src_id IN (SELECT src_id FROM docs)"),
    "doc_class": _over("SELECT doc_name, split_part(doc_name, '.', 1) AS class FROM docs"),
    "encode_terms": _over("SELECT src_id, term_id FROM tokens JOIN terms USING (term)"),
    "encode_docs": _over("SELECT c.src_id, d.doc_id FROM corpus c JOIN docs d ON d.doc_name = c.doc_name"),
    "decode_terms": _over("SELECT term_id, doc_id, term FROM counts JOIN terms USING (term_id)"),
    "decode_docs": _over("SELECT term_id, doc_id, doc_name FROM counts JOIN docs USING (doc_id)"),
    "unknown_terms": _over(
        "SELECT term_id, doc_id, freq FROM foreign_matrix WHERE term_id NOT IN (SELECT term_id FROM terms)"
    ),
    "unknown_docs": _over(
        "SELECT term_id, doc_id, freq FROM foreign_matrix WHERE doc_id NOT IN (SELECT doc_id FROM docs)"
    ),
    "term_doc_counts": _over("SELECT term_id, doc_id, freq FROM counts"),
    "term_doc_counts_lowercase": _over("SELECT term_id, doc_id, freq FROM counts", lower=True),
    "term_totals": _over("SELECT term_id, total FROM totals"),
    "frequent_terms": _over("SELECT term_id, total FROM totals WHERE total >= 3"),
    "rare_terms": _over("SELECT term_id, total FROM totals WHERE total < 3"),
    "low_frequency_filter": _over("SELECT term_id, doc_id, freq FROM kept"),
    "kept_term_totals": _over("SELECT term_id, CAST(sum(freq) AS BIGINT) AS total FROM kept GROUP BY term_id"),
    "dedupe_triples": """
SELECT l_partkey AS term_id, l_suppkey AS doc_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS freq
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "doc_lengths": _over("SELECT doc_id, n_tokens FROM lengths"),
    "term_weight_tf": _over(
        "SELECT k.term_id, k.doc_id, round(CAST(k.freq AS DOUBLE) / l.n_tokens, 9) AS tf "
        "FROM kept k JOIN lengths l ON l.doc_id = k.doc_id"
    ),
    "document_frequency": _over("SELECT term_id, df FROM dfs"),
    "idf": _over(
        "SELECT term_id, round(ln((n_docs + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) + 1.0::DOUBLE, 9) AS idf "
        "FROM dfs CROSS JOIN size"
    ),
    "idf_plain": _over("SELECT term_id, round(ln(CAST(n_docs AS DOUBLE) / df), 9) AS idf FROM dfs CROSS JOIN size"),
    "tfidf": _over("SELECT term_id, doc_id, round(tfidf, 9) AS tfidf FROM weights"),
    "tfidf_foreign": """
WITH m AS (
  SELECT l_partkey AS term_id, l_orderkey AS doc_id, CAST(sum(l_linenumber - 1) AS BIGINT) AS freq FROM lineitem GROUP BY 1, 2
), w AS (
  SELECT term_id, doc_id, CAST(freq AS DOUBLE) / nullif(sum(freq) OVER (PARTITION BY doc_id), 0) AS tf,
         count(*) OVER (PARTITION BY term_id) AS df
  FROM m
), size AS (SELECT count(DISTINCT l_orderkey) AS n_docs FROM lineitem)
SELECT term_id, doc_id,
       round(tf * (ln((n_docs + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) + 1.0::DOUBLE), 9) AS tfidf
FROM w CROSS JOIN size""",
    "top_terms": _over("""
SELECT CAST(row_number() OVER (ORDER BY frequency, term DESC) AS INTEGER) AS rk, term, frequency FROM (
  SELECT term, total AS frequency FROM totals JOIN terms USING (term_id)
  WHERE total >= 3 ORDER BY total DESC, term LIMIT 10)"""),
    "class_sizes": _over("SELECT class, n_docs FROM classes"),
    "sum_tfidf_by_class": _over("SELECT class, term_id, round(sum_tfidf, 9) AS sum_tfidf FROM sums"),
    "avg_tfidf_by_class": _over("SELECT class, term, round(avg_tfidf, 9) AS avg_tfidf FROM averages"),
    "top_terms_by_class": _over("SELECT class, rk, term, round(avg_tfidf, 9) AS avg_tfidf FROM top"),
    "top_terms_by_source": _over("SELECT class, rk, term, round(avg_tfidf, 9) AS avg_tfidf FROM top", label="source"),
    "class_report": _over("SELECT class, top_terms FROM report"),
    "mtx_roundtrip": _over("SELECT term_id, doc_id, freq FROM kept"),
    "mtx_sorted": _over(
        "SELECT row_number() OVER (ORDER BY CAST(term_id AS VARCHAR), CAST(doc_id AS VARCHAR)) AS line, "
        "term_id, doc_id, freq FROM counts"
    ),
    "tfidf_roundtrip": _over("SELECT term_id, doc_id, round(tfidf, 9) AS tfidf FROM weights"),
    "pairs_roundtrip": _over(
        "SELECT term, total AS frequency FROM totals JOIN terms USING (term_id) WHERE total >= 3"
    ),
    "report_roundtrip": _over("SELECT class, top_terms FROM report"),
    "per_document_tf": _over("SELECT doc_name, term_id, freq FROM counts JOIN docs USING (doc_id)"),
    "extended_dictionary": _over("""
SELECT term_id, term FROM terms UNION ALL
SELECT (SELECT max(term_id) FROM terms) + row_number() OVER (ORDER BY term) AS term_id, term
FROM (SELECT DISTINCT term FROM tokens WHERE term NOT IN (SELECT term FROM terms))"""),
    "decode_terms_bucketed": _over("SELECT term_id, doc_id, term FROM counts JOIN terms USING (term_id)"),
    "matrix_ranges": _over("SELECT term_id, doc_id, freq FROM counts"),
    "batched_counts": _over("SELECT term_id, doc_id, freq FROM counts"),
    "batched_tfidf": _over("SELECT term_id, doc_id, round(tfidf, 9) AS tfidf FROM weights"),
}
