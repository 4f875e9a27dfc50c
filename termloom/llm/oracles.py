"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from termloom.llm import license_scan as L
from termloom.llm import line_dedup as D
from termloom.llm import quality_rules as Q
from termloom.llm import source_divergence as S
from termloom.llm import spelling_variants as V
from termloom.llm.license_texts import LICENSES, SPELLINGS

ORACLES: dict[str, str] = {}

_BUCKET = f"""CASE WHEN v < {Q.FINE} THEN v
  ELSE {Q.FINE} + (length(bin(v)) - 7) * {Q.STEPS} + (v >> (length(bin(v)) - 6)) - {Q.STEPS} END"""


def _value(bucket: str) -> str:
    above = f"(({bucket} - {Q.FINE}) // {Q.STEPS} + 1)"
    return f"""CASE WHEN {bucket} < {Q.FINE} THEN {bucket}
      ELSE ((({bucket} - {Q.FINE}) % {Q.STEPS} + {Q.STEPS} + 1) << {above}) - 1 END"""


def _blend(own: str, other: str) -> str:
    return f"((n_docs * ({own}) + {Q.BLEND} * {other}) // (n_docs + {Q.BLEND}))"


def _level(name: str, by: str) -> str:
    group = f"{by}, " if by else ""
    return f"""
{name}_b AS (SELECT {group}ratio, bucket, sum(n)::BIGINT AS n FROM sketch GROUP BY {group}ratio, bucket),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {group}ratio ORDER BY bucket) AS seen,
    sum(n) OVER (PARTITION BY {group}ratio) AS n_docs FROM {name}_b),
{name} AS (SELECT {group}ratio, any_value(n_docs) AS n_docs,
    min(bucket) FILTER (seen >= ceil(n_docs * {Q.MIDDLE})) AS mb,
    min(bucket) FILTER (seen >= ceil(n_docs * {Q.UPPER})) AS ub
  FROM {name}_c GROUP BY {group}ratio)"""


_RATIO = {
    "symbols": "(n_symbols * 1000) // greatest(word_chars, 1)",
    "dup_lines": "(n_dup_lines * 1000) // greatest(n_lines, 1)",
    "repeats": "(n_repeat_words * 1000) // greatest(n_words, 1)",
    "capitals": "(n_capitals * 1000) // greatest(word_chars, 1)",
    "word_length": "(word_chars * 1000) // greatest(n_words, 1)",
}
_SPREAD = " ".join(f"WHEN '{r}' THEN {n}" for r, n in Q.LEAST_SPREAD.items())

ORACLES["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM d WHERE len(words) >= 5),
windows AS (SELECT doc_id, p, words[p:p + 4] AS w FROM starts),
twice AS (SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_capitals
  FROM d LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m),
v AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, base_failed, '{r}' AS ratio, {x} AS v FROM b" for r, x in _RATIO.items())}),
sketch AS (SELECT lang, source, ratio, {_BUCKET} AS bucket, count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL),
{_level("own", "lang, source")}, {_level("language", "lang")}, {_level("corpus", "")},
corpus_q AS (SELECT ratio, {_value("mb")} AS mid, {_value("ub")} AS up FROM corpus),
language_q AS (SELECT l.lang, ratio, {_blend(_value("mb"), "c.mid")} AS mid, {_blend(_value("ub"), "c.up")} AS up
  FROM language l JOIN corpus_q c USING (ratio)),
edges AS (SELECT own.lang, own.source, own.ratio, {_blend(_value("mb"), "w.mid")} AS mid, {_blend(_value("ub"), "w.up")} AS up
  FROM own JOIN language_q w ON own.lang IS NOT DISTINCT FROM w.lang AND own.ratio = w.ratio),
limits AS (SELECT lang, source, ratio,
    up + {Q.FENCE} * greatest(up - mid, CASE ratio {_SPREAD} END) AS most FROM edges),
over AS (SELECT DISTINCT v.doc_id FROM v JOIN limits l ON v.ratio = l.ratio AND v.lang IS NOT DISTINCT FROM l.lang
    AND v.source IS NOT DISTINCT FROM l.source WHERE v.v > l.most)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM over) AS kept
FROM b"""

ORACLES["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f"""

ORACLES["op3_topk"] = """
WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
    list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""


def _canonical(text: str) -> str:
    low = f"translate(coalesce({text}, ''), '{L.UPPER}', '{L.LOWER}')"
    words = f"regexp_replace(regexp_replace({low}, '{L.COPYRIGHT_LINE}', '', 'g'), '{L.NO_WORD}', ' ', 'g')"
    form = f"' ' || trim({words}) || ' '"
    for spelling, same in SPELLINGS:
        form = f"replace({form}, '{spelling}', '{same}')"
    return form


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _digest(text: str) -> str:
    return f"CASE WHEN {_canonical(text)} <> '  ' THEN sha256({_canonical(text)}) END"


ORACLES["op2_license_scan"] = f"""
WITH texts(license_id, text) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in LICENSES)}),
known AS (SELECT {_digest("text")} AS digest, min(license_id) AS license_id FROM texts GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list(license_id))), ',') AS notices
  FROM lines JOIN known ON {_digest("line")} = digest GROUP BY doc_id),
d AS (SELECT doc_id, {_digest("text")} AS text_digest FROM documents)
SELECT d.doc_id, text_digest, license_id, notices
FROM d LEFT JOIN known ON text_digest = digest LEFT JOIN found ON d.doc_id = found.doc_id"""

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_KEY = _ASCII_LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")

ORACLES["op12_line_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
k AS (SELECT *, {_KEY} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= {D.MIN_CHARS} GROUP BY key HAVING count(DISTINCT r) >= {D.MIN_DOCS}),
j AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id"""


def _crc_table() -> list[int]:
    """Entries of the byte-wise form of CRC-32 with the reflected polynomial EDB88320."""
    entries = list(range(256))
    for _ in range(8):
        entries = [(e >> 1) ^ (0xEDB88320 if e & 1 else 0) for e in entries]
    return entries


# Ids are ASCII digits and letters end at U+00FF, so a character has one byte or two.
_BYTES = """flatten(list_transform(string_split({}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
  ELSE [192 | (unicode(c)::BIGINT >> 6), 128 | (unicode(c)::BIGINT & 63)] END))"""
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}),
  lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295::BIGINT)"""
_RUN = V.LETTERS.replace("\u00c0", r"\x{C0}").replace("\u00ff", r"\x{FF}")

ORACLES["op13_spelling_variants"] = f"""
WITH RECURSIVE c AS (SELECT {_crc_table()}::BIGINT[] AS t),
r AS (SELECT doc_id, {_ASCII_LOWER.format("run")} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[{_RUN}]+')) AS run FROM documents)
  WHERE length(run) >= {V.MIN_LENGTH} GROUP BY ALL),
h AS (SELECT run, n, {_CRC.format("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r, c),
w AS (SELECT CASE WHEN h % {V.DAMAGE} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
  sum(n)::BIGINT AS n FROM h GROUP BY 1 HAVING length(word) >= {V.MIN_LENGTH} AND sum(n) >= {V.MIN_COUNT}),
holes AS (SELECT word, n, unnest(range(length(word))) AS i FROM w),
p AS (SELECT word, n, left(word, i::INT) || '_' || substr(word, i::INT + 2) AS replaced, left(word, i::INT) || substr(word, i::INT + 2) AS less FROM holes),
e AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM p a JOIN p b USING (replaced) WHERE a.word <> b.word
  UNION SELECT p.word, w.word, w.n FROM p JOIN w ON p.less = w.word
  UNION SELECT w.word, p.word, p.n FROM p JOIN w ON p.less = w.word),
b AS (SELECT word, count(*)::BIGINT AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM e GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {V.FACTOR} * n THEN best END AS form,
  CASE WHEN best_n >= {V.FACTOR} * n THEN best_n END AS form_n FROM w LEFT JOIN b USING (word)),
way AS (SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON way.next = f.word)
SELECT f.word, f.form, way.root, f.n, f.n_near, f.form_n FROM f JOIN way ON f.word = way.word AND way.next IS NULL"""


def _share(n: str, total: str) -> str:
    return f"(1 + ({S.SCALE}::HUGEINT * ({n} + {S.ADDED})) // ({total} + {S.ADDED} * v))::BIGINT"


_TEXT = _ASCII_LOWER.format("coalesce(text, '')")

ORACLES["op11_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_TEXT}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {S.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x
    ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
p AS (SELECT lang, source, term, n, {_share("n", "sum(n) OVER (PARTITION BY lang, source)")} AS p FROM c JOIN v USING (lang)),
w AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
q AS (SELECT lang, term, {_share("n", "sum(n) OVER (PARTITION BY lang)")} AS q FROM w JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pair LEFT JOIN far USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
WHERE part = 'pair' OR rank <= {S.TOP}"""
