"""Licence texts by digest.

A text is brought to a canonical form: A-Z in lower case, lines that only state a copyright dropped, every run of
characters other than letters and digits one blank, and equivalent spellings made one. Two texts that differ in
nothing else have the same digest, so known licences are found by a hash join of digests of entire texts. The same
is done with single lines, for notices inside other texts. Everything is a DataFrame expression.

Defined results: a null text is empty; texts and lines that are empty in canonical form are no licence, even if a
known text were. A licence listed several times counts once, and of licences with the same digest the first by
name is found. Repeated rows are matched each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import column, free_name
from termloom.llm.license_texts import LICENSES, SPELLINGS
from termloom.operators.lookup import Dictionary, salted_join
from termloom.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line may also begin with the word where a sentence is wrapped, so a mark, year or name has to follow.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright[ \t:]*(\(c\)|©|[0-9<{\[]|by )|\(c\)|©|all rights reserved)[^\n]*$"
NO_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Canonical form with a blank before every word and behind the last."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    words = F.regexp_replace(F.regexp_replace(low, COPYRIGHT_LINE, ""), NO_WORD, " ")
    form = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    for spelling, same in SPELLINGS:
        form = F.replace(form, F.lit(spelling), F.lit(same))
    return form


def _form_digest(form: Column) -> Column:
    return F.when(form != "  ", F.sha2(form, 256))


def digest(text: Column) -> Column:
    """Hex SHA-256 of the canonical form, null if that is empty."""
    # An array of one stands for "let": the form is used twice and made once.
    return F.transform(F.array(canonical(text)), _form_digest)[0]


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] = LICENSES) -> DataFrame:
    """Digests of a list of (id, text), see :func:`license_digests`."""
    rows = spark.createDataFrame(texts, "license_id string, text string")
    return license_digests(rows)


def license_digests(texts: DataFrame) -> DataFrame:
    """``(digest, license_id, size, start)`` of ``(license_id, text)``, one row per digest: characters of the form,
    and :func:`_start`."""
    rows = texts.select(canonical(F.col("text")).alias("form"), "license_id").where(F.col("form") != "  ")
    return rows.groupBy(F.sha2("form", 256).alias("digest")).agg(
        F.min("license_id").alias("license_id"), F.min(F.length("form")).alias("size"), F.min(_start(F.col("form"))).alias("start")
    )


def _start(form: Column) -> Column:
    """Length and first word of a form: lines in which they are those of no known text are not looked up."""
    return F.concat(F.length(form).cast("string"), F.substring_index(form, " ", 2))


def _join(rows: DataFrame, known: Dictionary, on: str, how: str) -> DataFrame:
    side = known.df.select(F.col("digest").alias(on), "license_id")
    return rows.join(F.broadcast(side), on, how) if known.fits() else salted_join(rows, side, on, how)


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``text_digest``, ``license_id`` of the entire text, and ``notices``: the
    sorted ids, joined with commas, of licences that whole lines of the text name (null if none).

    Only ids and digests are joined, never texts; lines with the length and first word of no known text are not looked up.
    """
    table = Dictionary(materialize(known, "licenses"))
    starts = [row["start"] for row in table.df.select("start").distinct().collect()] if table.fits() else None
    others = [c for c in docs.columns if c != text]
    row, line, name = free_name(docs, "row"), free_name(docs, "line_digest"), free_name(docs, "text_digest")
    forms = F.transform(F.split(F.coalesce(column(text), F.lit("")), "\n"), canonical)
    fitting = forms if starts is None else F.filter(forms, lambda form: _start(form).isin(starts))
    lines = F.array_compact(F.array_distinct(F.transform(fitting, _form_digest)))
    digests = materialize(
        docs.select(
            *map(column, others),
            digest(column(text)).alias(name),
            lines.alias(line),
            F.monotonically_increasing_id().alias(row),
        ),
        "digests",
    )
    found = _join(digests.select(row, F.explode(line).alias(line)), table, line, "inner")
    notices = found.groupBy(row).agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notices"))
    whole = _join(digests.drop(line), table, name, "left")
    return whole.join(notices, row, "left").select(*map(column, others), column(name), "license_id", "notices")
