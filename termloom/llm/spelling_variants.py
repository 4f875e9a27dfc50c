"""Spelling variants: words one edit apart, and the frequent form that each of them is a variant of.

A word and a terminator are written as a ring and cut open at every place: its rotations. A rotation without its last
character is a prefix that skips exactly one character of the word. Words that differ from it by a replacement there
have a rotation with the same prefix, and the word that lacks the character has that prefix as a whole rotation. So
every word gives each of its rotations twice, without the last character (a member of the prefix) and whole (the head of
a prefix); Spark deals them by prefix, sorts them, and a scan of equal prefixes finds all neighbours. A prefix has one
head at most and one member per letter of the alphabet, so no group is larger than that, whatever the words.

Two words that differ by a replacement share one prefix. A character taken from a run of equal ones gives the same
word wherever it is taken, so only the first of a run makes a member that its head counts. Each neighbour is counted
once that way, and what leaves a group is one row per word with the number and the best of its neighbours there.

A word's form is its neighbour of largest count, ties to the smallest in code-point order, if that count is
``FACTOR`` times the word's or more. Counts grow by that factor from form to form, so roots are reached in as many
doublings of the way as the logarithm of that of the largest count has digits.

Defined results: a null text has no words; a null id reads as an empty one. Repeated rows count as often as they occur.
Null words are dropped and equal words added up. Words hold no terminator (code point 0); one that does is an error. An
empty table gives an empty result. Columns beside those named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import column
from termloom.llm.workers import tidy
from termloom.operators.lookup import Dictionary
from termloom.session import materialize

# The letters of a run, and how runs are damaged: one character of every 31st, by checksum.
LETTERS = "A-Za-zÀ-ÿ"
DAMAGE = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FACTOR = 10
TERMINATOR = "\0"


# --- words of texts ---------------------------------------------------------------------------------------


def damaged(run: str, start: int) -> str:
    """``run`` less one character if its checksum says so; ``start`` is the checksum of the id and a colon."""
    check = zlib.crc32(run.encode(), start)
    if check % DAMAGE:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def text_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = MIN_LENGTH) -> DataFrame:
    """``(word, n)``: the words of ``min_length`` characters or more, counted over all texts."""
    runs = re.compile(f"[{LETTERS.replace('A-Z', '')}]{{{min_length},}}")

    @tidy
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[str] = Counter()
            for ident, body in zip(batch["id"], batch["text"]):
                start = zlib.crc32(f"{ident}:".encode())
                lowered = body.encode("utf-8", "replace").lower().decode()  # bytes: A-Z only
                # Equal runs of a document fare alike. Shorter runs give no word that is long enough.
                for run, n in Counter(runs.findall(lowered)).items():
                    found[damaged(run, start)] += n
            kept = {w: n for w, n in found.items() if len(w) >= min_length}
            yield pd.DataFrame({"word": pd.Series(list(kept), dtype=object), "n": pd.Series(list(kept.values()), dtype="int64")})

    texts = docs.select(
        F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("id"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    return texts.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# --- neighbours -------------------------------------------------------------------------------------------


def _rotations(words: DataFrame) -> DataFrame:
    """``(prefix, head, counts, word, n)``: every rotation as a head and, without its last character, as a member.

    ``counts`` says whether taking out the skipped character makes the word of the head (first of its run).
    """
    word, length = F.col("word"), F.length("word")

    def cut(at: Column, skipped: int) -> Column:
        """What stands behind place ``at`` (and the skipped character), the terminator, and what stands before."""
        return F.concat(F.substring(word, at + skipped + 1, length), F.lit(TERMINATOR), F.substring(word, F.lit(1), at))

    def member(at: Column) -> Column:
        first = (at == 0) | (F.substring(word, at, F.lit(1)) != F.substring(word, at + 1, F.lit(1)))
        return F.struct(cut(at, 1).alias("prefix"), F.lit(False).alias("head"), first.alias("counts"))

    def head(at: Column) -> Column:
        return F.struct(cut(at, 0).alias("prefix"), F.lit(True).alias("head"), F.lit(True).alias("counts"))

    places = F.sequence(F.lit(0), length)
    members, heads = F.transform(F.filter(places, lambda at: at < length), member), F.transform(places, head)
    return words.select("word", "n", F.explode(F.concat(members, heads)).alias("r")).select("r.*", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` of every word of unique ``words (word, n)`` that has a neighbour; ``best`` is a
    struct of the neighbour's negative count and itself, so that the least one is best."""
    # As many tasks as there are shuffle partitions: a word makes two rotations per letter, so few rows make many.
    dealt = words.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")
    same = Window.partitionBy("prefix")
    met = _rotations(dealt).withColumn("met", F.count(F.lit(1)).over(same)).where("met > 1")
    # Dealt and sorted by prefix already; a group has one entry per letter of the alphabet and its head.
    entry = F.struct((-F.col("n")).alias("rank"), "word", "head", "counts")
    groups = met.groupBy("prefix").agg(F.sort_array(F.collect_list(entry)).alias("group"))

    def near(a: Column, b: Column) -> Column:
        return (a["word"] != b["word"]) & ((~a["head"] & ~b["head"]) | (a["counts"] & b["counts"] & (a["head"] != b["head"])))

    def found(a: Column) -> Column:
        others = F.filter("group", lambda b: near(a, b))
        return F.struct(a["word"].alias("word"), F.size(others).alias("n_near"), F.get(others, 0).alias("best"))

    each = groups.select(F.explode(F.transform("group", found)).alias("f")).where("f.n_near > 0")
    best = F.min(F.struct("f.best.rank", "f.best.word"))
    return each.groupBy("f.word").agg(F.sum("f.n_near").cast("bigint").alias("n_near"), best.alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of unique ``forms (word, form)``: where following forms ends. Ways double each turn."""
    now = materialize(forms.select("word", F.col("form").alias("to")), "ways")
    while True:
        ahead = Dictionary(now.select(F.col("word").alias("to"), F.col("to").alias("next")))
        # Unique words on the side that is looked up; few words share a form, as it is one edit away from each.
        joined = now.join(F.broadcast(ahead.df) if ahead.fits() else ahead.df, "to", "left")
        further = materialize(joined.select("word", F.coalesce("next", "to").alias("to"), F.col("next").alias("moved")), "ways")
        now = further.select("word", "to")
        if further.where(F.col("moved").isNotNull()).isEmpty():
            return now.withColumnRenamed("to", "root")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of ``words (word, n)``."""
    plain = F.when(F.instr("word", TERMINATOR) == 0, F.col("word")).otherwise(
        F.raise_error(F.lit("a word holds the terminator")).cast("string")
    )
    given = words.where(F.col("word").isNotNull()).select(plain.alias("word"), "n")
    unique = materialize(given.groupBy("word").agg(F.sum("n").cast("bigint").alias("n")), "words")
    near = neighbours(unique).select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.rank")).alias("best_n"))
    strong = F.col("best_n") >= F.col("n") * factor
    judged = unique.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(strong, F.col("best")).alias("form"),
        F.when(strong, F.col("best_n")).alias("form_n"),
    )
    judged = materialize(judged, "judged")
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """:func:`variants` among the words of all texts that occur ``MIN_COUNT`` times or more."""
    return variants(text_words(docs, text, doc_id).where(F.col("n") >= MIN_COUNT))
