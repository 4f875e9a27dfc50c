"""Quality rules with thresholds learned per language and source.

Every document gets counts taken from its whole text. A few ratios of these counts are turned into integers
and gathered in a quantile sketch per (language, source): a histogram over buckets whose width grows with the
value, so that a quantile read from it is exact below 64 and within 1/32 of its value above. Such sketches
merge by adding counts, so the same table also gives the sketches of a language and of the whole corpus, and
sketches of other days can be added to it. Their quantiles set the limits that documents are then joined with
and measured by. Everything is a DataFrame expression.

Defined results: a null text has no words. A null language or source is a group of its own. Fewer than 10
words, or repeated five-word windows over more than a fifth of the words, fail the base rules whatever the
limits say; such documents are not counted in sketches. Repeated rows count as often as they occur. An empty
table gives an empty result. Windows are compared by the 64-bit hash of their five words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import SPACE, column, free_name
from termloom.operators.lookup import Dictionary, salted_join
from termloom.session import materialize

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

# Ratios are kept in thousandths. A document goes when a ratio is above its limit, which is FENCE spreads above
# the upper quantile of its group; the spread is the distance from the median to the upper quantile, or the
# least spread given here: a group of equal documents must not reject whatever differs in one character. Symbols,
# repeated lines and repeated windows are absent from most ordinary documents, so there the least spread
# mostly decides; capitals and word length go by their group.
PER = 1000
UPPER, MIDDLE = 0.8, 0.5
FENCE = 5
LEAST_SPREAD = {"symbols": 10, "dup_lines": 52, "repeats": 27, "capitals": 4, "word_length": 128}
RATIOS = tuple(LEAST_SPREAD)
# A group's quantiles count as much as its documents, those of its language as much as so many more, and in the same
# way a language's own and those of the corpus. So a group counts the more, the larger it is, without a step.
BLEND = 50
QUANTILES = ("middle", "upper")
# Sketch buckets: one per value below FINE, then STEPS per power of two.
FINE, STEPS = 64, 32

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def _repeated_words(hashes: Column) -> Column:
    """Words in windows whose hash stands twice or more in ``hashes``, the windows' hashes in text order."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(ordered: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            before, after = F.get(ordered, j - 1)["h"], F.get(ordered, j + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

    def covered(total: Column, start: Column) -> Column:
        new = F.least(F.lit(WINDOW), start + WINDOW - total["end"])
        return F.struct((total["words"] + new).alias("words"), (start + WINDOW).alias("end"))

    none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
    # One array of one element stands for "let": the sorted array is used three times and made once.
    found = F.transform(F.array(ordered), starts)[0]
    return F.aggregate(found, none, covered, lambda total: total["words"])


def measures(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct column of counts over the whole text, named by :func:`measured_as`."""
    name = measured_as(docs)
    words, lines, hashes = (free_name(docs, f"{name}_{x}") for x in ("words", "lines", "hashes"))
    whole = F.coalesce(column(text), F.lit(""))
    kept = [column(c) for c in docs.columns if keep_text or c != text]
    n_words = F.size(column(words))
    split = docs.select(
        *[column(c) for c in docs.columns],
        F.array_remove(F.split(whole, SPACE), "").alias(words),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias(lines),
    )
    window = F.transform(
        F.sequence(F.lit(0), n_words - WINDOW),
        lambda i: F.xxhash64(*[F.get(column(words), i + k) for k in range(WINDOW)]),
    )
    hashed = split.select("*", F.when(n_words >= WINDOW, window).alias(hashes))
    distinct = F.size(F.array_distinct(column(hashes)))
    counts = {
        "n_words": n_words,
        "word_chars": F.length(F.regexp_replace(whole, SPACE, "")),
        "n_symbols": F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")),
        "n_lines": F.size(column(lines)),
        "n_dup_lines": F.size(column(lines)) - F.size(F.array_distinct(column(lines))),
        "n_repeat_words": F.when(distinct < F.size(column(hashes)), _repeated_words(column(hashes))).otherwise(0),
        "n_capitals": F.length(F.regexp_replace(whole, r"\P{Lu}+", "")),
    }
    return hashed.select(*kept, F.struct(*[counts[m].cast("bigint").alias(m) for m in MEASURES]).alias(name))


def measured_as(docs: DataFrame) -> str:
    return free_name(docs, "measured")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])


def ratios(m: Column) -> dict[str, Column]:
    """Whole thousandths of the counts ``m``; a denominator of zero is taken as one."""

    def per(part: str, whole: str) -> Column:
        return F.floor(m[part] * PER / F.greatest(m[whole], F.lit(1))).cast("bigint")

    return {
        "symbols": per("n_symbols", "word_chars"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "capitals": per("n_capitals", "word_chars"),
        "word_length": per("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """Sketch bucket of a whole number of zero or more."""
    above = F.length(F.bin(value)) - 7  # powers of two above FINE
    step = F.floor(value / F.pow(F.lit(2), above + 1)) - STEPS
    return F.when(value < FINE, value).otherwise(FINE + above * STEPS + step).cast("int")


def bucket_value(number: Column) -> Column:
    """The largest value of a bucket."""
    above, step = F.floor((number - FINE) / STEPS), F.pmod(number - FINE, F.lit(STEPS))
    top = (step + STEPS + 1) * F.pow(F.lit(2), above + 1) - 1
    return F.when(number < FINE, number).otherwise(top).cast("bigint")


def group_key(lang: str = "lang", source: str = "source") -> Column:
    """One string per (language, source), nulls included."""
    return F.to_json(F.struct(column(lang).alias("lang"), column(source).alias("source")))


def sketches(measured: DataFrame, name: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """``(key, lang, ratio, bucket, n)``; sketches of several tables merge by adding ``n``."""
    m = column(name)
    values = F.explode(
        F.array(*[F.struct(F.lit(r).alias("ratio"), bucket(v).alias("bucket")) for r, v in ratios(m).items()])
    )
    return (
        measured.where(~base_failed(m))
        .select(group_key(lang, source).alias("key"), F.to_json(F.struct(column(lang))).alias("lang"), values.alias("v"))
        .groupBy("key", "lang", "v.ratio", "v.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, ratio, n_docs, middle, upper)`` of sketches summed over ``by``; one row per group and ratio."""
    merged = sketch.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))
    # A group has at most some 1,800 buckets, so its sketch fits in one value.
    counts = merged.groupBy(*by, "ratio").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"), F.sum("n").alias("n_docs")
    )

    def value(share: float) -> Column:
        def add(state: Column, x: Column) -> Column:
            reached = state["seen"] >= F.ceil(F.col("n_docs") * share)
            return F.struct(
                (state["seen"] + x["n"]).alias("seen"),
                F.when(reached, state["bucket"]).otherwise(x["bucket"]).alias("bucket"),
            )

        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0).alias("bucket"))
        return bucket_value(F.aggregate("counts", start, add, lambda state: state["bucket"]))

    return counts.select(*by, "ratio", "n_docs", value(MIDDLE).alias("middle"), value(UPPER).alias("upper"))


def learn_limits(sketch: DataFrame) -> DataFrame:
    """``(key, limits)``: the limits of every (language, source) that has a sketch."""
    own = _quantiles(sketch, ["key", "lang"])
    language = _quantiles(sketch, ["lang"])
    corpus = _quantiles(sketch, [])
    def blended(own: str, other: str, name: str) -> Column:
        n = F.col(f"{own}n_docs")
        return F.call_function("div", n * F.col(f"{own}{name}") + BLEND * F.col(f"{other}{name}"), n + BLEND).alias(name)

    both = language.select("lang", "ratio", F.struct("n_docs", *QUANTILES).alias("l")).join(
        F.broadcast(corpus.select("ratio", F.struct(*QUANTILES).alias("c"))), "ratio"
    )
    wide = both.select("lang", "ratio", F.struct(*[blended("l.", "c.", q) for q in QUANTILES]).alias("w"))
    used = own.join(wide, ["lang", "ratio"]).select("key", "ratio", F.struct(*[blended("", "w.", q) for q in QUANTILES]).alias("q"))
    least = F.element_at(F.create_map(*[F.lit(x) for pair in LEAST_SPREAD.items() for x in pair]), F.col("ratio"))
    limit = F.col("q.upper") + FENCE * F.greatest(F.col("q.upper") - F.col("q.middle"), least)
    by_ratio = used.groupBy("key").agg(*[F.max(F.when(F.col("ratio") == r, limit)).alias(r) for r in RATIOS])
    return by_ratio.select("key", F.struct(*RATIOS).alias("limits"))


def judge(measured: DataFrame, name: str, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with the fields ``base_failed`` and ``kept`` added to its struct of counts.

    ``limits`` has one row per group. It is broadcast when its measured size allows, else joined with large
    groups cut into slices.
    """
    key, found = free_name(measured, "group_key"), free_name(measured, "group_limits")
    table = Dictionary(materialize(limits.select(F.col("key").alias(key), F.col("limits").alias(found)), "limits"))
    # A limit is one whole number per ratio, so a row's size is known from the number of groups.
    keyed = measured.withColumn(key, group_key(lang, source))
    if table.fits_per_row(512):
        joined = keyed.join(F.broadcast(table.df), key, "left")
    else:
        joined = salted_join(keyed, table.df, key, "left")
    m = column(name)
    within = reduce(
        lambda a, b: a & b, [v <= F.coalesce(column(found)[r], v) for r, v in ratios(m).items()]
    )
    failed = base_failed(m)
    verdict = m.withField("base_failed", failed).withField("kept", ~failed & within)
    return joined.select(*[verdict.alias(c) if c == name else column(c) for c in measured.columns])


def quality_verdicts(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep_text: bool = True
) -> DataFrame:
    """``docs`` with one struct column more (see :func:`measured_as`): counts, ``base_failed`` and ``kept``.

    What is measured is written down once, so that texts are not taken apart again for the verdicts; with
    ``keep_text=False`` the texts are left out of that table and of the result.
    """
    name = measured_as(docs)
    measured = materialize(measures(docs, text, keep_text), "measured")
    sketch = materialize(sketches(measured, name, lang, source), "sketches")
    return judge(measured, name, learn_limits(sketch), lang, source)


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Documents that pass, with the columns of ``docs``."""
    name = measured_as(docs)
    judged = quality_verdicts(docs, text, lang, source)
    return judged.where(column(name)["kept"]).select(*map(column, docs.columns))
