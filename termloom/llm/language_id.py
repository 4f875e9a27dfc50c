"""Language of texts, by spans.

A model holds, for every language it has learned, hashed counts of two and three neighbouring letters and the
scripts its texts are written in. A text is cut into words (runs of letters). The script of a word narrows the
languages it can be in; each candidate gets the log-probability of the word's letter groups; and the Viterbi
path over these scores, where a change of language costs ``SWITCH``, labels every word. Runs of equal labels are
the spans; the language with most letters is the language of the text, its share of the letters the score.

The model is fitted on a bounded sample: about ``SAMPLE`` labelled texts per language, chosen by a hash of the id
with a rate that follows from the number of labelled rows. Every label is learned. The model has ``WEIGHTS`` numbers
at most, so the more languages, the fewer buckets its letter groups are hashed to: 2 ** 16 for up to 64 languages,
``2 ** LEAST_BITS`` at least. That bounds what is broadcast, and portions of text shrink with the number of languages.

Defined results: a null text, one without letters, or a model without languages gives ``und`` with score 0.
Ties go to the language that sorts first. Rows without a language or an id do not train. Repeated rows count
once each in training and get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import column, free_name
from termloom.llm.workers import tidy

UNKNOWN = "und"
SAMPLE = 4_000
BITS, LEAST_BITS = 16, 8
WEIGHTS = 1 << 22
SWITCH = 15.0
# A language writes in the scripts that make up this share of its letters.
SCRIPT_SHARE = 0.01
# Texts are scored in portions of so many characters, and paths found for so many scores, at a time.
PORTION = 1 << 18
# Languages for which portions are that long; with more, they are shorter.
USUAL_LANGUAGES = 16
SCORES = 1 << 21

# First and last code points of scripts; letters elsewhere count as one script more.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x3FFFF),
)
SCRIPT_NAMES = tuple(dict.fromkeys(["other", *(name for name, _, _ in SCRIPTS)]))
PREDICTION = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("start", T.IntegerType()),
                        T.StructField("end", T.IntegerType()),
                        T.StructField("lang", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)


@lru_cache(maxsize=1)
def _script_of_letter() -> np.ndarray:
    """Per code point: 0 for what is no letter, else 1 + the place of its script in SCRIPT_NAMES."""
    script = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=np.uint8, count=0x110000)
    for name, first, last in SCRIPTS:
        script[first : last + 1] *= 1 + SCRIPT_NAMES.index(name)
    return script


@dataclass
class _Words:
    """The words of some texts: for each word its text, first and last character, script and letters."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    first_letter: np.ndarray
    features: np.ndarray | None  # two rows, one column per letter; dropped when they are scored


def bits_for(languages: int) -> int:
    """Bits of the hash of a letter group, so that the model keeps its size."""
    return max(LEAST_BITS, min(BITS, (WEIGHTS // max(1, languages)).bit_length() - 1))


def _words(texts: list[str], bits: int) -> _Words:
    # Lower case letter by letter, so that places in the lowered text are places in the text.
    lowered = [low if len(low := t.lower()) == len(t) else "".join(c.lower()[0] for c in t) for t in texts]
    code = np.frombuffer(("\0".join(lowered) + "\0").encode("utf-32-le", "replace"), "<u4")
    script = _script_of_letter()[code]
    letter = script > 0
    place = np.flatnonzero(letter)
    x = np.where(letter, code, 0).astype(np.uint32)
    before = np.concatenate([[0], x[:-1]]).astype(np.uint32)
    after = np.concatenate([x[1:], [0]]).astype(np.uint32)
    a, b, c = before[place], x[place], after[place]
    pair = (b * np.uint32(0x9E3779B1)) ^ (c * np.uint32(0x85EBCA77))
    triple = pair ^ (a * np.uint32(0xC2B2AE3D)) ^ np.uint32(0x27D4EB2F)
    mixed = [((f ^ (f >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits) for f in (pair, triple)]
    first = np.flatnonzero(a == 0)
    lengths = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(lengths)
    owner = np.searchsorted(ends, place[first], side="right")
    offset = (ends - lengths)[owner]
    last = np.append(first[1:], len(place))[: len(first)] - 1
    start, end = place[first] - offset, place[last] + 1 - offset
    letters = np.diff(first, append=len(place))
    return _Words(owner, start, end, script[place[first]] - 1, letters, first, np.stack(mixed))


@dataclass
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # float32, a row per feature, a column per language
    writes: np.ndarray  # bool, a row per script, a column per language
    bits: int = BITS

    def word_scores(self, words: _Words) -> np.ndarray:
        """A row per word, a column per language; languages that do not write in its script are far below."""
        n = len(words.first_letter)
        scores = np.zeros((n, len(self.languages)), np.float32)
        if not n:
            return scores
        letters = self.weights[words.features[0]]
        letters += self.weights[words.features[1]]
        np.add.reduceat(letters, words.first_letter, axis=0, out=scores)
        candidates = self.writes[words.script]
        none = ~candidates.any(axis=1)
        scores[~candidates] = -1e6
        scores[none] = 0
        return scores


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; texts stand one after the other and are stepped through side by side."""
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")
    moved = np.zeros(scores.shape, bool)  # whether the best way to (word, label) comes from another label
    origin = np.zeros(len(scores), np.int16)  # that other label, the best one of the word before
    labels = np.zeros(len(scores), np.int16)
    value = np.zeros((len(lengths), scores.shape[1]), np.float32)
    for step, n in enumerate(active):
        at = starts[:n] + step
        now = value[:n]
        if step:
            origin[at] = now.argmax(axis=1)
            best = now.max(axis=1, keepdims=True) - np.float32(switch)
            moved[at] = now < best
            np.maximum(now, best, out=now)
            now -= best  # only differences matter, and long texts would lose them
        now += scores[at]
    label = value.argmax(axis=1).astype(np.int16)
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        at = starts[:n] + step
        here = label[:n]
        labels[at] = here
        label[:n] = np.where(moved[at, here], origin[at], here)
    return labels


def _portions(texts: list[str], size: int) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def predict(texts: list[str], model: LanguageModel, with_spans: bool = False) -> pd.DataFrame:
    """``lang_pred``, ``score`` and, if asked for, ``spans`` of each text."""
    result = {"lang_pred": np.full(len(texts), UNKNOWN, object), "score": np.zeros(len(texts)), "spans": None}
    spans: list[list] = [[] for _ in texts]
    if not model.languages:
        return pd.DataFrame(result | {"spans": spans if with_spans else None}, index=range(len(texts)))
    waiting: list[tuple[int, _Words, np.ndarray]] = []

    def settle() -> None:
        n_texts = waiting[-1][0] + 1 + int(waiting[-1][1].text.max(initial=0)) - (base := waiting[0][0])
        owner = np.concatenate([w.text + at - base for at, w, _ in waiting])
        labels = viterbi(np.concatenate([s for *_, s in waiting]), np.bincount(owner, minlength=n_texts))
        letters = np.concatenate([w.letters for _, w, _ in waiting])
        share = np.zeros((n_texts, len(model.languages)))
        np.add.at(share, (owner, labels), letters)
        total = share.sum(axis=1)
        found = np.flatnonzero(total)
        best = share[found].argmax(axis=1)
        result["lang_pred"][base + found] = np.array(model.languages, object)[best]
        result["score"][base + found] = share[found, best] / total[found]
        if with_spans:
            start, end = (np.concatenate([getattr(w, k) for _, w, _ in waiting]) for k in ("start", "end"))
            new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
            last = np.concatenate([new[1:], [len(owner)]]).astype(np.int64) - 1
            for i, j in zip(new, last, strict=True):
                span = {"start": int(start[i]), "end": int(end[j]), "lang": model.languages[labels[i]]}
                spans[base + owner[i]].append(span)
        waiting.clear()

    held = 0
    portion = PORTION * USUAL_LANGUAGES // max(USUAL_LANGUAGES, len(model.languages))
    for start, end in _portions(texts, portion):
        words = _words(texts[start:end], model.bits)
        if len(words.text):
            waiting.append((start, words, model.word_scores(words)))
            words.features = None
            held += waiting[-1][2].size
        if held >= SCORES:
            settle()
            held = 0
    if waiting:
        settle()
    return pd.DataFrame(result | {"spans": spans if with_spans else None}, index=range(len(texts)))


def _count_features(bits: int):
    """A task function: ``(lang, kind, place, n)``, how often it saw each letter group, and each script, of a language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                texts = texts.tolist()
                for start, end in _portions(texts, PORTION):
                    words = _words(texts[start:end], bits)
                    counts = np.bincount(words.features.ravel(), minlength=1 << bits)
                    written = np.bincount(words.script, weights=words.letters, minlength=len(SCRIPT_NAMES))
                    groups[lang] = groups.get(lang, 0) + counts
                    scripts[lang] = scripts.get(lang, 0) + written.astype(np.int64)
        for kind, found in (("group", groups), ("script", scripts)):
            for lang, counts in found.items():
                place = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": lang, "kind": kind, "place": place, "n": counts[place]})

    return count


def fit(
    docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE
) -> LanguageModel:
    """A model from a sample of the rows of ``docs`` for which ``usable`` holds and the language is not null."""
    labelled = docs.where(usable & column(lang).isNotNull() & column(doc_id).isNotNull())
    labelled = labelled.select(
        column(lang).alias("lang"), F.coalesce(column(text), F.lit("")).alias("text"), column(doc_id).alias("id")
    )
    # One row per label.
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang")
    languages = {row["lang"]: row["n"] for row in counts.collect()}
    bits = bits_for(len(languages))
    if not languages:
        return LanguageModel((), np.zeros((1 << bits, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool), bits)
    rates = F.create_map(*[F.lit(x) for k, n in languages.items() for x in (k, min(1.0, sample / n))])
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.where(place < F.element_at(rates, F.col("lang"))).select("lang", "text")
    found = (
        chosen.mapInPandas(tidy(_count_features(bits)), "lang string, kind string, place int, n bigint")
        .groupBy("lang", "kind", "place")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    names = tuple(sorted(found["lang"].unique()))
    groups = np.full((1 << bits, len(names)), 0.5)
    scripts = np.zeros((len(SCRIPT_NAMES), len(names)))
    for (name, kind), rows in found.groupby(["lang", "kind"]):
        (groups if kind == "group" else scripts)[rows["place"], names.index(name)] += rows["n"]
    weights = np.log(groups / groups.sum(axis=0)).astype(np.float32)
    return LanguageModel(names, weights, scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1), bits)


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "language", with_spans: bool = False
) -> DataFrame:
    """``docs`` with a struct column: ``lang_pred``, ``score`` and, if asked for, ``spans``.

    Places in spans count characters; ``end`` is behind the last one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = PREDICTION if with_spans else T.StructType(PREDICTION.fields[:2])

    @tidy
    def predictions(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield predict(batch.tolist(), shared.value, with_spans)[fields.names]

    @F.pandas_udf(fields)
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from predictions(batches)

    return docs.withColumn(free_name(docs, name), language(F.coalesce(column(text), F.lit(""))))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training, by a checksum of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_filter(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Documents whose language is found for at least ``min_score`` of their letters, columns as in ``docs``."""
    model = fit(docs, ~held_out(F.col("doc_id")))
    name = free_name(docs, "language")
    found = identify(docs, model, name=name)
    ok = (column(name)["lang_pred"] != UNKNOWN) & (column(name)["score"] >= min_score)
    return found.where(ok).select(*map(column, docs.columns))
