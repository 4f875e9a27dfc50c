import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.llm import license_scan as L
from termloom.llm import quality_rules as Q
from termloom.llm.license_texts import LICENSES
from tests.llm.conftest import SCHEMA, TEXTS


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def counts(df):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return [tuple(r["m"][n] for n in names) for r in df.select(F.col("measured").alias("m")).collect()]


def test_measures_of_tricky_texts(spark):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    assert counts(Q.measures(docs)) == [brute(t) for _, t, _, _ in TEXTS]


def test_measures_of_random_texts(spark):
    found = []

    @settings(max_examples=200, deadline=None, database=None)
    @given(st.text(alphabet="ab \n\t\x0b#é", max_size=60))
    def collect(text):
        found.append(text)

    collect()
    docs = spark.createDataFrame([(t,) for t in found], "text string").repartition(1)
    rows = Q.measures(docs).select("text", "measured").collect()
    assert counts(Q.measures(docs)) == [brute(r["text"]) for r in rows]


def test_verdicts_keep_rows_and_columns(tricky, empty):
    judged = Q.quality_verdicts(tricky)
    assert Q.measured_as(tricky) == "measured_"
    assert judged.columns == [*tricky.columns, "measured_"]
    assert judged.count() == tricky.count()
    assert Q.quality_filter(tricky).columns == tricky.columns
    assert Q.quality_verdicts(empty).count() == 0


def test_buckets_are_in_order_and_narrow(spark):
    rows = spark.range(0, 200_000, 7).select("id", Q.bucket(F.col("id")).alias("b"))
    rows = rows.select("id", "b", Q.bucket_value(F.col("b")).alias("top")).orderBy("id").collect()
    assert all(a["b"] <= b["b"] for a, b in zip(rows, rows[1:]))
    assert all(r["id"] <= r["top"] <= r["id"] * (1 + 1 / 32) for r in rows)


@pytest.fixture(scope="module")
def sources(spark):
    """A source of clean text, one whose text is full of symbols as a rule, a small one."""
    clean = "plain words without any marks stand in this text which is long enough to be judged"
    rows = [(i, f"{clean} {i}", "en", "clean") for i in range(80)]
    rows += [(100 + i, " ".join(f"$w{i}x{k} #" for k in range(30)), "en", "code") for i in range(80)]
    rows += [(200, clean + " | " * 40, "en", "clean"), (201, clean, "en", "tiny"), (202, clean, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_limits_follow_the_source(sources):
    kept = {r["doc_id"]: r["measured"]["kept"] for r in Q.quality_verdicts(sources).collect()}
    assert all(kept[i] for i in range(80)), "clean text stays"
    assert not kept[200], "marks are unusual in the clean source"
    assert all(kept[i] for i in range(100, 180)), "and usual in the other one"
    assert kept[201] and kept[202]


def test_sketches_merge(sources):
    name = Q.measured_as(sources)
    measured = Q.measures(sources)
    halves = [measured.where(F.col("doc_id") % 2 == k) for k in (0, 1)]
    merged = Q.sketches(halves[0], name).union(Q.sketches(halves[1], name))
    whole = {r["key"]: r["limits"] for r in Q.learn_limits(Q.sketches(measured, name)).collect()}
    assert {r["key"]: r["limits"] for r in Q.learn_limits(merged).collect()} == whole


def test_beyond_the_broadcast_limit(sources, monkeypatch):
    name = Q.measured_as(sources)
    measured = Q.measures(sources)
    limits = Q.learn_limits(Q.sketches(measured, name))
    near = {tuple(r) for r in Q.judge(measured, name, limits).select("doc_id", f"{name}.kept").collect()}
    monkeypatch.setattr(Q.Dictionary, "fits_per_row", lambda self, n: False)
    far = {tuple(r) for r in Q.judge(measured, name, limits).select("doc_id", f"{name}.kept").collect()}
    assert near == far


def test_no_python_in_quality_plan(sources):
    plan = Q.quality_verdicts(sources)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- licences ---------------------------------------------------------------------------------------------


def test_licenses_in_other_dress(spark):
    known = L.known_licenses(spark)
    rows = []
    for i, (name, text) in enumerate(LICENSES):
        dressed = "Copyright (c) 2020 Some One\n\n  (C) 1999, other\n" + text.upper().replace(" ", "\n   ").replace(".", " . ")
        rows += [(i, name, dressed), (1000 + i, None, text + " and more"), (2000 + i, name, text.replace("license", "licence"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, expected string, text string")
    for r in L.scan(docs, known).collect():
        assert r["license_id"] == r["expected"], r


def test_license_notices_and_edges(spark, tricky, empty):
    known = L.known_licenses(spark)
    docs = spark.createDataFrame(
        [(1, "Some text.\nReleased under the MIT Licence!\nmore\nLicensed under CC BY 4.0"), (2, "---"), (3, None)],
        "doc_id bigint, text string",
    )
    rows = {r["doc_id"]: r for r in L.scan(docs, known).collect()}
    assert rows[1]["notices"] == "CC-BY-4.0,MIT" and rows[1]["license_id"] is None
    assert rows[2]["text_digest"] is None and rows[3]["text_digest"] is None
    found = L.scan(tricky, known)
    assert found.count() == tricky.count() and "text_digest_" in found.columns
    assert L.scan(empty, known).count() == 0
    nothing = known.where("false")
    assert L.scan(docs, nothing).where("license_id is not null or notices is not null").count() == 0


def test_license_join_beyond_the_broadcast_limit(spark, monkeypatch):
    known = L.known_licenses(spark)
    docs = spark.createDataFrame([(i, "Released under the MIT License.") for i in range(50)] + [(99, "no")], "doc_id int, text string")
    monkeypatch.setattr(L.Dictionary, "fits", lambda self: False)
    rows = L.scan(docs, known).collect()
    assert len(rows) == 51 and sum(r["license_id"] == "MIT" and r["notices"] == "MIT" for r in rows) == 50


def _limits(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = Q.learn_limits(Q.sketches(Q.measures(docs), Q.measured_as(docs))).collect()
    return {r["key"]: r["limits"].asDict() for r in found}


def _worded(first, n, length, source):
    """Documents of words whose mean length differs from one to the next."""
    return [(first + i, " ".join(chr(97 + k) * (length + (i * k) % (length // 2)) for k in range(20)), "en", source) for i in range(n)]


def test_limits_differ_where_sketches_do(spark):
    limits = _limits(spark, _worded(0, 200, 4, "short") + _worded(1000, 200, 30, "long"))
    short, long_ = ([v for k, v in limits.items() if f'"{s}"' in k][0] for s in ("short", "long"))
    least = Q.FENCE * Q.LEAST_SPREAD["word_length"]
    assert long_["word_length"] - short["word_length"] > 10_000 > least
    assert all(limit["repeats"] < 10 * Q.MAX_REPEATED_PERCENT for limit in limits.values()), "below what fails anyway"


def test_groups_count_by_their_size_without_a_step(spark):
    def limit(n):
        limits = _limits(spark, _worded(0, 400, 4, "short") + _worded(1000, n, 30, "long"))
        return [v["word_length"] for k, v in limits.items() if '"long"' in k][0]

    few, one_less, one_more, many = (limit(n) for n in (5, 49, 50, 300))
    assert few < one_less <= one_more + 300 < many
    assert abs(one_more - one_less) < (many - few) / 10
