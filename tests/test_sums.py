"""Exact sums of doubles: rounded once, whatever the order, the partitions and the partial sums."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from termloom.functions.sums import exact_parts, exact_sum, exact_value, merged_parts
from termloom.operators import toplists as L


def frame(spark, rows):
    return spark.createDataFrame(rows, "g int, x double")


def sums(df):
    return {r["g"]: r["s"] for r in df.groupBy("g").agg(exact_sum(F.col("x")).alias("s")).collect()}


def bits(x):
    return struct.pack(">d", x)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)

    def value():
        near = math.nextafter(1.0, rng.choice([0.0, 2.0]))
        wide = rng.uniform(-1, 1) * 10.0 ** rng.randint(-18, 24)
        return rng.choice([wide, rng.random(), near, 0.1, -0.1, 2.0**-60, -(2.0**-66), 1e17, -1e17, 3.0, 0.0])

    return [(g, value()) for g in range(150) for _ in range(rng.randint(1, 50))]


def test_rounded_once(spark, rows):
    found = sums(frame(spark, rows))
    assert {g: bits(x) for g, x in found.items()} == {g: bits(math.fsum(x for k, x in rows if k == g) + 0.0) for g in found}


def test_any_order_and_partial_sums(spark, rows):
    found = sums(frame(spark, rows))
    shuffled = random.Random(4).sample(rows, len(rows))
    assert sums(frame(spark, shuffled).repartition(37)) == found
    parts = frame(spark, shuffled).withColumn("part", F.pmod(F.xxhash64("x"), F.lit(5)))
    parts = parts.groupBy("g", "part").agg(exact_parts(F.col("x")).alias("p"))
    merged = parts.groupBy("g").agg(merged_parts(F.col("p")).alias("p")).select("g", exact_value(F.col("p")).alias("s"))
    assert {r["g"]: r["s"] for r in merged.collect()} == found


def test_halfway_cases_go_to_even(spark):
    unit = 2.0**-52
    cases = {
        0: ([1.0, unit / 2], 1.0),
        1: ([1.0 + unit, unit / 2], 1.0 + 2 * unit),
        2: ([1.0, unit / 2, 2.0**-118], 1.0 + unit),
        3: ([1.0, unit / 2, -(2.0**-118)], 1.0),
        4: ([-1.0, -unit / 2, -(2.0**-118)], -1.0 - unit),
        5: ([1e26, -1e26, 2.0**-66], 2.0**-66),
    }
    found = sums(frame(spark, [(g, x) for g, (values, _) in cases.items() for x in values]))
    assert found == {g: total for g, (_, total) in cases.items()}


def test_nulls_and_values_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, None), (1, None), (1, 2.5), (2, inf), (2, 1.0), (3, nan), (3, 1.0), (4, inf), (4, -inf), (5, -inf)]
    found = sums(frame(spark, rows))
    assert found[0] is None and found[1] == 2.5 and found[2] == inf and found[5] == -inf
    assert math.isnan(found[3]) and math.isnan(found[4])


def test_values_beyond_the_range_are_an_error(spark):
    with pytest.raises(Exception, match="exact sum"):
        sums(frame(spark, [(0, 1e30)]))


@pytest.mark.parametrize("partitions", [1, 200])
def test_ranks_have_the_same_bits(spark, partitions):
    """Sums that adding in another order would round otherwise: every order of adding gives one result."""
    rng = random.Random(6)
    values = [rng.random() for _ in range(300)]
    rows = [(t, d, w) for t in range(6) for d, w in enumerate(rng.sample(values, len(values)))]
    rows.append((7, 0, math.nextafter(math.fsum(values), 1e9)))
    weights = spark.createDataFrame(rows, "term_id bigint, doc_id bigint, tfidf double").repartition(partitions)
    docs = spark.createDataFrame([(d, f"c.{d}") for d in range(300)], "doc_id bigint, doc_name string")
    terms = spark.createDataFrame([(t, f"t{t}") for t in range(8)], "term_id bigint, term string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        top = L.top_terms_by_class(L.avg_tfidf_by_class(weights, docs, terms), 7).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert [r["term"] for r in sorted(top, key=lambda r: r["rk"])] == ["t7", *[f"t{t}" for t in range(6)]]
    assert len({bits(r["avg_tfidf"]) for r in top if r["term"] != "t7"}) == 1
