"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Dictionaries are inputs of a run and are built before the clock starts. Each query is run once to warm the
JVM up and then timed; its whole result is computed and dropped. ``cold_total`` is the time of dictionaries and
first runs together. ``beyond_limit`` has tf-idf with dictionaries that may not be broadcast, tables written on
the way included.
"""

from __future__ import annotations

import json
import os
import time

from catalog import fixtures as X
from catalog.queries import QUERIES
from termloom.operators.lookup import Dictionary
from termloom.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
HEADLINE = (
    "clean_tokens",
    "term_doc_counts",
    "term_totals",
    "low_frequency_filter",
    "top_terms",
    "idf",
    "tfidf",
    "avg_tfidf_by_class",
    "top_terms_by_class",
    "class_report",
)


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def beyond_limit(spark) -> dict[str, float]:
    times = {}
    for name, large in (("terms", ("terms",)), ("docs", ("docs",)), ("both", ("terms", "docs"))):
        start = time.perf_counter()
        run = X.statistics(spark, SF_DIR)
        for each in large:
            setattr(run, each, Dictionary(getattr(run, each).df, 0))
        run.tfidf.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        run.close()
    return times


def main() -> None:
    spark = get_session(
        "termloom-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    X.terms(spark, SF_DIR), X.docs(spark, SF_DIR)
    dictionaries = time.perf_counter() - start
    first_runs = sum(seconds(spark, name) for name in HEADLINE)
    times = {name: round(min(seconds(spark, name) for _ in range(REPEATS)), 3) for name in HEADLINE}
    result = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "dictionaries": round(dictionaries, 3),
        "cold_total": round(dictionaries + first_runs, 3),
        "beyond_limit": beyond_limit(spark),
        "cpus": int(CPUS),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
