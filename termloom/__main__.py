"""Command line: one subcommand per result.

    python -m termloom term-frequency --corpus DIR --terms FILE --docs FILE --stopwords FILE --out DIR
    python -m termloom low-frequency  --matrix DIR --out DIR
    python -m termloom totals         --matrix DIR --out DIR
    python -m termloom top-frequency  --matrix DIR --terms FILE --out DIR
    python -m termloom tf             --matrix DIR --out DIR
    python -m termloom tfidf          --matrix DIR --corpus DIR --out DIR
    python -m termloom class-averages --weights DIR --terms FILE --docs FILE --out DIR
    python -m termloom top-avg-tfidf  --weights DIR --terms FILE --docs FILE --out DIR
    python -m termloom per-document   --corpus DIR --terms FILE --docs FILE --stopwords FILE --out DIR
    python -m termloom all            --corpus DIR --terms FILE --docs FILE --stopwords FILE --out DIR

Commands with ``--matrix`` or ``--weights`` read the text of earlier steps, so the steps can be run one by one;
lines that are no row of such a text are written to ``OUT.rejects`` and counted. ``all`` runs the five main steps
as one job from the raw corpus. A command takes the flags it has a use for and no others. Spark settings come from
``spark-submit`` or the cluster's defaults.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from termloom.operators import counts as C
from termloom.operators import toplists as L
from termloom.operators import weights as W
from termloom.operators.lookup import BROADCAST_LIMIT
from termloom.plans.pipeline import TermStatistics
from termloom.session import Scratch, get_session
from termloom.sinks.text import write_matrix, write_rows
from termloom.sources.corpus import count_corpus_files
from termloom.sources.dictionary import load_doc_dictionary, load_term_dictionary
from termloom.sources.triples import COUNTS, WEIGHTS, parse_once, read_lines


def _statistics(spark: SparkSession, args) -> TermStatistics:
    names = ("lowercase", "min_total", "top", "top_per_class", "report_format", "partitions", "broadcast_limit")
    options = {name: value for name, value in vars(args).items() if name in names}
    if "plain_idf" in args:
        options["smooth"] = not args.plain_idf
    return TermStatistics.from_files(spark, args.corpus, args.terms, args.docs, args.stopwords, **options)


def _good(spark: SparkSession, path: str, schema: dict[str, str], strict: bool, args) -> DataFrame:
    """The rows of a text; its other lines are written beside the output and counted. The text is read once."""
    parsed = parse_once(read_lines(spark, path), schema, strict)
    rejects = args.out.rstrip("/") + ".rejects"
    parsed.rejects.write.text(rejects)
    print(f"{parsed.n_rows} rows read, {parsed.n_rejects} lines rejected, see {rejects}")
    return parsed.rows


def term_frequency(spark, args):
    run = _statistics(spark, args)
    write_matrix(run.counts, args.out, args.ordered)
    run.close()


def per_document(spark, args):
    run = _statistics(spark, args)
    run.write_per_document(args.out)
    run.close()


def low_frequency(spark, args):
    matrix = _good(spark, args.matrix, COUNTS, True, args)
    write_matrix(C.low_frequency_filter(matrix, args.min_total), args.out, args.ordered)


def totals(spark, args):
    write_rows(C.term_totals(_good(spark, args.matrix, COUNTS, True, args)), args.out)


def top_frequency(spark, args):
    totals = C.term_totals(_good(spark, args.matrix, COUNTS, True, args))
    top = L.top_terms(totals, load_term_dictionary(spark, args.terms, args.broadcast_limit), args.top)
    write_rows(top.select("term", "frequency"), args.out)


def _foreign(spark, args) -> DataFrame:
    return C.dedupe_triples(_good(spark, args.matrix, COUNTS, False, args))


def tf(spark, args):
    write_matrix(W.term_weight_tf(_foreign(spark, args)), args.out, args.ordered)


def tfidf(spark, args):
    n_docs = count_corpus_files(spark, args.corpus)
    weights = W.tfidf(_foreign(spark, args), n_docs, min_total=None, smooth=not args.plain_idf)
    write_matrix(weights, args.out, args.ordered)


def _averages(spark, args) -> DataFrame:
    limit = args.broadcast_limit
    terms, docs = load_term_dictionary(spark, args.terms, limit), load_doc_dictionary(spark, args.docs, limit)
    return L.avg_tfidf_by_class(_good(spark, args.weights, WEIGHTS, False, args), docs, terms)


def class_averages(spark, args):
    write_rows(_averages(spark, args), args.out)


def top_avg_tfidf(spark, args):
    top = L.top_terms_by_class(_averages(spark, args), args.top_per_class)
    write_rows(L.class_report(top, args.report_format), args.out)


def run_all(spark, args):
    run = _statistics(spark, args)
    run.write_all(args.out, args.ordered)
    run.close()


FLAGS = {
    "min-total": dict(type=int, default=C.MIN_TOTAL, help="corpus total a kept term needs"),
    "top": dict(type=int, default=L.TOP_TERMS, help="length of the list of frequent terms"),
    "top-per-class": dict(type=int, default=L.TOP_PER_CLASS, help="length of the list of each class"),
    "report-format": dict(help="printf format of the report's values, such as %%.6f; whole doubles by default"),
    "lowercase": dict(action="store_true", help="fold case before cleaning"),
    "plain-idf": dict(action="store_true", help="ln(N/df) in place of the smoothed form"),
    "ordered": dict(action="store_true", help="sort matrix files by the bytes of both ids"),
    "partitions": dict(type=int, default=0, help="tasks the texts are dealt to first, for inputs of few files"),
    "broadcast-limit": dict(type=int, default=BROADCAST_LIMIT, help="bytes of a dictionary that may be broadcast"),
}
RAW = ("corpus", "terms", "docs", "stopwords")
TEXT = ("lowercase", "partitions", "broadcast-limit")
COMMANDS = {
    "term-frequency": (term_frequency, RAW, ("ordered", *TEXT)),
    "low-frequency": (low_frequency, ("matrix",), ("min-total", "ordered")),
    "totals": (totals, ("matrix",), ()),
    "top-frequency": (top_frequency, ("matrix", "terms"), ("top", "broadcast-limit")),
    "tf": (tf, ("matrix",), ("ordered",)),
    "tfidf": (tfidf, ("matrix", "corpus"), ("plain-idf", "ordered")),
    "class-averages": (class_averages, ("weights", "terms", "docs"), ("broadcast-limit",)),
    "top-avg-tfidf": (
        top_avg_tfidf,
        ("weights", "terms", "docs"),
        ("top-per-class", "report-format", "broadcast-limit"),
    ),
    "per-document": (per_document, RAW, TEXT),
    "all": (run_all, RAW, ("min-total", "top", "top-per-class", "report-format", "plain-idf", "ordered", *TEXT)),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="termloom", description="Term statistics over labelled text corpora")
    commands = top.add_subparsers(dest="command", required=True)
    for name, (_, inputs, flags) in COMMANDS.items():
        command = commands.add_parser(name, allow_abbrev=False)
        for each in (*inputs, "out"):
            command.add_argument(f"--{each}", required=True)
        for flag in flags:
            command.add_argument(f"--{flag}", **FLAGS[flag])
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    with Scratch() as scratch:
        COMMANDS[args.command][0](get_session(f"termloom {args.command}"), args)
    scratch.close()


if __name__ == "__main__":
    main()
