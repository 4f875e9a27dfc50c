"""Readers of plain-text matrices and pair lists. Every reader returns ``(rows, rejects)``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import fields_of
from termloom.session import materialize

COUNTS = {"term_id": "bigint", "doc_id": "bigint", "freq": "bigint"}
WEIGHTS = {"term_id": "bigint", "doc_id": "bigint", "tfidf": "double"}
TOTALS = {"term_id": "bigint", "total": "bigint"}
TOP_LIST = {"term": "string", "frequency": "bigint"}
AVERAGES = {"class": "string", "term": "string", "avg_tfidf": "double"}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _tagged(lines: DataFrame, schema: dict[str, str], strict: bool) -> DataFrame:
    """``(value, good, *schema)`` of every line: its text, whether it is a row, and its typed fields."""
    # Exploding a one-element array keeps the split in one place: the optimizer would move the conditions
    # below a plain projection and repeat the split in each of them.
    fields = lines.select("value", F.explode(F.array(fields_of(F.col("value")))).alias("fields"))
    typed = [
        (F.get("fields", i) if kind == "string" else F.get("fields", i).try_cast(kind)).alias(name)
        for i, (name, kind) in enumerate(schema.items())
    ]
    shaped = F.size("fields") == len(schema) if strict else F.size("fields") >= len(schema)
    parsed = fields.select("value", shaped.alias("shaped"), *typed)
    good = F.col("shaped")
    for name in schema:
        good = good & F.col(name).isNotNull()
    return parsed.select("value", good.alias("good"), *schema)


def _parse(lines: DataFrame, schema: dict[str, str], strict: bool) -> tuple[DataFrame, DataFrame]:
    tagged = _tagged(lines, schema, strict)
    return tagged.where("good").select(*schema), tagged.where("NOT good").select("value")


@dataclass
class Parsed:
    """Rows and rejects of a text that was read once, with their numbers."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


def parse_once(lines: DataFrame, schema: dict[str, str], strict: bool) -> Parsed:
    """Every line is read and split once: rows and rejects go into one table, each under its tag, and are counted on
    the way. Of rows the fields are kept, of rejects the line."""
    tagged = _tagged(lines, schema, strict)
    seen = Observation()
    counted = tagged.observe(seen, F.count_if("good").alias("rows"), F.count_if(~F.col("good")).alias("rejects"))
    stored = materialize(
        counted.select("good", F.when(~F.col("good"), F.col("value")).alias("value"), *[F.when(F.col("good"), F.col(c)).alias(c) for c in schema]),
        "parsed",
        by="good",
    )
    rows, rejects = stored.where("good").select(*schema), stored.where("NOT good").select("value")
    return Parsed(rows, rejects, seen.get["rows"], seen.get["rejects"])


def parse_strict(lines: DataFrame, schema: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Lines with exactly as many fields as ``schema``."""
    return _parse(lines, schema, strict=True)


def parse_lenient(lines: DataFrame, schema: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Lines with at least as many fields as ``schema``; further fields are ignored."""
    return _parse(lines, schema, strict=False)


def read_counts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_strict(read_lines(spark, path), COUNTS)


def read_weights(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_lenient(read_lines(spark, path), WEIGHTS)


def read_totals(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_strict(read_lines(spark, path), TOTALS)


def read_averages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_lenient(read_lines(spark, path), AVERAGES)
