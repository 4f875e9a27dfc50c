import pytest

CLASHING = ("measured", "fingerprint", "language", "part", "row", "chunk", "n", "key", "text_digest", "group_key", "a.b")

LONG = "one two three four five six seven eight nine ten. " * 3000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away from it all", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away from it all", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \t\n\x0b ", "de", "b"),
    (6, LONG, "de", "b"),
    (7, "x" * 40_000, None, None),
    (8, "été 漢字 \U0001f600 ça\n\nça va bien, où es-tu? l'été\n  déjà vu ", "fr", "b"),
    (None, "no id but ten words stand here in this one text", "en", "a"),
    (9, "naïve café <|endoftext|> $$$ ### it's 123 they'll", "fr", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def tricky(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with taken names."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(TEXTS, SCHEMA)
    return docs.select("*", *[F.lit("taken").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
