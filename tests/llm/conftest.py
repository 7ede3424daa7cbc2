import pytest
from pyspark.sql import functions as F

ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, "Ünï words\n\nwords words \t x", "de", "a", 3),
    (3, "Ünï words\n\nwords words \t x", "de", "a", 3),
    (None, "a text without an id", "en", None, 1),
    (4, "long " * 30_000, "en", "b", None),
    (5, "   \n \t ", "en", "b", 7),
    (6, "no spaces " + "x" * 20_000, "en", "c", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, a repeated row, and columns that clash with results."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    more = {c: F.lit("clash") for c in ("digest", "size", "score", "kept", "key", "n_words", "tokens", "_hit", "rep")}
    return docs.withColumns(more)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
