"""Small awkward tables: nulls, empty and long texts, repeated rows, names that clash."""

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _rank int, key string, score double"


@pytest.fixture(scope="session")
def odd_docs(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [
        (1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "b", 0), (4, " \n\t ", "en", "a", 4),
        (None, "no id at all here", "fr", None, 3), (5, "Ünï çödé ☃ 𝒳 " * 3, "fr", "c", 9), (6, "word " * 40_000, "en", "b", 7),
        (7, text + " lambda", "en", "ü", 8), (8, "12345 67890 !!", "en", "a", 8), (9, text.upper(), None, "a", 8),
        (10, "x" * 200_000, "de", "c", 8), (11, "same\nsame\n\nsame\nlast line", "de", "b", 8), (None, "no id at all here", "fr", None, 3),
    ]
    return spark.createDataFrame([(*r, 1, "k", 0.5) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where(F.lit(False))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
