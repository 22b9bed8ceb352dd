from __future__ import annotations

import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, names that clash."""
    draw = random.Random(3)
    long = " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "épsilon"])
                    for _ in range(60_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3),
            (4, "123 456 !!", "en", None, 10), (None, "one two three four five six", "en", "b", 27),
            (5, long, "en", "a", len(long)), (6, long + " end", "en", "b", 0),
            (7, "one two three four five six", "en", "b", 27),
            (7, "one two three four five six", "en", "b", 27),
            (8, "ONE two\x0bthree four FIVE six", "de", "c", 27), (9, "two words", "de", "c", 9),
            (10, "TWO  words", "de", "c", 9), (11, "a\x00b <|endoftext|> Σ ŠŠ", "fr", "c", 5)]
    table = spark.createDataFrame(rows, DOCS)
    for name in "score size taken row n name rep a b id component _order _row".split():
        table = table.selectExpr("*", f"'x' AS {name}")
    return table


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
