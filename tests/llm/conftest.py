from __future__ import annotations

import pytest

#: Columns that operators use inside, and columns of their results.
CLASHES = ["hash", "uid", "node", "n_words", "sequence_id", "key", "row", "score", "lang_pred", "kind", "start", "label"]


@pytest.fixture(scope="session")
def clashing():
    """Adds columns with clashing names to a frame."""
    from pyspark.sql import functions as F

    return lambda df: df.select("*", *(F.lit("x").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def documents(spark, clashing):
    """Null, empty, blank, repeated, tied and very long texts, null ids."""
    prose = " ".join(f"word{i % 97} thing{i % 89}" for i in range(150))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "  \n ", None, "b"), (4, prose, "en", "a"),
        (5, prose, "en", "b"), (6, prose + " one more end", "en", "b"), (7, "Ünïcödé 漢字 \U0001f642 text", "de", None),
        (7, "Ünïcödé 漢字 \U0001f642 text", "de", None), (None, "no id at all here", "en", "c"), (9, "short", None, "c"),
        (10, "x" * 30_000 + " " + "long " * 20_000, "en", "a"), (11, "12345 !!", "en", "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return clashing(df.selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars"))
