import os

import pytest


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "a", 1),
        (2, None, None, None, None), (3, "", "en", "b", 0), (4, " \n\t ", None, "b", 3), (5, long, "en", None, len(long)),
        (6, long, "en", "b", len(long)), (7, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "a", 1),
        (7, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "a", 1),
        (None, "a row without an id", "en", "a", 1), (8, "ein kurzer Satz. 日本語 \U0001f600 ﬁ", "de", "a", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("ids", "decoded", "score", "key", "name", "edges", "blob", "class_id", "leaks", "id", "doc", "word"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.fixture(scope="session")
def sf(tables):
    return os.path.normpath(tables)
