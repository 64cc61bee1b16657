from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, and columns whose names the operators use."""
    long = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [
        (1, "alpha beta gamma delta", "en", "a", 22), (1, "alpha beta gamma delta", "en", "a", 22), (2, None, None, None, None),
        (3, "", "en", "b", 0), (4, " \t\n\x0b\x0c\r ", "en", "b", 7), (None, "alpha beta gamma delta", "en", None, 22), (None, None, None, None, None),
        (5, long, "en", "a", len(long)), (6, long, "en", "c", len(long)), (7, "é ß 😀 ÀB c", "fr", "é", 9), (8, "x", "en", "", 1),
        (9, "same line\nsame line\nsame line\n" * 30, "en", "a", 900), (10, "ALPHA beta\tgamma  delta", "en", "c", 23),
    ]
    extra = [(*r, 1, "h", 0.5, "t", [1], 7, 3, "fp", 9) for r in rows]
    return spark.createDataFrame(
        extra, DOCS + ", h int, words string, score double, token string, rules array<int>, row int, copies int, fp string, size int"
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small():
    """(doc_id, text, source) of the smallest supplied table."""
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
