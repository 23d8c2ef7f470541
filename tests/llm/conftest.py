from __future__ import annotations

import pytest

ROWS = [
    # doc_id, text, source and extra columns named like results and internals of the operators
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "THE quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (3, "The quick brown fox jumps over the lazy dog near the river bank now", "a"),
    (4, "", "a"),
    (5, None, None),
    (6, " \t\n ", "a"),
    (7, "one two three", "b"),
    (8, "one two three", "b"),
    (9, "Één straße ÀÉ öl größe   word joined", "b"),
    (10, "word " * 300 + "end", "b"),
    (11, "same words " * 40, "c"),
    (12, "zwölf", "c"),
    (13, "!!! ??? ...", "c"),
    (14, "x" * 5000, "c"),
    (None, "a row without an id", None),
]


@pytest.fixture(scope="session")
def edge_rows():
    return ROWS


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, s, "k", "d", "r", 1, "h", 0.5) for i, t, s in ROWS]
    return spark.createDataFrame(rows, (
        "doc_id long, text string, source string, kept string, digest string, row string, shard int, `text.hash` string,"
        " score double"
    ))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
