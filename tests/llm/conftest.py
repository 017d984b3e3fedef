from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LONG = "lorem ipsum dolor " * 30_000

# Null and empty texts, a null id and source, repeated rows, a very long text, ties.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a", 70),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a", 70),
    (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n ", "en", "b", 4),
    (None, "a text without an id", "en", None, 20), (None, None, None, None, None),
    (6, LONG, "en", "a", len(LONG)), (7, "É\u00e8 na\u00efve \U0001f600 text", "fr", "c", 14),
    (7, "É\u00e8 na\u00efve \U0001f600 text", "fr", "c", 14), (8, "x", "en", "a", 1),
]


@pytest.fixture
def odd_docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
