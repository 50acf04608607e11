from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from ``(id, text)`` pairs, with columns whose names operators use inside."""

    def make(*pairs, lang="en", extra=True):
        rows = [(i, t, lang, "s", len(t) if t is not None else None) for i, t in pairs]
        frame = spark.createDataFrame(rows, DOCUMENTS)
        if extra:
            frame = frame.selectExpr("*", "1 AS id", "'h' AS hash", "2L AS size", "true AS kept_")
        return frame

    return make


def words(start: int, count: int) -> str:
    return " ".join(f"word{k}" for k in range(start, start + count))
