from __future__ import annotations

import pytest
from llm_cases import CLASHING


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) rows with further columns that clash with inner names."""

    def make(rows):
        extra = ", ".join(f"{name} string" for name in CLASHING)
        full = [(doc_id, text, *[f"x{i}" for i in range(len(CLASHING))]) for doc_id, text in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {extra}")

    return make
