from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, lang, source) tuples."""

    def make(rows):
        full = [(*r, *(None, None)[len(r) - 2 :])[:4] if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOCS)

    return make
