from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    from ledgerlint.llm.common import importable

    importable(spark)


@pytest.fixture()
def docs_of(spark):
    """A ``documents`` table of (doc_id, text[, lang[, source]]) rows."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) + tuple(r[4:]) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long" + extra)

    return make
