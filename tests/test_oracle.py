"""Every registered query against its DuckDB SQL (row count, columns, values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from compare import compare
from conftest import SF_SMALL

KEYS = sorted(E._cleaning_queries())


def test_every_query_has_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, KEYS, verbose=False)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(results, key):
    assert results[key][0] == "ok", results[key]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 34
