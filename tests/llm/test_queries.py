"""The registered queries: contract columns, and the DuckDB SQL where there is one."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from compare import compare
from ledgerlint.llm import queries as Q

SF = "/root/testdata/sf0.001"

# Columns and types that each query returns at least.
COLUMNS = {
    "op1_ngram_jaccard": {"doc_id": "bigint", "class_id": "bigint", "n_links": "bigint"},
    "op2_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op3_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op4_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op5_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op7_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op8_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op9_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11_lm_score": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op12_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op13_vector_codes": {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"},
}
# Tables with one result row each; the other queries have rows of their own.
TABLES = {"op3_url_filter": "pages", "op13_vector_codes": "embeddings"}


def test_every_operator_has_one_query():
    assert set(Q.queries()) == set(COLUMNS) and set(E.queries()) >= {*COLUMNS, "pipeline"}


@pytest.mark.parametrize("key", COLUMNS)
def test_columns_and_rows(spark, key):
    df = Q.queries()[key](spark, SF)
    assert dict(df.dtypes).items() >= COLUMNS[key].items()
    if key not in ("op6_best_fit_packing", "op12_collocations"):
        assert df.count() == spark.read.parquet(f"{SF}/{TABLES.get(key, 'documents')}.parquet").count()


def test_queries_equal_their_sql(spark):
    found = compare(spark, SF, sorted(Q.oracle_sql()), verbose=False)
    assert {k: v[0] for k, v in found.items()} == {k: "ok" for k in Q.oracle_sql()}
