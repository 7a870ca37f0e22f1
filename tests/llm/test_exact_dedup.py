from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerlint.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = True
        for i in ids:
            kept = left and i == keep
            left = left and not kept
            out[(i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


ROWS = [(1, "a b"), (2, "a b"), (3, "a  b"), (4, None), (5, ""), (6, "é"), (7, "é"), (8, "x" * 200_000), (9, "x" * 200_000),
        (10, "same"), (10, "same"), (None, "null id"), (11, "null id"), (None, "alone")] + [(100 + i, "hot") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(500)]


def test_assign_equals_brute_force(spark, docs_of):
    got = Counter(tuple(r) for r in X.assign(docs_of(ROWS).repartition(5)).collect())
    assert got == brute(ROWS)


def test_saturated_filter_stays_exact(spark, docs_of):
    got = Counter(tuple(r) for r in X.assign(docs_of(ROWS), max_filter_bytes=1 << 14).collect())
    assert got == brute(ROWS)


def test_empty_and_clashing_columns(spark, docs_of):
    empty = docs_of([])
    assert X.assign(empty).count() == 0 and X.deduplicate(empty).columns == empty.columns
    clash = docs_of([(1, "a"), (2, "a"), (3, "b")]).withColumns({c: F.lit(7) for c in ("row", "body", "maybe", "keep_id", "kept", "key", "n", "h")})
    assert sorted(r[0] for r in X.assign(clash).filter("kept").collect()) == [2, 3]
    kept = X.deduplicate(clash)
    assert kept.columns == clash.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_deduplicate_keeps_one_row_of_each_text(spark, docs_of):
    got = X.deduplicate(docs_of(ROWS))
    texts = [r.text or "" for r in got.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {t or "" for _, t in ROWS}


def test_only_possibly_repeated_rows_shuffle(spark, docs_of):
    unique = docs_of([(i, f"text {i}") for i in range(3000)])
    flagged = X._flagged(unique, "text", X.MAX_FILTER_BYTES)
    assert flagged.filter("maybe").count() < 150
