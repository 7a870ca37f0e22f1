from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import substring as S
from ledgerlint.llm.fm_index import FMIndex, WaveletMatrix, suffix_array


def brute(rows, width=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = Counter()
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[(d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def corpus(n, seed, vocabulary=300):
    rng = random.Random(seed)
    say = lambda k: " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(k))
    passages = [say(k) for k in (34, 35, 36, 60, 200)] + [" ".join(["again"] * 50), " ".join(["ab", "cd"] * 40)]
    rows = []
    for i in range(n):
        parts = [say(rng.randrange(60)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        rows.append((i, " ".join(parts)))
        if rng.random() < 0.15:
            w = rows[-1][1].split()
            if w:
                w[rng.randrange(len(w))] = "edited"
            rows.append((100_000 + i, "\n".join(w)))
    return rows


def result(df):
    return Counter(tuple(r)[:4] for r in df.collect())


def test_suffix_array_and_rank():
    rng = np.random.default_rng(2)
    for size, n in ((2, 50), (7, 300), (1000, 500)):
        x = rng.integers(0, size, n)
        assert suffix_array(x).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())
        w = WaveletMatrix(x, size)
        c, i = rng.integers(0, size, 400), rng.integers(0, n + 1, 400)
        assert w.rank(c, i).tolist() == [int((x[:b] == a).sum()) for a, b in zip(c, i)]


@pytest.mark.parametrize("width", [1, 3, 7])
def test_repeated_windows_against_counting(width):
    rng = np.random.default_rng(width)
    for size in (2, 5, 40):
        texts = [rng.integers(0, size, rng.integers(1, 40)).astype(np.uint64) for _ in range(30)]
        seen = Counter(tuple(t[i : i + width]) for t in texts for i in range(len(t) - width + 1))
        got = FMIndex(texts).repeated_windows(np.arange(30), width)
        for t, g in zip(texts, got):
            assert g.tolist() == [i for i in range(len(t) - width + 1) if seen[tuple(t[i : i + width])] > 1]


@pytest.mark.parametrize("hot, shard_words, seed", [(5000, 400_000, 1), (2, 500, 2), (1, 100, 3)])
def test_equals_brute_force(spark, docs_of, monkeypatch, hot, shard_words, seed):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "SHARD_WORDS", shard_words)
    rows = corpus(120, seed)
    assert result(S.deduplicated(docs_of(rows).repartition(4))) == brute(rows)


def test_edge_cases(spark, docs_of):
    long = " ".join(f"x{i % 70_000}" for i in range(71_000))
    rows = [(1, None), (2, ""), (3, "a\x1cb\xa0c d"), (4, long), (5, "é " * 40), (6, " ".join(map(str, range(35)))), (7, " ".join(map(str, range(35)))), (7, " ".join(map(str, range(35)))), (None, " ".join(map(str, range(34)))), (8, " ".join(map(str, range(1, 40)))), (None, "q " * 35), (9, "x" * 100_000)]
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("tie", "body", "start", "anchor", "covered", "_id")})
    assert result(S.deduplicated(docs)) == brute(rows)
    assert S.deduplicated(docs_of([])).count() == 0


def test_saturated_filter_stays_exact(spark, docs_of):
    rows = corpus(60, 9)
    assert result(S.deduplicated(docs_of(rows), max_filter_bytes=1 << 14)) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(S.deduplicated(docs)) == brute(rows)


def test_windows_of_a_hot_anchor_are_not_indexed(spark, docs_of, monkeypatch):
    rng = random.Random(4)
    say = lambda k: " ".join(f"w{rng.randrange(10**6)}" for _ in range(k))
    passage = say(50)
    rows = [(i, f"{say(40)} {passage} {say(40)}") for i in range(300)] + [(1000 + i, f"{say(40)} {passage}") for i in (0, 0, 1)]
    rows += [(2000 + i, rows[0][1]) for i in range(3)]
    tables, store = {}, S.written
    monkeypatch.setattr(S, "HOT", 20)
    monkeypatch.setattr(S, "written", lambda df, name: tables.setdefault(name, store(df, name)))
    assert result(S.deduplicated(docs_of(rows).repartition(4))) == brute(rows)
    most = tables["segment-words"].groupBy("key").agg(F.sum(F.length("words")).alias("n")).agg(F.max("n")).first()[0] or 0
    assert most <= S.HOT * 2 * S.WIDTH * 8  # no shard holds the copies of a window
