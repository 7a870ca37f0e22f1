from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import langid as L


def brute_force(model, word):
    """Sum over all segmentations, by recursion."""
    def rest(s):
        if not s:
            return np.ones(len(model.langs))
        total = np.zeros(len(model.langs))
        for k in range(1, len(s) + 1):
            if s[:k] in model.index:
                total += model.probs[model.index[s[:k]]] * rest(s[k:])
            elif k == 1:
                total += L.UNCOVERED * rest(s[1:])
        return total

    return np.log(rest(L.MARK + word))


def toy():
    index = {p: i for i, p in enumerate(["▁", "▁a", "a", "b", "ab", "ba", "aba", "c", "▁ab"])}
    probs = np.vstack([np.random.default_rng(1).dirichlet(np.ones(len(index)), 2).T, [[L.UNCOVERED] * 2]])
    return L.Model(["x", "y"], index, probs)


def test_forward_sums_every_segmentation():
    model = toy()
    words = ["a", "ab", "abab", "abacaba", "qq", "aqb", "ééa"]
    got = model.log_probs(words)
    for w, g in zip(words, got):
        assert np.allclose(g, brute_force(model, w))


def test_long_words_stay_in_range():
    got = toy().log_probs(["q" * 5000, "ab" * 9000])
    assert np.isfinite(got).all() and (got < 0).all()


def test_expectation_maximisation_raises_the_likelihood(spark, docs_of):
    docs = docs_of([(1, "ababab abc abab cab", "x"), (2, "bcbc cbcb bcb", "y")] * 3)
    pieces = ["▁", "a", "b", "c", "ab", "bc", "abab"]
    values = []
    for rounds in (1, 2, 5):
        m = L.fit(docs, pieces=pieces, rounds=rounds)
        values.append(sum(m.log_probs(["ababab", "abc", "abab", "cab"])[:, 0]) + sum(m.log_probs(["bcbc", "cbcb", "bcb"])[:, 1]))
    assert values[0] < values[1] < values[2]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.held_out(F.col("doc_id"))
    model = L.fit(docs.filter(~out))
    got = L.predict(docs, model).join(docs.select("doc_id", "lang", out.alias("out")), "doc_id").filter("out").collect()
    assert model.langs == ["de", "en", "es", "fr"]
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)


def test_edge_cases(spark, docs_of):
    train = docs_of([(1, "der und die", "de"), (2, "the and of", "en"), (3, None, "en"), (4, "x", None)])
    model = L.fit(train)
    assert model.langs == ["de", "en"]
    docs = docs_of([(1, None), (2, ""), (3, "123 ½ __ !!"), (4, "UND DIE"), (5, "the " * 50_000), (5, "the"), (None, "漢字")]).withColumns({c: F.lit(1) for c in ("row", "found", "lang_pred", "score")})
    got = {(r.doc_id, r.lang_pred) for r in L.predict(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "en")} <= got and len(got) == 6
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    nothing = L.fit(docs_of([]))
    assert {r.lang_pred for r in L.predict(docs, nothing).collect()} == {"und"}
    assert L.predict(docs_of([]), model).count() == 0


def test_held_out_is_a_remainder_of_crc32(spark):
    from zlib import crc32

    got = spark.range(300).select("id", L.held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (crc32(str(r["id"]).encode()) % 3 == 1) for r in got)
    assert not spark.sql("select cast(null as long) as id").select(L.held_out(F.col("id")).alias("out")).first()["out"]
