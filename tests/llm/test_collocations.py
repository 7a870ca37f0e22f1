"""Collocations against plain counting in Python."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from ledgerlint.llm import collocations as C

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, min_count=10, top=2000, covered=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < min_count:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [b for (x, q), b in f.items() if x == lang and len(q) == 3 > len(p) and b >= min_count and p in (q[:2], q[1:])]
        if not any(100 * b >= covered * a for b in longer):
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i, p.decode(), -a, le, r, n[lang], -s) for lang, all_ in found.items() for i, (s, a, p, le, r) in enumerate(sorted(all_)[:top], 1)}


def got(df):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


def corpus(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "lang")


@pytest.mark.parametrize("shards", [1, 3, 10])
def test_equals_plain_counting(spark, shards):
    docs = corpus(spark)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert got(C.ranked(docs, shards=shards)) == plain(rows) != set()


def test_a_full_bitmap_changes_nothing(spark):
    docs = corpus(spark)
    few = C.counted(docs, max_filter_bytes=1 << 13)
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in C.counted(docs).collect()}


def test_pieces_blanks_and_letters(spark):
    text = "New  York\tCity. new york, City New\nYork É é x" + "\x0b" + "new york city"
    rows = [(text, "en"), ("new york", None), (None, "en"), ("", "de"), ("...", "de")] * 10
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    assert got(C.ranked(docs)) == plain(rows)
    assert {p for _, _, p, *_ in plain(rows) if "york city" in p} == {"new york city"}  # "york city" is covered by it


def test_overlapping_occurrences_and_ties(spark):
    rows = [("a a a a a a", "en")] * 4 + [("q z b b b", "en"), ("q z b b b", "en")] * 5
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    assert got(C.ranked(docs)) == plain(rows)
    assert [r["phrase"] for r in C.ranked(docs, top=2).orderBy("rank").collect()] == [p for _, _, p, *_ in sorted(plain(rows, top=2), key=lambda x: x[1])]


def test_a_phrase_in_every_row_and_a_long_text(spark):
    rows = [("very frequent phrase " * 50, "en")] * 60 + [("one long text of words " * 40_000, "en")]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    assert got(C.ranked(docs)) == plain(rows)


def test_scores_whose_products_pass_64_bits(spark):
    a = 5_000_000_000
    row = spark.createDataFrame([(a, a + 7, a + 11)], "a long, l long, r long")
    exact = "cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * 1000000 div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    assert row.selectExpr(exact).first()[0] == 1_000_000 * a * a // ((a + 7) * (a + 11))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert C.ranked(empty).count() == 0
    rows = [("one two three", "en")] * 12
    docs = spark.createDataFrame([(t, x, 1, "p", 3) for t, x in rows], "text string, lang string, n int, phrase string, size int")
    assert got(C.ranked(docs)) == plain(rows)


class Held:
    """A broadcast value without a cluster."""

    def __init__(self, value):
        self.value = value


def test_a_task_returns_few_rows_at_a_time():
    words = [f"w{i}" for i in range(100_000)]
    texts = [" ".join(words[i : i + 100]).encode() for i in range(0, len(words), 100)]
    frame = pd.DataFrame({"text": texts, "seed": 5, "shard": 0, "lang": "en"})
    local = list(C._local_counts(1, None)(iter([frame])))
    assert sum(map(len, local)) == len(words) and max(map(len, local)) <= 1 << 15
    every = np.full((1, 1 << 10), -1, np.int64).view("<u8")  # a full bitmap lets each phrase be counted
    batch = pa.RecordBatch.from_pandas(frame[["text", "lang", "seed"]], preserve_index=False)
    found = list(C._global_counts([Held(every)] * 2)(iter([batch])))
    assert max(b.num_rows for b in found) <= 1 << 15
    rows = [r for b in found for r in b.to_pylist()]
    assert sorted(r["phrase"].decode() for r in rows if r["size"] == 1) == sorted(words)
    assert sum(r["n"] for r in rows if r["size"] == 2) == 99 * len(texts) and [r["n"] for r in rows if r["size"] == 0] == [len(words)]


def test_tasks_get_their_rows_in_small_batches(spark):
    docs = spark.createDataFrame([(i, "x" * 100_000, "en") for i in range(200)], "doc_id long, text string, lang string").coalesce(1)
    sizes = docs.select("text").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert max(r["n"] for r in sizes) < 5 << 20
