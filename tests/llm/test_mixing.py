from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import mixing as M


def test_water_fill():
    assert M.water_fill([100, 100], [1, 1], 300, 2) == [150, 150]
    assert M.water_fill([10, 100, 100], [5, 2, 1], 315, 2) == pytest.approx([20, 196.66666666666669, 98.33333333333334])
    assert M.water_fill([], [], 0, 2) == []
    got = M.water_fill([0, 7], [5, 2], 10.5, 2)
    assert got == [0.0, 10.5]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_targets_limits_and_reruns(spark, small):
    got = {r.doc_id: r for r in M.taken_words(small).collect()}
    texts = {r.doc_id: r for r in small.collect()}
    assert got.keys() == texts.keys()
    by_source, sizes, targets = Counter(), Counter(), {}
    for i, r in got.items():
        size = len(re.findall(r"[^\x20\x09-\x0D]+", texts[i].text))
        assert r.size == size and 0 <= r.taken <= 2 * size
        by_source[texts[i].source] += r.taken
        sizes[texts[i].source] += size
        targets[texts[i].source] = r.target
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    want = M.water_fill([sizes[s] for s in weights], list(weights.values()), 1.5 * sum(sizes.values()), 2)
    for s, t in zip(weights, want):
        assert targets[s] == pytest.approx(t)
        assert abs(by_source[s] - t) <= M.BLOCK * 2
        assert {r.source_size for i, r in got.items() if texts[i].source == s} == {sizes[s]}
    again = {r.doc_id: r for r in M.taken_words(small.repartition(7)).collect()}
    assert again == got


def test_permutation_and_shards(spark):
    sources = M.source_targets(spark.createDataFrame([("a", 64 * 5000), ("b", 64 * 3)], "source string, size long"), weights=(1,), share=1.9)
    plan = M.slot_plan(sources, 9503, shard_slots=1000)
    rows = plan.collect()
    per = Counter((r.source_id, r.block) for r in rows)
    assert set(per.values()) <= {1, 2} and len(per) == 5003
    for r in sources.collect():
        assert sorted(x.slot for x in rows if x.source_id == r.source_id) == list(range(r.slots))
        first = {x.block for x in rows if x.source_id == r.source_id and x.slot < r.n_blocks}
        assert first == set(range(r.n_blocks))  # a whole pass before any repeat
    shards = Counter(r.shard for r in rows)
    assert len(shards) == 10 and max(shards.values()) < 1.2 * min(shards.values())


def test_shards_take_ranges_of_multinomial_counts(spark):
    sources = M.source_targets(spark.createDataFrame([("a", 64 * 6000), ("b", 64 * 3000)], "source string, size long"), weights=(1,), share=1.9)
    total = sum(r.slots for r in sources.collect())
    counts = {(r.source_id, r.shard): r.n for r in M.shard_counts(sources, total, shard_slots=1000).collect()}
    plan = M.slot_plan(sources, total, shard_slots=1000).collect()
    assert Counter((r.source_id, r.shard) for r in plan) == counts
    n_shards = -(-total // 1000)
    for r in sources.collect():
        own = [counts.get((r.source_id, k), 0) for k in range(n_shards)]
        assert sum(own) == r.slots
        mean = r.slots / n_shards
        chi2 = sum((n - mean) ** 2 / mean for n in own)  # about n_shards - 1 for independent uniform draws
        assert 0.2 * n_shards < chi2 < 2.5 * n_shards
        for k in range(n_shards):
            slots = sorted(x.slot for x in plan if x.source_id == r.source_id and x.shard == k)
            assert slots == list(range(slots[0], slots[0] + len(slots)))


def test_shards_of_documents_add_up(spark, small, monkeypatch):
    plan = M.slot_plan
    monkeypatch.setattr(M, "slot_plan", lambda *a, **k: plan(*a, shard_slots=200, **k))
    got = M.taken_words(small).collect()
    shards = Counter()
    for r in got:
        parts = [tuple(map(int, p.split(":"))) for p in r.shards.split(",") if p]
        assert sum(n for _, n in parts) == r.taken and [k for k, _ in parts] == sorted({k for k, _ in parts})
        shards.update(dict(parts))
    assert len(shards) > 5 and max(shards.values()) < 1.5 * min(shards.values())


def test_rotation_does_not_overflow(spark):
    at = 2**62
    hashes = spark.range(4000).select(F.xxhash64(F.lit(7), F.floor((F.col("id") * 1024 + at) / 1024)).alias("h"))
    assert hashes.filter(F.col("h") > 2**63 - at).count()  # sums of these with the index pass 64 bits
    turned = spark.range(4000).select(M._rotated(F.col("id") * 1024 + at, F.lit(2**63 - 1), F.lit(7)).alias("x"))
    assert turned.distinct().count() == 4000


def test_edge_cases(spark, docs_of):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, "w " * 70, "en", None), (4, "x\x0by z", "en", "b"), (4, "x\x0by z", "en", "b"), (None, "q", "en", "a"), (1, None, "en", "a")]
    docs = docs_of(rows).withColumns({c: F.lit(3) for c in ("size", "offset", "target", "block", "row", "rid", "times")})
    got = M.taken_words(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter([(1, 0), (1, 0), (2, 0), (3, 70), (4, 2), (4, 2), (None, 1)])
    assert M.taken_words(docs_of([])).count() == 0
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns and all(r.n_chars == len(r.text) for r in mixed.collect())
    assert M.mixed_documents(docs_of([])).count() == 0


def test_mixed_documents_hold_the_words_taken(spark, small):
    taken = {r.doc_id: r.taken for r in M.taken_words(small).collect()}
    texts = {r.doc_id: r.text for r in small.collect()}
    words = Counter()
    for r in M.mixed_documents(small).collect():
        words[r.doc_id] += len(r.text.split())
        it = iter(texts[r.doc_id].split())
        assert all(w in it for w in r.text.split())  # a subsequence of the document's words
    assert {i: n for i, n in taken.items() if n} == dict(words)


def test_rows_keep_their_numbers_when_the_splits_move(spark, small, tmp_path, monkeypatch):
    small.repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = Counter(tuple(r) for r in M.mixed_documents(docs).collect())
    store, old = M.written, spark.conf.get("spark.sql.files.maxPartitionBytes")

    def splits_move(df, name):
        out = store(df, name)
        if name == "mix-sizes":
            spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        return out

    monkeypatch.setattr(M, "written", splits_move)
    try:
        assert Counter(tuple(r) for r in M.mixed_documents(docs).collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_native_plan(small):
    plan = M.taken_words(small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)
