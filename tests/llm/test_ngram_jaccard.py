from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import components as G
from ledgerlint.llm import ngram_jaccard as J
from ledgerlint.llm.common import PerWorker


def shingles(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(doc_id, class_id, n_links) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for k in range(i):
            a, b = sets[i], sets[k]
            if a == b or (a and b and len(a & b) >= 0.8 * len(a | b)):
                links[i] += 1
                links[k] += 1
                root[find(i)] = find(k)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        f = find(i)
        least[f] = d if least[f] is None else least[f] if d is None else min(d, least[f])
    return Counter((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows))


def corpus(n_groups, copies, seed, words=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    rows = []
    for _ in range(n_groups):
        base = rng.choices(vocabulary, k=rng.randrange(5, words))
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w += passage.split()
            rows.append((len(rows) * 3 + 1, " ".join(w)))
    rng.shuffle(rows)
    return rows


def test_components_of_a_path_a_star_and_pairs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(1000, 999), (5, 5), (None, 3)]
    got = {r.node: r.root for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 400)} | {1000: 999, 999: 999}
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_equals_brute_force(spark, docs_of):
    rows = corpus(60, 9, 1)
    got = Counter(tuple(r) for r in J.classes(docs_of(rows).repartition(3)).collect())
    assert got == brute(rows)


def test_large_groups_split_by_pivots_and_blocks(spark, docs_of, monkeypatch):
    rows = corpus(8, 60, 2)
    for name, value in (("SMALL", 3), ("WHOLE", 6), ("BLOCK_SHINGLES", 900), ("MAX_DEPTH", 3)):
        monkeypatch.setattr(J, name, value)
    got = Counter(tuple(r) for r in J.classes(docs_of(rows)).collect())
    assert got == brute(rows)


def test_pairs(spark, docs_of):
    rows = corpus(20, 6, 3)
    got = {frozenset((r.id_a, r.id_b)): r.similarity for r in J.links(docs_of(rows)).collect()}
    first = {}
    for d, t in sorted(rows):
        first.setdefault(shingles(t), d)
    want = {}
    for a, i in first.items():
        for b, k in first.items():
            if i < k and len(a & b) >= 0.8 * len(a | b):
                want[frozenset((i, k))] = len(a & b) / len(a | b)
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)


def test_edge_cases(spark, docs_of):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "!! ..."), (4, "one"), (5, "One!"), (6, "one two"), (7, long), (8, long + " end"), (None, "one"), (None, "only null"), (9, "a b c d e f"), (9, "a b c d e f"), (10, "É é"), (11, "é é")]
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("node", "class_id", "row", "id", "hash", "path", "root", "body", "text_hash", "_id")})
    assert Counter(tuple(r) for r in J.classes(docs).collect()) == brute(rows)
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (1, 4, 6, 7, 9, 10, 11)] + [(True, 0)]
    assert J.classes(docs_of([])).count() == 0 and J.one_of_each(docs_of([])).count() == 0


def test_word_and_shingle_hashes_follow_the_words():
    from ledgerlint.llm.common import FOLDED_WORDS, WHITE_SPACE_WORDS, shingle_hashes, word_hashes

    texts = [b"", b"a b a", b"  b  ", b"A,b", b"a\x1cb", "é é".encode(), b"", b"a"]
    h, o = word_hashes(texts, WHITE_SPACE_WORDS)
    assert o.tolist() == [0, 0, 3, 4, 5, 6, 7, 7, 8]
    assert h[0] == h[2] == h[7] and h[1] == h[3] and len(set(h.tolist())) == 5
    h, o = word_hashes(texts, FOLDED_WORDS)
    assert o.tolist() == [0, 0, 3, 4, 6, 8, 9, 9, 10] and h[4] == h[0] and h[5] == h[1]
    s, so = shingle_hashes(h, o, 2)
    assert so.tolist() == [0, 0, 2, 3, 4, 5, 6, 6, 7] and s[0] == s[3] == s[4] and s[1] != s[0] and s[2] != s[6]
    assert len(np.unique(word_hashes([" ".join(map(str, range(200_000))).encode()], FOLDED_WORDS)[0])) == 200_000


def test_many_short_texts_are_compared_in_blocks_of_nodes(spark, docs_of, monkeypatch):
    import pandas as pd

    def cell_sizes(batches):
        for g in J._groups(batches, ["root", "lo", "hi"]):
            yield pd.DataFrame({"a": [len(g)], "b": [0], "links": [0], "similarity": [0.0]})

    # All nodes are candidates of the first one; 5 of 7 shingles are shared, so that none are linked.
    star = lambda nodes, recall: nodes.select(F.col("node").alias("a"), F.lit(nodes.agg(F.min("node")).first()[0]).alias("b")).filter("a <> b")
    monkeypatch.setattr(J, "candidate_edges", star)
    docs = docs_of([(i, f"one two three four five six seven eight nine w{i}") for i in range(20_000)]).repartition(4)
    _, nodes = J._nodes(docs, "doc_id", "text", J.WIDTH)
    cells = lambda: J._compared(docs, nodes, "doc_id", "text", J.WIDTH, J.RECALL, False)
    with monkeypatch.context() as m:
        m.setattr(J, "_verify", lambda pairs: cell_sizes)
        most = cells().agg(F.max("a")).first()[0]
    assert most < 2.5 * J.SMALL
    assert cells().count() == 0


def anonymous_mb():
    return sum(map(int, re.findall(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_a_task_lets_go_of_what_its_worker_kept():
    body = "one two three four five six seven".encode()
    batch = pd.DataFrame({"doc_id": [1], "text_hash": [2], "body": [body]})
    list(J._sketcher(5)(iter([batch])))
    before = anonymous_mb()
    kept = PerWorker.get("scores of an earlier stage", lambda: [bytes(20_000) for _ in range(5_000)])
    assert len(kept) == 5_000 and anonymous_mb() > before + 80
    del kept
    assert len(list(J._sketcher(5)(iter([batch])))[0]) == 1
    assert PerWorker.latest is None and anonymous_mb() < before + 40
