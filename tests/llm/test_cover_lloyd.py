"""Vector codes against plain Lloyd rounds over all vectors."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from ledgerlint.llm import cover_lloyd as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label) of every kept row, and the digest of the codebooks, with Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = [[tuple(math.floor(4096 * x) for x in r[1][p * d : (p + 1) * d]) for r in kept] for p in range(parts)]
    books = [[list(v) for v in part[:entries]] for part in cut]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book)) for v in part] for part, book in zip(cut, books)]

    for _ in range(rounds):
        for part, book, found in zip(cut, books, assign()):
            for k in range(len(book)):
                mine = [v for v, (_, e) in zip(part, found) if e == k]
                if mine:
                    book[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{found[p][i][1]:02x}" for p in range(parts)), sum(found[p][i][0] for p in range(parts)), r[2]) for i, r in enumerate(kept)]
    return out, sha


def check(spark, rows, schema=SCHEMA):
    got = C.compressed(spark.createDataFrame(rows, schema)).collect()
    want, sha = plain(rows)
    totals = Counter()
    for *_, error, label in want:
        totals[label] += error
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == Counter((*w[:3], totals[w[3]]) for w in want)
    assert {r["codebooks_sha256"] for r in got} == {sha}


def vectors(n, seed=0, dims=16, scale=1.0):
    return (np.random.default_rng(seed).normal(size=(n, dims)) * scale).astype(np.float32).tolist()


def test_equals_plain_rounds(spark):
    check(spark, [(i, v, i % 3) for i, v in enumerate(vectors(700))])


def test_one_vector_in_half_of_the_rows_and_far_clusters(spark):
    far = [(i, (np.float32(50 * (i % 5)) + np.array(v, np.float32)).tolist(), 1) for i, v in enumerate(vectors(300, 1, scale=0.1))]
    check(spark, far + [(1000 + i, far[3][1], 2) for i in range(300)])


def test_nulls_ties_and_odd_rows(spark):
    rows = [(i, v, None if i % 2 else 7) for i, v in enumerate(vectors(60, 2))]
    rows += [(100, None, 1), (101, [float("nan")] * 16, 1), (102, [float("inf")] + [0.0] * 15, 1), (103, [None] + [0.0] * 15, 1)]
    rows += [(5, rows[5][1], 7), (5, rows[5][1], 7), (None, rows[6][1], None)]  # repeated rows, a null id
    check(spark, rows)


def test_vectors_of_another_length_are_dropped(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(40, 3))]
    odd = [(50, [1.0] * 8, 0), (51, [1.0] * 15, 0), (52, [], 0)]
    got = C.compressed(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(40))


def test_fewer_vectors_than_entries_and_empty_table(spark):
    check(spark, [(i, v, 0) for i, v in enumerate(vectors(5, 4))])
    empty = C.compressed(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and dict(empty.dtypes)["code"] == "string"


def test_clashing_extra_columns_and_large_ids(spark):
    rows = [(2**60 + i, v, None if i == 3 else i % 2, "x", 1) for i, v in enumerate(vectors(30, 5))]
    got = C.compressed(spark.createDataFrame(rows, SCHEMA + ", code string, error int")).collect()
    want, _ = plain([r[:3] for r in rows])
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == {w[0]: w[1:3] for w in want}


def test_too_large_components_raise():
    with pytest.raises(ValueError, match="65,536"):
        C.integers(np.array([70000.0]))


def test_trees_cover_their_points():
    points = np.random.default_rng(6).integers(-500, 500, (900, 4))
    tree = C.cover_tree(points, most=60)
    assert tree.counts[0] == len(points) and (tree.sums[0] == points.sum(axis=0)).all()
    assert np.sqrt(((tree.points - tree.centers[0]) ** 2).sum(axis=1)).max() <= tree.radius[0]
    for i in range(len(tree.centers)):
        own = tree.points[tree.first_point[i] : tree.first_point[i + 1]]
        assert np.sqrt(((own - tree.centers[i]) ** 2).sum(axis=1)).max() <= tree.own_radius[i]
        below = [i]
        for node in below:
            below += tree.children[tree.first_child[node] : tree.first_child[node + 1]].tolist()
        assert tree.counts[i] == sum(tree.own_counts[j] for j in below)
        reached = np.concatenate([tree.points[tree.first_point[j] : tree.first_point[j + 1]] for j in below])
        assert np.sqrt(((reached - tree.centers[i]) ** 2).sum(axis=1)).max() <= tree.radius[i]


def test_whole_subtrees_are_settled_without_their_points():
    rng = np.random.default_rng(7)
    points = np.concatenate([rng.integers(-20, 20, (500, 4)) + c for c in (0, 10_000, -10_000)])
    tree = C.cover_tree(points, most=60)
    book = np.array([[0] * 4, [10_000] * 4, [-10_000] * 4])
    compared = sum(len(p) for *_, p in C.walk(tree, book) if p is not None)
    assert compared == 0
    assert (C.codes_of(tree, book) == C._squared(points, book).argmin(axis=1)).all()


def test_ties_go_to_the_lower_entry():
    tree = C.cover_tree(np.array([[0, 0], [2, 0], [1, 0]]))
    assert C.codes_of(tree, np.array([[2, 0], [0, 0]])).tolist() == [1, 0, 0]
    assert C.codes_of(tree, np.array([[0, 0], [0, 0]])).tolist() == [0, 0, 0]
