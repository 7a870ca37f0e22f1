"""Vector code compression: product codebooks by cover-tree Lloyd.

A vector is cut into ``parts`` equal consecutive parts; each part position has
a codebook of ``entries`` integer vectors, and a vector's code is the number of
the nearest entry at each position.  All arithmetic is exact: a component x
counts as the integer ``floor(4096 * x)``.

Vectors are gathered into blocks where they lie (no shuffle), and each block
gets one cover tree for each part position: centers come from a farthest-first
traversal, so those inserted at a distance above 2**i are more than 2**i apart
and cover all points within 2**i; a center's parent is the nearest center of a
higher level, and every point hangs on its nearest center.  Each node holds
the cumulative count and sum of all points below it and a radius that bounds
their distances.  A Lloyd round walks the trees from the roots: a node whose
nearest entry is nearer, by more than twice the radius, than every other one
gives its whole subtree to that entry (triangle inequality); only other nodes
descend, down to exact integer comparisons of points.  Blocks are written once
to the shared folder; a round ships one row for each entry and task.

Bounds: the driver sees ``parts * entries`` sums a round; a block is one row of
at most ``BLOCK`` vectors, whatever the table's size; codebooks alone are sent
to the tasks.  A vector that very many rows share needs no care: its copies lie
in different blocks, where they are points at distance 0 of one center.

Defined cases: null vectors and those with null or non-finite components are
dropped, as are vectors whose length differs from that of the first kept vector
(least id, then least vector; null ids last) or cannot be cut into equal parts;
fewer vectors than entries give smaller codebooks; rows that share an id are
separate vectors; a null label is a label of its own; an empty table gives an
empty result; extra columns are ignored.  A component of magnitude 65,536 or
more raises, since sums of squares would pass 64 bits.  ``label_error`` is null
if a label's sum passes 64 bits.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import importable, written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 2048  # vectors of one tree
CENTERS = 192  # inner nodes of one tree
LARGEST = 1 << 28  # integers below it have squared distances of 64 bits


def usable(vector: Column) -> Column:
    """Whether a vector is not null and holds finite components only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, lambda x: finite(x.cast("double"))), F.lit(False))


def integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(4096 * x)``, exactly: a power of two changes only the exponent."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError("a component has a magnitude of 65,536 or more")
    return scaled.astype(np.int64)


# --- cover trees ------------------------------------------------------------------------
@dataclass
class Tree:
    """A cover tree of integer points: nodes are centers, parents before children; points are sorted by the node they hang on."""

    centers: np.ndarray  # [node, d]
    radius: np.ndarray  # [node]: no point at or below a node is farther from its center
    counts: np.ndarray  # [node]: points at or below
    sums: np.ndarray  # [node, d]: their sum
    own_radius: np.ndarray  # the same three for the points that hang on the node itself
    own_counts: np.ndarray
    own_sums: np.ndarray
    children: np.ndarray  # all nodes but the root, by parent
    first_child: np.ndarray  # [node + 1]: a node's range in ``children``
    first_point: np.ndarray  # [node + 1]: a node's own range of points
    points: np.ndarray  # [point, d]
    rows: np.ndarray  # [point]: its row in the block


def cover_tree(points: np.ndarray, most: int = CENTERS) -> Tree:
    """The cover tree of at least one point, with at most ``most`` centers."""
    gap = np.full(len(points), np.iinfo(np.int64).max)
    near = np.zeros(len(points), np.int64)
    chosen: list[int] = []
    level: list[int] = []
    while len(chosen) < most and (not chosen or gap.max() > 0):
        at = int(gap.argmax())
        level.append((int(gap[at]).bit_length() - 1) // 2)  # inserted at a distance of at least 2**level
        to = ((points - points[at]) ** 2).sum(axis=1)
        closer = to < gap
        near[closer], gap[closer] = len(chosen), to[closer]
        chosen.append(at)
    k = len(chosen)
    centers, levels = points[chosen], np.array(level)
    between = _squared(centers, centers)
    higher = levels[None, :] > levels[:, None]
    parent = np.where(higher, between, np.iinfo(np.int64).max).argmin(axis=1)
    rows = np.argsort(near, kind="stable")
    own_counts = np.bincount(near, minlength=k)
    first_point = np.concatenate([[0], np.cumsum(own_counts)])
    own_sums = np.add.reduceat(points[rows], first_point[:-1], axis=0)  # each center hangs on itself: no range is empty
    # Roots are rounded up, so a radius never falls short.
    own_radius = np.nextafter(np.sqrt(np.maximum.reduceat(gap[rows], first_point[:-1]).astype(float)), np.inf)
    counts, sums, radius = own_counts.copy(), own_sums.copy(), own_radius.copy()
    for i in range(k - 1, 0, -1):  # a parent's level is higher, so it was inserted before
        p = parent[i]
        counts[p] += counts[i]
        sums[p] += sums[i]
        radius[p] = max(radius[p], np.nextafter(np.sqrt(float(between[i, p])) + radius[i], np.inf))
    children = 1 + np.argsort(parent[1:], kind="stable")
    first_child = np.concatenate([[0], np.cumsum(np.bincount(parent[1:], minlength=k))])
    return Tree(centers, radius, counts, sums, own_radius, own_counts, own_sums, children, first_child, first_point, points[rows], rows)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[i, j]: exact squared distances of integer vectors."""
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def _ranges(first: np.ndarray, of: np.ndarray) -> np.ndarray:
    """All positions in the ranges first[i]..first[i+1] of the given numbers."""
    size = first[of + 1] - first[of]
    return np.repeat(first[of] - np.cumsum(size) + size, size) + np.arange(size.sum())


def _settled(squared: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Whether the nearest entry of a center is the nearest of all points within the radius."""
    if squared.shape[1] == 1:
        return np.ones(len(squared), bool)
    two = np.sqrt(np.partition(squared, 1, axis=1)[:, :2].astype(float))
    # A slack far above the rounding of roots and sums: a node within it descends.
    return two[:, 1] - two[:, 0] > 2 * radius + 1e-9 * (two[:, 1] + radius + 1)


def walk(tree: Tree, book: np.ndarray):
    """Pieces of (entry numbers, subtree nodes, own-point nodes, points): exactly one of the last three is not None."""
    frontier = np.zeros(1, np.int64)
    while len(frontier):
        squared = _squared(tree.centers[frontier], book)
        nearest = squared.argmin(axis=1)
        whole = _settled(squared, tree.radius[frontier])
        yield nearest[whole], frontier[whole], None, None
        rest = ~whole
        own = rest & _settled(squared, tree.own_radius[frontier])
        yield nearest[own], None, frontier[own], None
        points = _ranges(tree.first_point, frontier[rest & ~own])
        yield _squared(tree.points[points], book).argmin(axis=1), None, None, points
        frontier = tree.children[_ranges(tree.first_child, frontier[rest])]


def cluster_sums(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[entry]: how many points are nearest to it, and [entry, d]: their sum."""
    counts, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    for entry, nodes, own, points in walk(tree, book):
        if nodes is not None:
            add = tree.counts[nodes], tree.sums[nodes]
        elif own is not None:
            add = tree.own_counts[own], tree.own_sums[own]
        else:
            add = 1, tree.points[points]
        np.add.at(counts, entry, add[0])
        np.add.at(sums, entry, add[1])
    return counts, sums


def codes_of(tree: Tree, book: np.ndarray) -> np.ndarray:
    """[row]: the nearest entry of every point, by its row in the block."""
    out = np.empty(len(tree.points), np.int64)

    def below(node: int) -> list[int]:
        found, at = [node], 0
        while at < len(found):
            found += tree.children[tree.first_child[found[at]] : tree.first_child[found[at] + 1]].tolist()
            at += 1
        return found

    for entry, nodes, own, points in walk(tree, book):
        if points is not None:
            out[points] = entry
            continue
        for e, node in zip(entry, nodes if nodes is not None else own):
            for i in below(int(node)) if nodes is not None else [int(node)]:
                out[tree.first_point[i] : tree.first_point[i + 1]] = e
    by_row = np.empty_like(out)
    by_row[tree.rows] = out
    return by_row


# --- Spark jobs -------------------------------------------------------------------------
def _blocks(parts: int):
    """Rows of (vec_ids, labels, trees) of up to ``BLOCK`` vectors, from where they lie."""

    def emit(rows: list[pd.DataFrame]) -> pd.DataFrame:
        one = pd.concat(rows, ignore_index=True)
        points = integers(np.stack(one["vector"].to_numpy()))
        trees = [cover_tree(p) for p in np.split(points, parts, axis=1)]
        return pd.DataFrame({"vec_id": [one["vec_id"].tolist()], "label": [one["label"].tolist()], "trees": [pickle.dumps(trees)]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            while len(b):
                held.append(b.iloc[: BLOCK - n])
                b, n = b.iloc[BLOCK - n :], n + len(held[-1])
                if n == BLOCK:
                    yield emit(held)
                    held, n = [], 0
        if n:
            yield emit(held)

    return run


def _round_sums(books: list[np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for trees in batch["trees"]:
                for p, tree in enumerate(pickle.loads(trees)):
                    n, s = cluster_sums(tree, books[p])
                    counts[p] += n
                    sums[p] += s
        used = [(p, e) for p, n in enumerate(counts) for e in np.flatnonzero(n).tolist()]
        if not used:
            return
        yield pd.DataFrame({"part": [p for p, _ in used], "entry": [e for _, e in used], "n": [counts[p][e] for p, e in used], "sums": [sums[p][e].tolist() for p, e in used]})

    return run


def _assigned(books: list[np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, labels, raw in zip(batch["vec_id"], batch["label"], batch["trees"]):
                trees = pickle.loads(raw)
                codes = np.stack([codes_of(t, b) for t, b in zip(trees, books)])
                error = np.zeros(len(codes[0]), np.int64)
                for t, b, c in zip(trees, books, codes):
                    error[t.rows] += ((t.points - b[c[t.rows]]) ** 2).sum(axis=1)
                text = ["".join(f"{e:02x}" for e in row) for row in codes.T.tolist()]
                yield pd.DataFrame({"vec_id": list(ids), "label": list(labels), "code": text, "error": error})

    return run


def fit_and_encode(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[list[np.ndarray], DataFrame]:
    """The final codebooks, [entry, d] for each part, and vec_id, label, code and error of every kept vector."""
    importable(vectors.sparkSession)
    types = {c: vectors.schema[name].dataType.simpleString() for c, name in (("vec_id", id), ("label", label))}
    rows = vectors.select(vectors[id].alias("vec_id"), vectors[vector].alias("vector"), vectors[label].alias("label"))
    kept = rows.filter(usable(F.col("vector")) & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    order = [F.asc_nulls_last("vec_id"), "vector"]
    least = kept.orderBy(*order).select("vector").first()
    if least is None:
        return [], vectors.sparkSession.createDataFrame([], f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")
    kept = kept.filter(F.size("vector") == len(least["vector"]))
    first = integers(np.array([r["vector"] for r in kept.orderBy(*order).select("vector").limit(entries).collect()]))
    books = np.split(first, parts, axis=1)
    # Ids and labels travel as text: pandas has no whole numbers beside nulls.
    text = kept.select(F.col("vec_id").cast("string"), "vector", F.col("label").cast("string"))
    blocks = written(text.mapInPandas(_blocks(parts), "vec_id array<string>, label array<string>, trees binary"), "vector-trees")
    for _ in range(rounds):
        learnt = blocks.select("trees").mapInPandas(_round_sums(books), "part int, entry int, n long, sums array<long>")
        cells = learnt.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
        # At most parts * entries * d rows, whatever the table's size; sums of more than 64 bits stay exact.
        totals = cells.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
        books = [b.copy() for b in books]
        for r in totals:
            books[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
    encoded = blocks.mapInPandas(_assigned(books), "vec_id string, label string, code string, error long")
    return books, encoded.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()], "code", "error")


def books_sha256(books: list[np.ndarray]) -> str:
    text = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def compressed(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row for each kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    books, encoded = fit_and_encode(vectors, id, vector, label)
    encoded = written(encoded, "vector-codes")
    total = encoded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    # One key more than the totals have: the join shuffles by itself, and a frequent label's rows can be split.
    keyed = lambda df: df.withColumn("_none", F.col("label").isNull()).withColumn("_key", F.coalesce(F.col("label").cast("string"), F.lit(""))).withColumn("_more", F.crc32(F.col("_key").cast("binary")))
    out = keyed(encoded).join(keyed(total).drop("label"), ["_none", "_key", "_more"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
