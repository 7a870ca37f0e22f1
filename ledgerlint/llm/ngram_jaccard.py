"""N-gram Jaccard join by chosen paths.

Every document is the set of its runs of five words; two documents are linked
if the Jaccard similarity of their sets is at least 0.8.  Documents with equal
sets are one *node* with a number of copies.

Candidates.  A node's set is embedded as 64 min-wise values.  Each run starts
from all nodes and splits recursively: a bucket chooses a coordinate at random
(with probability 1/4 a second one, so that 1/0.8 children hold a pair on
average) and sends each node on by its value there.  A bucket of at most
``WHOLE`` nodes is compared by brute force on the min-wise values, in blocks of
``SMALL``.  In a larger bucket a few pivots are drawn: nodes much like a pivot are linked to it and
leave (whatever is similar to them is itself linked to the pivot, by the
triangle inequality of the Jaccard distance); the others are split again.
After ``MAX_DEPTH`` splits what is left is compared by brute force in blocks, so
no bucket is cut off.  Runs are repeated until the chance to meet in no run, at
the depth reached, is below 1 - ``recall``; nodes that left with a pivot are
then represented by it.

Verification.  Candidate links only join nodes into components, within which
whole shingle sets are compared exactly, block by block (a large component is
many tasks).  A task returns rows for its nodes, not for pairs: their links and
one edge to the group they belong to.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased.  Defined cases: a text of one to four words is a single shingle;
texts without words (null, empty) have equal, empty sets and form one class;
repeated rows are copies; a null id never names a class unless all its ids are
null; an empty table gives an empty result; extra columns are ignored by
:func:`classes` and kept by :func:`one_of_each`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import FOLDED_WORDS, PerWorker, mix64, seeded, shingle_hashes, slices, text_bytes, word_hashes, written
from ledgerlint.llm.components import components

WIDTH = 5
THRESHOLD = 0.8
COORDINATES = 64
RUNS = 12  # runs started together: enough for RECALL down to four splits
RECALL = 0.9999
#: Nodes in a block of a brute-force comparison (of min-wise values or whole sets), and in a bucket that is not split any more.
SMALL = 1_000
WHOLE = 4_000
MAX_DEPTH = 6
PIVOTS = 4
#: Estimated similarity (64 coordinates: a standard error of 0.05 near 0.8) at or above which a pair is a candidate.
#: A pair at 0.8 misses it with a chance of 4 in a million.
CANDIDATE = 0.55
#: The same with a pivot.  Whatever is at least 0.8 similar to a node that leaves is at least 0.6 similar to its pivot.
PIVOT_LINK = 0.5
LEAVES = 0.8
#: Shingles in one side of a comparison of whole sets; with SMALL it bounds a task's memory.
BLOCK_SHINGLES = 500_000

_MULTIPLIERS = seeded(COORDINATES, 21) | np.uint64(1)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The sorted, distinct shingle hashes of each text."""
    for lo, hi in slices(texts):
        hashes, offsets = shingle_hashes(*word_hashes(texts[lo:hi], FOLDED_WORDS), width)
        for a, b in zip(offsets, offsets[1:]):
            yield np.unique(hashes[a:b])


def _signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone."""
    with np.errstate(over="ignore"):
        return tuple(int(mix64(shingles ^ s).sum(dtype=np.uint64).astype(np.int64)) for s in seeded(2, 31))


def _embedding(shingles: np.ndarray) -> bytes:
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for lo in range(0, len(shingles), 2048):
            values = ((shingles[lo : lo + 2048, None] * _MULTIPLIERS) >> np.uint64(32)).astype(np.uint32)
            np.minimum(out, values.min(axis=0), out=out)
    return out.tobytes()


def _sketcher(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        PerWorker.clear()
        for b in batches:
            rows = []
            for s in _sets(b["body"].tolist(), width):
                rows.append((*_signature(s), len(s), _embedding(s)))
            frame = pd.DataFrame(rows, columns=["s1", "s2", "shingles", "sketch"])
            frame["doc_id"], frame["text_hash"] = b["doc_id"].astype("Int64"), b["text_hash"]
            yield frame

    return run


def _array(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint32).reshape(-1, COORDINATES)


def _children(paths: np.ndarray, sketches: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, path) of the buckets of the next depth, chosen by the path alone."""
    with np.errstate(over="ignore"):
        draw = mix64(paths.astype(np.int64).view(np.uint64) + np.uint64(0x51ED27 * (depth + 1)))
    rows = np.arange(len(paths))
    out = []
    for k, chosen in enumerate((rows, rows[(draw >> np.uint64(62)) == 0])):
        at = ((draw[chosen] >> np.uint64(20 * k)) & np.uint64(COORDINATES - 1)).astype(np.int64)
        with np.errstate(over="ignore"):
            value = sketches[chosen, at].astype(np.uint64) + (at.astype(np.uint64) << np.uint64(32))
            out.append((chosen, mix64(mix64(draw[chosen] + np.uint64(k)) ^ value).view(np.int64)))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _first_paths(runs: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        PerWorker.clear()
        for b in batches:
            sketches = _array(b["sketch"])
            for r in runs:
                root = np.full(len(b), seeded(1, 1000 + r).view(np.int64)[0])
                at, path = _children(root, sketches, 0)
                yield pd.DataFrame({"path": path, "node": b["node"].to_numpy()[at]})

    return run


def _by_pivots(depth: int):
    """Links of nodes to their bucket's pivots, and the paths on which the others go on.

    Rows (a, b, path): a link has a node or pivot in ``b`` and 1 in ``path`` if ``a`` leaves with it; a node that
    goes on has -1 in ``b``.  A node linked to several pivots has a link to the first; the pivots are linked too.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            own, node = _array(b["sketch"]), b["node"].to_numpy()
            pivots = b[[f"pivot{k}" for k in range(PIVOTS)]].to_numpy()
            alike = np.stack([(own == _array(b[f"sketch{k}"])).mean(axis=1) for k in range(PIVOTS)], axis=1)
            other = pivots != node[:, None]
            linked = (alike >= PIVOT_LINK) & other
            some = np.flatnonzero(linked.any(axis=1))
            first = pivots[some, linked[some].argmax(axis=1)]
            leaves = alike.max(axis=1) >= LEAVES
            yield pd.DataFrame({"a": node[some], "b": first, "path": ((alike >= LEAVES) & other).any(axis=1)[some].astype(np.int64)})
            more = linked[some] & (pivots[some] != first[:, None])
            row, k = np.nonzero(more)
            between = np.unique(np.stack([first[row], pivots[some][row, k]], axis=1), axis=0)
            yield pd.DataFrame({"a": between[:, 0], "b": between[:, 1], "path": 0})
            left = np.flatnonzero(~leaves)
            at, path = _children(b["path"].to_numpy()[left], own[left], depth)
            yield pd.DataFrame({"a": node[left][at], "b": -1, "path": path})

    return run


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``keys``, a group at a time."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].iloc[-1].to_numpy() != k[0]).any():
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        parts = np.split(np.arange(len(b)), cuts)
        for p in parts[:-1]:
            held.append(b.iloc[p[0] : p[-1] + 1])
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        held.append(b.iloc[parts[-1][0] :])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _forest(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the least row of each row's component."""
    n = len(linked)
    label = np.arange(n)
    linked = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(linked, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges from each node to the first node of its group of candidates, within a small bucket."""
    PerWorker.clear()
    a, b = [], []
    for g in _groups(batches, ["path", "lo", "hi"]):
        node, sketches = g["node"].to_numpy(), _array(g["sketch"])
        if len(node) == 2:
            if (sketches[0] == sketches[1]).mean() >= CANDIDATE:
                a.append(node[:1])
                b.append(node[1:])
            continue
        alike = np.zeros((len(node), len(node)), np.uint8)
        for c in range(COORDINATES):
            alike += sketches[:, c][:, None] == sketches[:, c][None, :]
        to = node[_forest(alike >= CANDIDATE * COORDINATES)]
        a.append(node[to != node])
        b.append(to[to != node])
        if len(a) > 5000:
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})
            a, b = [], []
    if a:
        yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})


def _in_blocks(buckets: DataFrame, size: str, most: int, key: str = "path") -> DataFrame:
    """Deal a group of ``size`` into blocks of about ``most`` and pair the blocks: (lo, hi, left) for each row's pairings.

    Rows of block ``i`` meet those of block ``j`` in ``(i, j)``; ``left`` tells their sides.  A group of one block has (0, 0).
    """
    n = F.ceil(F.col(size) / most).cast("long")
    own = F.pmod(F.xxhash64("node", key), F.col("_n"))
    dealt = buckets.withColumn("_n", n).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return dealt.select("*", F.least("_own", "_other").alias("lo"), F.greatest("_own", "_other").alias("hi"), (F.col("_own") <= F.col("_other")).alias("left")).drop("_n", "_own", "_other")


def _missed(depth: int) -> float:
    """Chance that a pair at the threshold shares no bucket of this depth in one run."""
    q = 0.0
    for _ in range(depth):
        lost = 1 - THRESHOLD * (1 - q)
        q = lost * (0.75 + 0.25 * lost)
    return q


def _join_size(rows: DataFrame) -> DataFrame:
    """Rows (path, node) of buckets of at least two, with their bucket's size."""
    more = F.crc32(F.col("path").cast("string").cast("binary"))
    sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # One key more than the counts have: the join then shuffles by itself, and a frequent path can be split.
    return rows.withColumn("more", more).join(sizes.withColumn("more", more), ["path", "more"]).drop("more")


def candidate_edges(nodes: DataFrame, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) that connect all candidate pairs of ``nodes`` (node, sketch; a stored table)."""
    active = nodes.select("node", "sketch")
    found, done, met = [], 0, 1.0
    while 1 - met < recall or not done:
        deepest, left, pivot_nodes = 1, [], []
        rows = active.mapInPandas(_first_paths(list(range(done, done + RUNS))), "path long, node long")
        for depth in range(1, MAX_DEPTH + 1):
            sized = written(_join_size(rows), "buckets")
            last = depth == MAX_DEPTH
            small = _in_blocks(sized if last else sized.filter(F.col("size") <= WHOLE), "size", SMALL).join(active, "node")
            small = small.select("path", "lo", "hi", "node", "sketch").repartition("path", "lo", "hi").sortWithinPartitions("path", "lo", "hi")
            found.append(small.mapInPandas(_compare_sketches, "a long, b long"))
            large = sized.filter(F.col("size") > WHOLE)
            if last or large.isEmpty():
                break
            deepest = depth + 1
            large = large.select("path", "node").join(active, "node")
            first = [F.min(F.struct(F.xxhash64("node", F.lit(k)), "node", "sketch")).alias(f"p{k}") for k in range(PIVOTS)]
            pivots = large.groupBy("path").agg(*first)
            pivots = pivots.select("path", *[F.col(f"p{k}.node").alias(f"pivot{k}") for k in range(PIVOTS)], *[F.col(f"p{k}.sketch").alias(f"sketch{k}") for k in range(PIVOTS)])
            more = F.crc32(F.col("path").cast("string").cast("binary"))
            held = large.withColumn("more", more).join(pivots.withColumn("more", more), ["path", "more"]).drop("more")
            split = written(held.mapInPandas(_by_pivots(depth), "a long, b long, path long"), "split")
            links = split.filter("b >= 0")
            found.append(links.select("a", "b"))
            left.append(links.filter("path = 1").select(F.col("a").alias("node")))
            pivot_nodes.append(links.select(F.col("b").alias("node")))
            rows = split.filter("b < 0").select("path", F.col("a").alias("node"))
        done += RUNS
        met *= _missed(deepest) ** RUNS
        if left and 1 - met < recall:
            # What left with a pivot need not run again: its pivot stands for it.
            gone = reduce(DataFrame.union, left).distinct().join(reduce(DataFrame.union, pivot_nodes).distinct(), "node", "left_anti")
            active = written(active.join(gone, "node", "left_anti"), "active")
    return reduce(DataFrame.unionByName, found)


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets numbered ``left`` with those numbered ``right``."""
    both = np.unique(np.concatenate([left, right]))
    size = np.array([len(sets[i]) for i in both])
    value = np.concatenate([sets[i] for i in both]) if len(both) else np.empty(0, np.uint64)
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    owner = np.repeat(both, size)
    row_of, col_of = np.full(len(sets), -1), np.full(len(sets), -1)
    row_of[left], col_of[right] = np.arange(len(left)), np.arange(len(right))
    out = np.zeros((len(left), len(right)), np.float32)
    # Shingles of many documents: products of 0/1 matrices, some columns at a time.
    frequent = np.flatnonzero(times > 8)
    at = np.full(len(times), -1)
    at[frequent] = np.arange(len(frequent))
    keep = at[column] >= 0
    f_owner, f_col = owner[keep], at[column][keep]
    for lo in range(0, len(frequent), 4096):
        part = (f_col >= lo) & (f_col < lo + 4096)
        width = min(4096, len(frequent) - lo)
        matrices = []
        for where, n in ((row_of, len(left)), (col_of, len(right))):
            m = np.zeros((n, width), np.float32)
            r = where[f_owner[part]]
            m[r[r >= 0], f_col[part][r >= 0] - lo] = 1
            matrices.append(m)
        out += matrices[0] @ matrices[1].T
    # Shingles of few documents: their pairs.
    few = (times[column] > 1) & (times[column] <= 8)
    order = np.argsort(column[few], kind="stable")
    c, o = column[few][order], owner[few][order]
    for step in range(-7, 8):
        i = np.arange(max(0, -step), len(c) - max(0, step))
        i = i[c[i] == c[i + step]] if len(i) else i
        r, k = row_of[o[i]], col_of[o[i + step]]
        ok = (r >= 0) & (k >= 0)
        if ok.any():
            out += np.bincount(r[ok] * len(right) + k[ok], minlength=out.size).reshape(out.shape).astype(np.float32)
    return out


def _verify(pairs: bool):
    """Exact comparison within (component, lo, hi): links and an edge for each node, or the pairs themselves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        PerWorker.clear()
        out: list[pd.DataFrame] = []
        held = 0
        for g in _groups(batches, ["root", "lo", "hi"]):
            g = g.drop_duplicates("node")
            node, copies = g["node"].to_numpy(), g["copies"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in g["members"]]
            n = np.array([len(s) for s in sets])
            same = g["lo"].iloc[0] == g["hi"].iloc[0]
            left = np.arange(len(node)) if same else np.flatnonzero(g["left"].to_numpy())
            right = np.arange(len(node)) if same else np.flatnonzero(~g["left"].to_numpy())
            if not len(left) or not len(right):
                continue
            shared = _intersections(sets, left, right).astype(np.float64)
            union = n[left][:, None] + n[right][None, :] - shared
            linked = shared >= THRESHOLD * union - 1e-9
            if same:
                np.fill_diagonal(linked, False)
            if pairs:
                i, k = np.nonzero(np.triu(linked) if same else linked)
                out.append(pd.DataFrame({"a": node[left[i]], "b": node[right[k]], "links": 0, "similarity": shared[i, k] / union[i, k]}))
            else:
                whole = np.zeros((len(node), len(node)), bool)
                whole[np.ix_(left, right)] = linked
                whole |= whole.T
                links = np.zeros(len(node), np.int64)
                links[left] += linked @ copies[right]
                if not same:
                    links[right] += linked.T @ copies[left]
                to = node[_forest(whole)]
                out.append(pd.DataFrame({"a": node, "b": to, "links": links, "similarity": 0.0})[links > 0])
            held += len(out[-1])
            if held > 20_000 or len(out) > 2_000:
                yield pd.concat(out)
                out, held = [], 0
        if out:
            yield pd.concat(out)

    return run


def _members(width: int):
    """The shingle set of each text, from whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(members=[s.tobytes() for s in _sets(b["body"].tolist(), width)]).drop(columns="body")

    return run


def _nodes(docs: DataFrame, id: str, text: str, width: int) -> tuple[DataFrame, DataFrame]:
    """The documents with their sets' signatures, and the distinct sets."""
    rows = docs.select(docs[id].alias("doc_id"), F.xxhash64(text_bytes(docs[text])).alias("text_hash"), text_bytes(docs[text]).alias("body"))
    sketched = written(rows.mapInPandas(_sketcher(width), "s1 long, s2 long, shingles long, sketch binary, doc_id long, text_hash long"), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    nodes = sketched.groupBy("s1", "s2").agg(first, F.count(F.lit(1)).alias("copies"), F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"))
    return sketched, written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _compared(docs: DataFrame, nodes: DataFrame, id: str, text: str, width: int, recall: float, pairs: bool) -> DataFrame:
    groups = written(components(candidate_edges(nodes.filter("shingles > 0"), recall)), "groups")
    # A cell holds its sets and matrices of nodes by nodes: both are bounded.
    most = F.greatest(F.ceil(F.sum("shingles") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / SMALL))
    sizes = groups.join(nodes.select("node", "shingles"), "node").groupBy("root").agg(most.cast("long").alias("size"))
    wanted = groups.join(sizes, "root").join(nodes.select("node", "copies", "first.doc_id", "first.text_hash"), "node")
    texts = docs.select(docs[id].alias("_id"), F.xxhash64(text_bytes(docs[text])).alias("_hash"), text_bytes(docs[text]).alias("body"))
    own = texts.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")))
    own = own.select("root", "node", "size", "copies", "body").mapInPandas(_members(width), "root long, node long, size long, copies long, members binary")
    cells = _in_blocks(own, "size", 1, "root").drop("size").repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")
    return cells.mapInPandas(_verify(pairs), "a long, b long, links long, similarity double")


def _classified(docs: DataFrame, id: str, text: str, width: int, recall: float) -> DataFrame:
    sketched, nodes = _nodes(docs, id, text, width)
    found = written(_compared(docs, nodes, id, text, width, recall, False), "links")
    roots = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = nodes.join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = named.groupBy("root").agg(F.min("first").alias("head"))
    more = F.crc32(F.col("root").cast("string").cast("binary"))
    named = named.withColumn("more", more).join(heads.withColumn("more", more), ["root", "more"])
    named = named.select("s1", "s2", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows = sketched.select("s1", "s2", "doc_id", "text_hash").withColumn("more", F.crc32(F.col("s1").cast("string").cast("binary")))
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    return rows.join(named.withColumn("more", F.crc32(F.col("s1").cast("string").cast("binary"))), ["s1", "s2", "more"]).select(
        "doc_id", F.col("head.doc_id").alias("class_id"), F.col("n_links").cast("long").alias("n_links"), "text_hash", own.eqNullSafe(F.col("head")).alias("is_head")
    )


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (the least id it is linked to over links) and n_links (documents linked to it)."""
    return _classified(docs, id, text, width, recall).select("doc_id", "class_id", "n_links")


def links(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, recall: float = RECALL) -> DataFrame:
    """The linked pairs of distinct sets, each by the least id that has it: id_a, id_b, similarity."""
    _, nodes = _nodes(docs, id, text, width)
    found = _compared(docs, nodes, id, text, width, recall, True)
    for k in "ab":
        found = found.join(nodes.select(F.col("node").alias(k), F.col("first.doc_id").alias(f"id_{k}")), k)
    return found.select("id_a", "id_b", "similarity")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, recall: float = RECALL) -> DataFrame:
    """The rows that head their class, one of each class, with all their columns."""
    heads = _classified(docs, id, text, width, recall).filter("is_head").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id].alias("id"), F.xxhash64(text_bytes(docs[text])).alias("hash"))
    kept = packed.join(heads, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left_semi")
    return kept.dropDuplicates(["id", "hash"]).select("row.*")
