"""Language-model scoring by context-tree weighting.

A text is its words, lower-cased in A-Z, joined by single spaces and ended by a
newline byte.  Each byte is decomposed into eight binary decisions; a
decision's contexts are the bits already decided in its byte together with the
last 0 to ``depth`` bytes.  Each such context keeps a Krichevsky-Trofimov
estimate of its bits, and the weighted probability of a context is the even
mixture of its own estimate and the product of its children's (the contexts one
byte longer), so all depths are mixed by how well they did in training.  A
text's probability is the product over its bits of the mixture's prediction
along the context path, hence a sum over its runs of ``depth + 1`` bytes.

Training gathers every run of ``depth + 1`` bytes of all training texts with its
count, and every word with its count (for the base score); nothing is capped,
so what is gathered grows with the corpus.  Runs are dealt by their last two
context bytes: subtrees below depth 2 are weighted where they lie, and only the
255 * 256 contexts of depths 0 and 1 meet on the driver.  At most
256**(depth - 1) runs (the possible byte strings) share two context bytes.

Scoring reads each text once.  The most frequent words and runs, at most
``HEAD_WORDS`` and ``HEAD_RUNS``, are broadcast; all others are exploded by document, joined with their
counts or probabilities and summed up again, so any vocabulary works and no
score is approximate.  Words are compared by 64-bit hashes (at 10**9 different
words the chance that any two coincide is 3 %); runs are compared exactly.

Defined cases: a null text is empty and has the end token alone; a null id
trains; without training texts every bit has probability 1/2, N is 0 and the
base score has V = 0; repeated rows count as often as they occur; whole texts
are read, however long; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import WHITE_SPACE_WORDS, PerWorker, importable, mix64, slices, text_bytes, word_hashes, written

DEPTH = 5
HEAD_WORDS = 1 << 18  # words that are broadcast
HEAD_RUNS = 1 << 20  # runs that are broadcast
SMOOTHING = 0.1  # of the base score
HELD = 1 << 21  # runs that a task holds before it passes their counts on
BATCH = 200_000  # runs weighted at once
FIXED_POINT = 1 << 20  # log weights are summed as whole multiples of 2**-20: in any order, with one result
WORD, RUN = 0, 1
END = b"\n"
_END_HASH = int(mix64(np.array([0xE4D], np.uint64))[0])  # the end token's


def normalised(text: bytes) -> bytes:
    """Lower-cased words joined by single spaces; bytes methods know ASCII letters and white space only."""
    return b" ".join(text.lower().split()) + END


def runs_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All runs of ``depth + 1`` bytes of normalised texts, and each text's offsets in them.

    A run's number has the last context byte first, so that sorting brings contexts
    together, and the byte itself last.  A text starts after ``depth`` end bytes.
    """
    buf = np.frombuffer(b"".join(END * depth + t for t in texts), np.uint8)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(np.arange(1, len(texts) + 1) * depth, sizes)
    out = buf[at].astype(np.uint64)
    for d in range(1, depth + 1):
        out |= buf[at - d].astype(np.uint64) << np.uint64(8 * (depth - d + 1))
    return out, offsets


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and end tokens of normalised texts, and each text's offsets in them."""
    words, offsets = word_hashes(texts, WHITE_SPACE_WORDS)
    return np.insert(words, offsets[1:], np.uint64(_END_HASH)), offsets + np.arange(len(offsets))


# --- training ---------------------------------------------------------------------------
def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(keys)
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first)


def _count(depth: int):
    """(kind, key, n): words of training texts, and runs of all texts, with their number in training texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list, list]] = {WORD: ([], []), RUN: ([], [])}

        def rows(least: int) -> Iterator[pd.DataFrame]:
            for kind, (keys, counts) in held.items():
                if sum(map(len, keys)) > least:
                    key, n = _summed(keys, counts)
                    if len(key) > least // 2:
                        yield pd.DataFrame({"kind": np.int32(kind), "key": key.view(np.int64), "n": n})
                        held[kind] = ([], [])
                    else:
                        held[kind] = ([key], [n])

        def add(kind: int, keys: np.ndarray, weight: int) -> None:
            key, n = np.unique(keys, return_counts=True)
            held[kind][0].append(key)
            held[kind][1].append(n * weight)

        for b in batches:
            for train, part in b.groupby("train"):
                texts = [normalised(t) for t in part["text"]]
                for lo, hi in slices(texts):
                    add(RUN, runs_of(texts[lo:hi], depth)[0], int(train))
                    if train:
                        add(WORD, tokens_of(texts[lo:hi])[0], 1)
                    yield from rows(HELD)
        yield from rows(0)

    return run


_HALVES = np.concatenate([[0.5 * np.log(np.pi)], 0.5 * np.log(np.pi) + np.cumsum(np.log(np.arange(0.5, 1 << 16)))])  # log gamma(n + 1/2)
_WHOLES = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1.0, (1 << 16) + 1)))])  # log gamma(n + 1)


def _log_gamma(n: np.ndarray, table: np.ndarray, add: float) -> np.ndarray:
    x = np.maximum(n, 1) + add
    stirling = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < len(table), table[np.minimum(n, len(table) - 1)], stirling)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts of bits."""
    return _log_gamma(zeros, _HALVES, 0.5) + _log_gamma(ones, _HALVES, 0.5) - _log_gamma(zeros + ones, _WHOLES, 1.0) - np.log(np.pi)


def _mixed(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.logaddexp(own, children) - np.log(2.0)


def _share(log_ratio: np.ndarray) -> np.ndarray:
    """The weight of a context's own estimate against its children's product."""
    return 1.0 / (1.0 + np.exp(-np.clip(log_ratio, -700, 700)))


class Subtrees:
    """Counts of sorted runs (with their whole subtrees below depth 2), depth by depth and bit by bit."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray, depth: int):
        self.depth, self.counts, self.keys, self.up = depth, {depth: counts}, {depth: runs}, {}
        for d in range(depth - 1, 1, -1):
            longer = self.keys[d + 1]
            key = (longer >> np.uint64(16) << np.uint64(8)) | (longer & np.uint64(255))
            self.keys[d], self.up[d + 1] = np.unique(key, return_inverse=True)
            self.counts[d] = np.bincount(self.up[d + 1], weights=self.counts[d + 1]).astype(np.int64)

    def bit(self, b: int):
        """{depth: (node of each row, first row of each node, zeros, ones, log weight of own estimate, of children)}, deepest first."""
        out: dict[int, tuple] = {}
        below = None
        for d in range(self.depth, 1, -1):
            key = self.keys[d]
            node = key >> np.uint64(8 - b)
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            number = np.cumsum(np.concatenate([[0], node[1:] != node[:-1]]))
            ones = np.add.reduceat(self.counts[d] * ((key >> np.uint64(7 - b)) & np.uint64(1)).astype(np.int64), first)
            zeros = np.add.reduceat(self.counts[d], first) - ones
            own = log_kt(zeros, ones)
            if below is None:
                children, weight = None, own
            else:
                child_first, child_weight = below
                children = np.bincount(number[self.up[d + 1][child_first]], weights=child_weight, minlength=len(first))
                weight = _mixed(own, children)
            out[d] = (number, first, zeros, ones, own, children)
            below = (first, weight)
        return out, weight


def _batches(blocks: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted runs and counts of some whole blocks at a time."""
    runs, counts, held = [], [], 0
    for b in blocks:
        for r, n in zip(b["runs"], b["counts"]):
            runs.append(np.asarray(r).astype(np.int64).view(np.uint64))
            counts.append(np.asarray(n).astype(np.int64))
            held += len(r)
            if held >= BATCH:
                every = np.concatenate(runs)
                order = np.argsort(every)
                yield every[order], np.concatenate(counts)[order]
                runs, counts, held = [], [], 0
    if held:
        every = np.concatenate(runs)
        order = np.argsort(every)
        yield every[order], np.concatenate(counts)[order]


def _weigh(depth: int):
    """(byte, node, zeros, ones, weight): depth-2 contexts summed up by their last byte; weights in fixed point."""

    def run(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, weights = np.zeros((2, 256 * 256), np.int64), np.zeros(256 * 256)
        for runs, n in _batches(blocks):
            trees = Subtrees(runs, n, depth)
            for b in range(8):
                found, weight = trees.bit(b)
                _, first, zeros, ones, _, _ = found[2]
                key = trees.keys[2][first]
                slot = ((key >> np.uint64(16)) & np.uint64(255)) * np.uint64(256) + np.uint64(1 << b) + ((key & np.uint64(255)) >> np.uint64(8 - b))
                slot = slot.astype(np.int64)
                np.add.at(counts[0], slot, zeros)
                np.add.at(counts[1], slot, ones)
                np.add.at(weights, slot, np.rint(weight * FIXED_POINT))
        at = np.flatnonzero(counts.sum(axis=0))
        yield pd.DataFrame({"slot": at, "zeros": counts[0][at], "ones": counts[1][at], "weight": weights[at]})

    return run


class Top:
    """The contexts of depths 0 and 1: their estimates of a one, and the shares of these."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        own = log_kt(zeros, ones)
        self.one = [(ones + 0.5) / (zeros + ones + 1.0)]
        self.share = [_share(own - below)]
        weight, zeros, ones = _mixed(own, below).sum(axis=0), zeros.sum(axis=0), ones.sum(axis=0)
        self.one.insert(0, (ones + 0.5) / (zeros + ones + 1.0))
        self.share.insert(0, _share(log_kt(zeros, ones) - weight))


def _predict(depth: int, top: Top):
    """(key, n, value): each run's log10 probability of its byte after its context."""

    def run(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for runs, n in _batches(blocks):
            trees = Subtrees(runs, n, depth)
            total = np.zeros(len(runs))
            byte, last = (runs & np.uint64(255)).astype(np.int64), (runs >> np.uint64(8 * depth)).astype(np.int64)
            for b in range(8):
                is_one = (byte >> (7 - b)) & 1 > 0
                found, _ = trees.bit(b)
                row, p = np.arange(len(runs)), None
                for d, (number, _, zeros, ones, own, children) in found.items():
                    if d < depth:
                        row = trees.up[d + 1][row]
                    node = number[row]
                    estimate = (np.where(is_one, ones[node], zeros[node]) + 0.5) / (zeros[node] + ones[node] + 1.0)
                    if p is None:
                        p = estimate
                    else:
                        share = _share(own - children)[node]
                        p = share * estimate + (1.0 - share) * p
                node = (1 << b) + (byte >> (8 - b))
                for one, share in ((top.one[1][last, node], top.share[1][last, node]), (top.one[0][node], top.share[0][node])):
                    p = share * np.where(is_one, one, 1.0 - one) + (1.0 - share) * p
                total += np.log10(p)
            yield pd.DataFrame({"key": runs.view(np.int64), "n": n, "value": total})

    return run


def train(docs: DataFrame, learn: Column, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """A table of kind, key, n, value: words with their count, and all documents' runs with their log10 probability.

    Rows train where ``learn`` is true; ``depth`` is 2 to 6.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(text_bytes(docs[text]).alias("text"), F.coalesce(learn, F.lit(True)).alias("train"))
    counts = rows.mapInPandas(_count(depth), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = written(counts, "token-counts")
    near = F.shiftright("key", 8 * (depth - 1)).alias("near")  # the last two context bytes
    runs = counts.filter(F.col("kind") == RUN).groupBy(near).agg(F.collect_list(F.struct("key", "n")).alias("x"))
    blocks = written(runs.select(F.col("x.key").alias("runs"), F.col("x.n").alias("counts")), "context-blocks")
    weighed = blocks.mapInPandas(_weigh(depth), "slot int, zeros long, ones long, weight double")
    # At most 256 * 255 rows, whatever the corpus's size.
    found = weighed.groupBy("slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum(F.col("weight").cast("decimal(38,0)")).cast("double").alias("weight")).toPandas()
    zeros, ones, below = (np.zeros(256 * 256, t) for t in (np.int64, np.int64, float))
    zeros[found["slot"]], ones[found["slot"]], below[found["slot"]] = found["zeros"], found["ones"], found["weight"] / FIXED_POINT
    top = Top(*(x.reshape(256, 256) for x in (zeros, ones, below)))
    predicted = blocks.mapInPandas(_predict(depth, top), "key long, n long, value double")
    words = counts.filter(F.col("kind") == WORD).withColumn("value", F.col("n").cast("double"))
    return written(words.unionByName(predicted.withColumn("kind", F.lit(RUN))), "context-model")


# --- scoring ----------------------------------------------------------------------------
class Lookup:
    """An open-addressing table of 64-bit keys; a value that is not there is NaN."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, np.nan)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = np.isnan(self.values[at])
            self.keys[at[free]], self.values[at[free]] = keys[left[free]], values[left[free]]  # of rivals the last one stays
            left = left[self.keys[at] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.values[slot]
        left = np.flatnonzero((self.keys[slot] != keys) & ~np.isnan(out))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            out[left] = self.values[slot[left]]
            left = left[(self.keys[slot[left]] != keys[left]) & ~np.isnan(out[left])]
        return out


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"keys": [b["key"].to_numpy(np.int64).tobytes()], "values": [b["value"].to_numpy(float).tobytes()]})


def _gathered(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values on the driver, a partition at a time and as bytes: little besides the arrays is in memory."""
    parts = [(np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["values"], float)) for r in rows.select("key", "value").mapInPandas(_packed, "keys binary, values binary").toLocalIterator()]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0)
    return np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts])


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, offsets[:-1])  # no text is empty: each has its end


def _score(shared, name: str, depth: int, all_in: dict[int, bool]):
    """Sums over what was broadcast, and keys and times of all else, for each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = PerWorker.get(name, lambda: {kind: Lookup(*x) for kind, x in shared.value.items()})
        for b in batches:
            texts = [normalised(t) for t in b["text"]]
            for lo, hi in slices(texts):
                part = b.iloc[lo:hi]
                out = {"id": part["id"].to_numpy(), "held_out": part["held_out"].to_numpy(), "row": [uuid.uuid4().hex for _ in range(lo, hi)]}
                rest = {c: [np.empty(0, np.int64)] * (hi - lo) for k in (WORD, RUN) for c in (f"keys{k}", f"times{k}")}
                for kind, (keys, offsets) in ((WORD, tokens_of(texts[lo:hi])), (RUN, runs_of(texts[lo:hi], depth))):
                    value = tables[kind](keys)
                    there = ~np.isnan(value)
                    if kind == WORD:
                        out["n_tokens"], out["n_known"] = np.diff(offsets), _per_text(there.astype(np.int64), offsets)
                        out["base"] = _per_text(np.where(there, np.log10(np.where(there, value, 1) + SMOOTHING), 0.0), offsets)
                    else:
                        out["n_bytes"], out["score"] = np.diff(offsets), _per_text(np.where(there, value, 0.0), offsets)
                    missing = np.flatnonzero(~there)
                    if len(missing) and all_in[kind]:  # a word that is not in the whole vocabulary
                        out["base"] += np.log10(SMOOTHING) * np.bincount(np.searchsorted(offsets, missing, side="right") - 1, minlength=hi - lo)
                    elif len(missing):
                        of = np.searchsorted(offsets, missing, side="right") - 1
                        cuts = np.searchsorted(of, np.arange(hi - lo + 1))
                        for i in np.unique(of):
                            key, times = np.unique(keys[missing[cuts[i] : cuts[i + 1]]], return_counts=True)
                            rest[f"keys{kind}"][i], rest[f"times{kind}"][i] = key.view(np.int64), times
                yield pd.DataFrame(out | rest)

    return run


def scored(docs: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text", depth: int = DEPTH, head_words: int = HEAD_WORDS, head_runs: int = HEAD_RUNS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Documents that are not held out train the model that scores all of them.
    """
    spark = docs.sparkSession
    model = train(docs, ~held_out, text, depth)
    sizes = {r["kind"]: (r["keys"], r["n"]) for r in model.groupBy("kind").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("n")).collect()}
    distinct, tokens = sizes.get(WORD, (0, 0))
    # The head of each kind: the keys with at least as many occurrences as the least power of two that fits.
    grades = model.groupBy("kind", F.floor(F.log2(F.col("n") + 1)).alias("grade")).agg(F.count(F.lit(1)).alias("keys")).collect()
    shared, least, all_in = {}, {}, {}
    for kind, head in ((WORD, head_words), (RUN, head_runs)):
        found, room = sorted(((r["grade"], r["keys"]) for r in grades if r["kind"] == kind), reverse=True), head
        taken = 0
        while taken < len(found) and found[taken][1] <= room:
            room -= found[taken][1]
            taken += 1
        all_in[kind] = taken == len(found)
        least[kind] = (1 << found[taken - 1][0]) - 1 if taken else 1 << 62
        shared[kind] = _gathered(model.filter((F.col("kind") == kind) & (F.col("n") >= least[kind])))  # at most ``head`` rows
    rows = docs.select(docs[id].cast("string").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_bytes(docs[text]).alias("text"))
    types = "id string, held_out boolean, row string, n_tokens long, n_known long, base double, n_bytes long, score double, keys0 array<long>, times0 array<long>, keys1 array<long>, times1 array<long>"
    first = rows.mapInPandas(_score(spark.sparkContext.broadcast(shared), uuid.uuid4().hex, depth, all_in), types)
    if not all(all_in.values()):
        first = written(first, "scored-heads")  # fixes the rows' names
        of = lambda kind: first.select("row", F.lit(kind).alias("kind"), F.explode(F.arrays_zip(F.col(f"keys{kind}").alias("key"), F.col(f"times{kind}").alias("times"))).alias("x"))
        rest = of(WORD).unionByName(of(RUN)).select("row", "kind", "x.key", "x.times")
        tail = model.filter(F.col("n") < F.when(F.col("kind") == WORD, F.lit(least[WORD])).otherwise(F.lit(least[RUN]))).select("kind", "key", "value")
        found = rest.join(tail, ["kind", "key"], "left")
        is_word = F.col("kind") == WORD
        sums = found.groupBy("row").agg(
            F.sum(F.when(is_word & F.col("value").isNotNull(), F.col("times"))).alias("known"),
            F.sum(F.when(is_word, F.col("times") * F.log10(F.coalesce("value", F.lit(0.0)) + SMOOTHING))).alias("base2"),
            F.sum(F.when(~is_word, F.col("times") * F.col("value"))).alias("score2"),
        )
        zero = lambda c: F.coalesce(c, F.lit(0))
        first = first.drop("keys0", "times0", "keys1", "times1").join(sums, "row", "left").withColumns(
            {"n_known": F.col("n_known") + zero("known"), "base": F.col("base") + zero("base2"), "score": F.col("score") + zero("score2")}
        )
    per_token = float(np.log10(tokens + SMOOTHING * (distinct + 1)))
    return first.select(
        F.col("id").cast(docs.schema[id].dataType).alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def held_out(id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 10; a null id is not held out."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 10 == 0, F.lit(False))
