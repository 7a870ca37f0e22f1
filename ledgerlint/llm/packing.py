"""Pack tokenised documents into fixed-length sequences by exact complements, then best fit.

A document is its token ids and an end token.  One longer than a sequence is
cut into full pieces; its first piece has the rest.  How pieces are packed
depends on their lengths alone, so the plan is made on the histogram of lengths
(at most one row for each possible length, whatever the number of documents):

Lengths are placed longest first, many alike at once.  For the length at hand
an open sequence's gap is filled up exactly, if the counts allow it: by that
length alone, else by a pair, else by a triple of lengths that it leads and
that sum to the gap; the tightest such gap is taken.  Only where no combination fills a
gap exactly goes the length by best fit into the tightest gap that takes it, or
opens sequences.  A pair's or triple's shorter lengths have at least an eighth
of a sequence: the shortest lengths remain for gaps that nothing else fits.

Each pattern of the plan stands for a run of sequences and for runs of ranks
within its lengths.  Pieces are ranked within their length in a distributed
way and find their sequence by rank; the plan, whose size depends on the
sequence length alone, is what is sent to the tasks.

Defined cases: a null text is empty and still has its end token; repeated rows
are separate documents; an empty table gives an empty result; very long texts
are cut, never shortened; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import PerWorker, running_offsets, written

LENGTH = 1024
END_ID = 2
#: A run of more characters than this without (or of only) white space goes to the tokenizer whose merging is not quadratic in it.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")

PIECES = "doc_id long, tie long, piece int, start long, length long, ids_crc32 long"


class _Encoder:
    """Two public tokenizers of one vocabulary that give the same ids; the first is faster on ordinary text."""

    def __init__(self, ranks: bytes, model: bytes):
        import public_tokenizers
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.fast = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.model, self.steady = model, None

    def __call__(self, text: str) -> np.ndarray:
        if len(text) < 2000 or not LONG_RUN.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        if self.steady is None:
            from tokenizers import Tokenizer

            self.steady = Tokenizer.from_buffer(self.model)
            self.steady.encode_special_tokens = True
        return np.array(self.steady.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces_of(n_tokens: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter."""
    first = n_tokens % length or length
    return [(0, first)] + [(s, length) for s in range(first, n_tokens, length)]


def tokenised(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID, ranks_path: str | None = None, model_path: str | None = None) -> DataFrame:
    """The pieces of every document with the CRC-32 of their ids; the vocabulary files are read by the driver."""
    import public_tokenizers

    context = docs.sparkSession.sparkContext
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f, open(model_path or public_tokenizers.path("byte_bpe_50k.json"), "rb") as g:
        read = f.read(), g.read()
    files, name = context.broadcast(read), sha256(read[0] + read[1]).hexdigest()
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = PerWorker.get(name, lambda: _Encoder(*files.value))  # its tables take tens of MB
        for b in batches:
            out = []
            for doc, tie, body in zip(b["doc_id"], b["tie"], b["body"]):
                ids = np.concatenate([encode(body), end]).astype("<u4")
                out += [(doc, tie, k, s, n, crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(pieces_of(len(ids), length))]
            frame = pd.DataFrame(out, columns=["doc_id", "tie", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    rows = docs.select(docs[id].alias("doc_id"), F.xxhash64(docs[text]).alias("tie"), F.coalesce(docs[text], F.lit("")).alias("body"))
    return rows.mapInPandas(run, PIECES)


def _complement(gap: int, size: int, left: np.ndarray, least: int) -> tuple[int, ...] | None:
    """The lengths, ``size`` first and then no longer ones of ``least`` or more, that sum to the gap; None if there are none left."""
    rest = gap - size
    if rest == 0:
        return (size,)
    if least <= rest <= size and left[rest] > (rest == size):
        return (size, rest)
    longest, shortest = min(size, rest - least), (rest + 1) // 2
    if longest < shortest:
        return None
    a = np.arange(longest, shortest - 1, -1)
    for second in a[(left[a] > 0) & (left[rest - a] > 0)].tolist():
        fill = (size, second, rest - second)
        if all(left[s] >= k for s, k in Counter(fill).items()):
            return fill
    return None


def pack_lengths(counts: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, each with how many sequences have it; every piece of ``counts`` is in one."""
    left = np.zeros(length + 1, np.int64)
    for size, n in counts.items():
        left[size] += n
    plan: Counter = Counter()
    open_: dict[int, Counter] = defaultdict(Counter)  # open patterns by room, with their numbers
    rooms: list[int] = []

    def extend(room: int, fill: tuple[int, ...]) -> None:
        """As many sequences of one pattern and room as the counts allow take the fill."""
        pattern, there = open_[room].popitem()
        need = Counter(fill)
        n = min(there, *(int(left[s]) // k for s, k in need.items()))
        if n < there:
            open_[room][pattern] = there - n
        elif not open_[room]:
            del open_[room]
            rooms.remove(room)
        for s, k in need.items():
            left[s] -= k * n
        place(pattern + fill, n)

    def place(pattern: tuple[int, ...], n: int) -> None:
        room = length - sum(pattern)
        if not room:
            plan[pattern] += n
            return
        if room not in open_:
            insort(rooms, room)
        open_[room][pattern] += n

    for size in range(length, 0, -1):
        while left[size]:
            fitting = rooms[bisect_left(rooms, size) :]
            exact = next(((room, fill) for room in fitting if (fill := _complement(room, size, left, length // 8))), None)
            if exact or fitting:
                extend(*(exact or (fitting[0], (size,))))
            else:
                each = min(length // size, int(left[size]))
                n = int(left[size]) // each
                left[size] -= each * n
                place((size,) * each, n)
    for patterns in open_.values():
        plan.update(patterns)
    return sorted(plan.items(), reverse=True)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank of each run, the sequence of that rank, and the offset there."""
    used: Counter = Counter()
    out: dict[int, list] = defaultdict(list)
    sequence = 0
    for pattern, n in plan:
        offset = 0
        for size in pattern:
            out[size].append((used[size], sequence, offset))
            used[size] += n
            offset += size
        sequence += n
    return {size: tuple(np.array(c, np.int64) for c in zip(*runs)) for size, runs in out.items()}


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, tie, piece, length and others; a stored table)."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `length` rows
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(pack_lengths(counts, length)))
    ranked = running_offsets(pieces, ["length"], ["doc_id", "tie", "piece"], sum(counts.values()), out="rank")

    @F.pandas_udf("sequence_id long, offset long")
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        sizes, ranks = sizes.to_numpy(), ranks.to_numpy()
        order = np.argsort(sizes, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            if len(at):
                first, to, where = slots.value[int(sizes[at[0]])]
                run = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at], offset[at] = to[run] + ranks[at] - first[run], where[run]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn("at", place("length", "rank"))
    return placed.select(*[c for c in pieces.columns if c != "tie"], "at.sequence_id", "at.offset")


def packed_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """Every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(tokenised(docs, id, text, length, **options), "pack-pieces"), length)
