"""Exact duplicates by two-pass Bloom filtering.

Pass one hashes every text into a counting Bloom filter whose counters stop at
two.  A text whose counters have all reached two is *possibly* repeated; all
others are certainly unique.  Pass two sends only the possibly repeated rows
(their SHA-256 and id, not their text) through a shuffle; unique rows pass
straight through.

The filter has 16 counters for each row, up to ``max_filter_bytes`` of one-bit
results (64 MiB by default, the proven bound of what is broadcast).  Beyond
about 33 million rows at that setting more unique rows pass the filter and
shuffle; the result stays exact at any size, and the bound is a parameter.

Defined cases: a null text counts as empty; equal texts are equal byte for
byte; of equal texts the row with the largest id stays (null ids are smaller
than all others); of rows that also share the id exactly one stays; an empty
table gives an empty result; extra columns are ignored by :func:`assign` and
kept by :func:`deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 17  # counters in one block of the filter, as a power of two
MAX_FILTER_BYTES = 64 << 20


def _slot_bits(n_rows: int, max_filter_bytes: int) -> int:
    wanted = max(1, 16 * n_rows - 1).bit_length()
    most = (8 * max_filter_bytes).bit_length() - 1
    return max(BLOCK_BITS, min(wanted, most, 32))


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    u = h.astype(np.int64).view(np.uint64)
    mask = np.uint64((1 << bits) - 1)
    return u & mask, (u >> np.uint64(64 - bits)) & mask


def _count_slots(bits: int):
    """Per task: each counter's slot once, with a flag if this task has reached two."""

    def emit(slots: np.ndarray) -> pd.DataFrame:
        slot, n = np.unique(slots, return_counts=True)
        block = (slot >> np.uint64(BLOCK_BITS)).astype(np.int64)
        at = (slot & np.uint64((1 << BLOCK_BITS) - 1)).astype("<u4")
        at |= (n > 1).astype("<u4") << np.uint32(31)
        edges = np.flatnonzero(np.diff(block, prepend=-1))
        return pd.DataFrame({"block": block[edges], "slots": [x.tobytes() for x in np.split(at, edges[1:])] if len(edges) else []})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            a, c = _slots(b["h"].to_numpy(), bits)
            # A text's two slots may coincide: it must not count itself twice.
            held += [a, c[c != a]]
            size += 2 * len(a)
            if size >= 1_000_000:
                yield emit(np.concatenate(held))
                held, size = [], 0
        if size:
            yield emit(np.concatenate(held))

    return run


def _merge_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by block: one block's counters are in memory at a time."""
    current, seen, twice = None, None, None
    for b in batches:
        for block, raw in zip(b["block"], b["slots"]):
            if block != current:
                if current is not None:
                    yield pd.DataFrame({"block": [current], "bits": [np.packbits(twice, bitorder="little").tobytes()]})
                current, seen, twice = block, np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
            at = np.frombuffer(raw, "<u4")
            slot = at & np.uint32(0x7FFFFFFF)
            twice[slot[(at >> np.uint32(31)) > 0]] = True
            twice[slot[seen[slot]]] = True
            seen[slot] = True
    if current is not None:
        yield pd.DataFrame({"block": [current], "bits": [np.packbits(twice, bitorder="little").tobytes()]})


def possibly_repeated(hashes: DataFrame, n_rows: int, max_filter_bytes: int = MAX_FILTER_BYTES):
    """Pass one over a DataFrame of one long column ``h``; returns a test ``Column -> Column`` of such hashes.

    The test is true for every hash that occurs at least twice, and seldom for others.
    """
    bits = _slot_bits(n_rows, max_filter_bytes)
    n_blocks = 1 << (bits - BLOCK_BITS)
    merged = (
        hashes.mapInPandas(_count_slots(bits), "block long, slots binary")
        .repartition(min(n_blocks, 512), "block")
        .sortWithinPartitions("block")
        .mapInPandas(_merge_blocks, "block long, bits binary")
    )
    filled = np.zeros((1 << bits) // 8, np.uint8)
    step = (1 << BLOCK_BITS) // 8
    for row in merged.toLocalIterator():  # at most max_filter_bytes in all
        filled[row["block"] * step : (row["block"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
    shared = hashes.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        table = shared.value
        out = np.ones(len(h), bool)
        for s in _slots(h.to_numpy(), bits):
            out &= (table[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return pd.Series(out)

    return test


def _flagged(docs: DataFrame, text: str, max_filter_bytes: int) -> DataFrame:
    """All columns in ``row``, the text in ``body`` (null: empty) and the filter's answer in ``maybe``."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    body = packed.select("row", F.coalesce(F.col("row")[text], F.lit("")).alias("body"))
    test = possibly_repeated(body.select(F.xxhash64("body").alias("h")), docs.count(), max_filter_bytes)
    return body.withColumn("maybe", test(F.xxhash64("body")))


def _sha(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def assign(docs: DataFrame, id: str = "doc_id", text: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    flagged = _flagged(docs.select(id, text), text, max_filter_bytes).select(F.col("row")[id].alias("doc_id"), "body", "maybe")
    single = flagged.filter(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        _sha(F.col("body")).alias("text_sha256"),
    )
    # Narrow rows only; the counts before each shuffle make a large group cheap.  The join has a key more than
    # the counts, hence a shuffle of its own, whose large partitions adaptive execution splits.
    per_id = flagged.filter("maybe").groupBy(_sha(F.col("body")).alias("text_sha256"), "doc_id").agg(F.count(F.lit(1)).alias("n"))
    group = per_id.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    repeated = (
        per_id.withColumn("more", F.crc32("text_sha256"))
        .join(group.withColumn("more", F.crc32("text_sha256")), ["text_sha256", "more"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    )
    return single.unionByName(repeated)


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The rows that stay, with all their columns; ties of id are broken by a hash of the row."""
    flagged = _flagged(docs, text, max_filter_bytes)
    single = flagged.filter(~F.col("maybe")).select("row.*")
    order = F.struct(F.col("row")[id], F.xxhash64("row"))
    repeated = flagged.filter("maybe").groupBy(_sha(F.col("body")).alias("key")).agg(F.max_by("row", order).alias("row")).select("row.*")
    return single.unionByName(repeated)
