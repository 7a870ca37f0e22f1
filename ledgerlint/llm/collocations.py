"""Phrase collocation mining by SON partitioning.

Counts are per language.  A phrase is two or three consecutive words of one
piece of text; one that occurs at least ``min_count`` times is a candidate.  Its
score compares its count with the counts of the two parts of its weakest cut.

1. Documents are dealt to ``SHARDS`` shards by a hash.  By the pigeonhole
   principle a phrase with ``min_count`` occurrences has at least
   ``ceil(min_count / SHARDS)`` in some shard: the proportionally lowered local
   support.  Each shard is mined completely, length by length: words, then pairs
   of which both words are frequent in the shard, then triples of which both
   pairs are.  Counting is a grouped sum of hashed phrases with sums in each task
   first, so a frequent phrase costs one row for each task.
2. The locally frequent phrases of all shards are united.
3. One more pass counts all united phrases globally and exactly, by their words.
   Every part of a frequent phrase is frequent itself, so all counts that a score
   needs are among them.

More than ``min_count - 1`` shards would lower the support to one and prune
nothing, so a shard is a share of the corpus that the whole cluster mines, not
one task's partition.  Sets of frequent phrases travel as bitmaps of hashes, of
``max_filter_bytes`` at most; a hash that hits a foreign bit only lets a phrase
be counted in vain, never the other way.  Beyond that size more phrases are
counted in vain; results stay exact.  Within one task's batch, phrases of equal
64-bit hashes would be counted as one: the chance is below 1e-8 a batch.

Defined cases: a null text is empty, a null language is ``und``; repeated rows
are separate documents; whole texts are read, however long; ties are ordered by
the phrase's UTF-8 bytes; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.common import _BASE, _BYTE_CODE, _fold, _powers, importable, mix64, slices, text_bytes, written

MIN_COUNT = 10
SHARDS = 3
LONGEST = 3
TOP = 2000
COVERED = 50  # percent of a phrase's occurrences inside one longer candidate, from which it is dropped
MAX_FILTER_BYTES = 32 << 20
BLOCK_BITS = 17  # bits of one block of a bitmap, as a power of two
HELD = 1 << 21  # hashes of a shard that a task holds before it sums them up
SLICE = 1 << 19  # bytes of text whose phrases are counted at a time
SENT = 1 << 15  # rows that a task returns at a time: the JVM holds them outside its heap
READ = 512  # rows whose texts a task has as Python objects at a time
# Bytes that end a piece, and bytes between words of one piece.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"

_ends = np.zeros(256, bool)
_ends[list(PIECE_ENDS)] = True
_inside = ~_ends
_inside[list(BLANKS)] = False


class Words:
    """The words of a few texts: hashes, places in the joined lower-cased bytes, and which run on in one piece."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        self.bytes = _fold[np.frombuffer(b"".join(texts), np.uint8)]
        inside = _inside[self.bytes]
        text_starts = (ends - sizes)[sizes > 0]
        starts, stops = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        starts[text_starts] = inside[text_starts]
        stops[:-1] &= ~inside[1:]
        stops[ends[sizes > 0] - 1] = inside[ends[sizes > 0] - 1]
        self.first, self.last = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        self.text = np.searchsorted(ends, self.first, side="right")
        breaks = np.cumsum(_ends[self.bytes], dtype=np.int32)
        piece = breaks[self.first] if len(self.first) else self.first
        self.runs_on = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])
        power, inverse = _powers(len(self.bytes) + 1)
        with np.errstate(over="ignore"):
            run = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum(_BYTE_CODE[self.bytes] * power[: len(self.bytes)], out=run[1:])
            self.hashes = mix64((run[self.last] - run[self.first]) * inverse[self.first] + (self.last - self.first).astype(np.uint64))

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of the first word of every phrase of ``size`` words within one piece, and the phrase's hash."""
        n = max(0, len(self.first) - size + 1)
        together = np.ones(n, bool)
        for k in range(size - 1):
            together &= self.runs_on[k : k + n]
        at = np.flatnonzero(together)
        out = self.hashes[at]
        with np.errstate(over="ignore"):
            for k in range(1, size):
                out = mix64(out * np.uint64(_BASE) + self.hashes[at + k])
        return at, out


def _keys(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Hashes of phrases within the language that ``seeds`` stands for."""
    with np.errstate(over="ignore"):
        return mix64(hashes + seeds)


def _bits(keys: np.ndarray, bitmap: np.ndarray, shards: np.ndarray | None = None) -> np.ndarray:
    """Whether each key's bit is set in its shard's row of the bitmap (a row is a power of two of 64-bit cells)."""
    bit = keys >> np.uint64(64 - (64 * bitmap.shape[-1]).bit_length() + 1)
    cell = (bit >> np.uint64(6)).astype(np.int64)
    if shards is not None:
        cell += shards * bitmap.shape[-1]
    return (bitmap.ravel()[cell] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(keys)
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first)


def _at_a_time(rows: int, step: int) -> Iterator[slice]:
    return (slice(lo, lo + step) for lo in range(0, rows, step))


def _local_counts(size: int, shorter):
    """(shard, key, n) of the phrases of ``size`` words whose parts one word shorter are frequent in the shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list, list]] = {}

        def rows(shard: int, least: int) -> Iterator[pd.DataFrame]:
            keys, counts = held[shard]
            if sum(map(len, keys)) > least:
                key, n = _summed(keys, counts)
                held[shard] = ([key], [n])
                if len(key) > least // 2:
                    held[shard] = ([], [])
                    for part in _at_a_time(len(key), SENT):
                        yield pd.DataFrame({"shard": np.int32(shard), "key": key[part].view(np.int64), "n": n[part]})

        for b in (whole.iloc[part] for whole in batches for part in _at_a_time(len(whole), READ)):
            texts, seeds, shards = b["text"].tolist(), b["seed"].to_numpy().astype(np.int64).view(np.uint64), b["shard"].to_numpy().astype(np.int64)
            for lo, hi in slices(texts, SLICE):
                words = Words(texts[lo:hi])
                at, hashes = words.phrases(size)
                seed, shard = seeds[lo:hi][words.text], shards[lo:hi][words.text]
                if shorter is not None:
                    part_at, part = words.phrases(size - 1)
                    frequent = np.zeros(len(words.first) + 1, bool)
                    frequent[part_at] = _bits(_keys(part, seed[part_at]), shorter.value, shard[part_at])
                    both = frequent[at] & frequent[at + 1]
                    at, hashes = at[both], hashes[both]
                keys, shard = _keys(hashes, seed[at]), shard[at]
                for s in np.unique(shard).tolist():
                    key, n = np.unique(keys[shard == s], return_counts=True)
                    own = held.setdefault(s, ([], []))
                    own[0].append(key)
                    own[1].append(n.astype(np.int32))
                    yield from rows(s, HELD // 2)
        for s in list(held):
            yield from rows(s, 0)

    return run


def _merged_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bits of each block; a task has whole blocks."""
    blocks: dict[int, np.ndarray] = {}
    for b in batches:
        for block, at in b.groupby("block")["at"]:
            bits = blocks.setdefault(int(block), np.zeros(1 << BLOCK_BITS, bool))
            bits[at.to_numpy()] = True
    yield pd.DataFrame({"block": list(blocks), "bits": [np.packbits(x, bitorder="little").tobytes() for x in blocks.values()]}).astype({"block": "int64"})


def _bitmap(keys: DataFrame, shards: int, max_filter_bytes: int) -> np.ndarray:
    """A row of bits for each shard, together 16 or more for each key, up to ``max_filter_bytes`` in all."""
    wanted = max(1, 16 * keys.count() // shards - 1).bit_length()
    bits = max(BLOCK_BITS, min(wanted, (8 * max_filter_bytes // shards).bit_length() - 1))
    n_blocks = 1 << (bits - BLOCK_BITS)
    bit = F.shiftrightunsigned("key", 64 - bits)
    placed = keys.select((F.shiftright(bit, BLOCK_BITS) + F.col("shard") * n_blocks).alias("block"), (bit % (1 << BLOCK_BITS)).cast("int").alias("at"))
    merged = placed.repartition(min(shards * n_blocks, 512), "block").mapInPandas(_merged_blocks, "block long, bits binary").toPandas()  # at most max_filter_bytes
    bitmap = np.zeros((shards * n_blocks, (1 << BLOCK_BITS) // 8), np.uint8)
    for block, raw in zip(merged["block"], merged["bits"]):
        bitmap[block] = np.frombuffer(raw, np.uint8)
    return bitmap.reshape(shards, -1).view("<u8")


def _phrase_array(words: Words, at: np.ndarray, size: int) -> pa.Array:
    """The phrases of ``size`` words from the given ones on, their words joined by single spaces, as a binary array."""
    starts = np.stack([words.first[at + j] for j in range(size)], axis=1).ravel()
    lengths = np.stack([words.last[at + j] for j in range(size)], axis=1).ravel() - starts + 1  # each with one byte for a space
    ends = np.cumsum(lengths)
    where = np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
    body = words.bytes[np.minimum(where, len(words.bytes) - 1)]
    body[ends - 1] = 0x20
    last = ends.reshape(-1, size)[:, -1]
    keep = np.ones(len(body), bool)
    keep[last - 1] = False  # no space after the last word
    offsets = np.concatenate([[0], last - np.arange(1, len(at) + 1)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body[keep].tobytes())])


def _global_counts(united: list):
    """(lang, size, phrase, n) of all united phrases; size 0 stands for the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: dict[int, list[tuple]] = {size: [] for size in range(len(united) + 1)}  # keys, counts, languages, phrases

        def rows() -> Iterator[pa.RecordBatch]:
            for size, parts in held.items():
                if parts:
                    keys, n, lang = (np.concatenate([p[k] for p in parts]) for k in range(3))
                    phrases = pa.concat_arrays([p[3] for p in parts])
                    parts.clear()
                    order = np.argsort(keys)
                    keys = keys[order]
                    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                    n, one = np.add.reduceat(n[order], first).astype(np.int64), order[first]
                    del keys, order, first
                    spoken = pa.array(list(names), pa.string())
                    for part in _at_a_time(len(one), SENT):
                        at = one[part]
                        columns = [spoken.take(pa.array(lang[at])), pa.array(np.full(len(at), size, np.int32)), phrases.take(pa.array(at)), pa.array(n[part])]
                        yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

        for b in (whole.slice(part.start, READ) for whole in batches for part in _at_a_time(whole.num_rows, READ)):
            texts, langs = b["text"].to_pylist(), b["lang"].dictionary_encode()
            codes = np.array([names.setdefault(x, len(names)) for x in langs.dictionary.to_pylist()], np.int64)
            lang_of, seeds = codes[langs.indices.to_numpy()], b["seed"].to_numpy().view(np.uint64)
            for lo, hi in slices(texts, SLICE):
                words = Words(texts[lo:hi])
                of_word = lang_of[lo:hi][words.text]
                lang, n = np.unique(of_word, return_counts=True)
                held[0].append((lang.astype(np.uint64), n, lang, pa.array([b""] * len(lang), pa.binary())))
                for size, bitmap in enumerate(united, 1):
                    at, hashes = words.phrases(size)
                    keys = _keys(hashes, seeds[lo:hi][words.text[at]])
                    known = _bits(keys, bitmap.value)
                    at = at[known]
                    keys, one, n = np.unique(keys[known], return_index=True, return_counts=True)
                    held[size].append((keys, n, of_word[at[one]], _phrase_array(words, at[one], size)))
                if sum(len(p[0]) for parts in held.values() for p in parts) > HELD // 2:
                    yield from rows()
        yield from rows()

    return run


def counted(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    shards: int = SHARDS,
    longest: int = LONGEST,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """lang, size, phrase, n of every phrase of up to ``longest`` words with at least ``min_count`` occurrences.

    Rows of size 0 have the number of words of each language.
    """
    importable(docs.sparkSession)
    support = -(-min_count // shards)
    own = docs.select(text_bytes(docs[text]).alias("text"), F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"))
    own = own.withColumn("seed", F.xxhash64("lang"))
    dealt = own.select("text", "seed", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"))
    shared, local, united = docs.sparkSession.sparkContext.broadcast, None, []
    for size in range(1, longest + 1):
        counts = dealt.mapInPandas(_local_counts(size, local), "shard int, key long, n long")
        frequent = counts.groupBy("shard", "key").agg(F.sum("n").alias("n")).filter(F.col("n") >= support).select("shard", "key")
        bitmap = _bitmap(written(frequent, "frequent-phrases"), shards, max_filter_bytes)
        local = shared(bitmap)
        united.append(shared(np.bitwise_or.reduce(bitmap, axis=0)))
    found = own.mapInArrow(_global_counts(united), "lang string, size int, phrase binary, n long")
    totals = found.groupBy("lang", "size", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))
    return written(totals.filter((F.col("n") >= min_count) | (F.col("size") == 0)), "phrase-counts")


def ranked(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP, min_count: int = MIN_COUNT, covered: int = COVERED, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    counts = counted(docs, text, lang, min_count, shards)
    words = counts.filter("size = 0").select("lang", F.col("n").alias("words"))
    part = lambda name, n: counts.filter("size > 0").select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    phrases = counts.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    joined = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("head"), joined(F.col("cut") + 1, F.size("w") - F.col("cut")).alias("tail"))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    exact = "cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * 1000000 div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    cuts = cuts.withColumn("score", F.expr(exact).cast("long"))
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("x")).select("lang", "phrase", "x.a", "x.l", "x.r", "x.score")
    # Every shorter run of words of a longer candidate, with the most frequent such candidate.
    size = F.size("w")
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice("w", i, k), " ")))))
    longer = phrases.filter("size > 2").select("lang", "a", inner.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    # The best of each hash part first: no task sorts all phrases of a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    kept = kept.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_r") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return kept.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
