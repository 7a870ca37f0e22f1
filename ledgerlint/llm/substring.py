"""Substring deduplication with a compressed FM-index for each shard.

A window is ``width`` consecutive words of one document; words covered by a
window whose word sequence also starts elsewhere are removed.

Windows are dealt to shards by content, so that equal windows meet in one
shard whatever the corpus's size: a window's *anchor* is the least hash of its
eight-word runs.  Consecutive windows whose anchor is at the same place form a
*segment* (its text is the windows' union); no two windows of a segment are
equal.  Three steps find the repeated windows:

1. A Bloom filter of anchors (see :mod:`exact_dedup`) drops nearly all segments
   whose anchor occurs once; exact counts drop the others of that kind.
2. Equal segments, compared by 128-bit hashes, are one *content*; all windows of
   a content with two or more places are repeated, with no search at all.
3. Contents that share an anchor are indexed by shard: a BWT in a wavelet
   matrix.  All contents with one place are streamed against their shard's
   index; backward search yields their matching statistics, and the windows at
   or above the threshold are reported.

An anchor of more than ``HOT`` different contents (a passage that very many
documents share, each with other words around) is not indexed: its windows are
counted by both hashes of the whole window, and those in two or more contents
are repeated.  Equal windows have the same anchor, so none is elsewhere.

Words are runs of bytes other than ASCII white space, unchanged, compared by
64-bit hashes.  Defined cases: a null text has no words; texts shorter than a
window are unchanged; repeated rows are separate documents, whose windows
repeat each other; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import WHITE_SPACE_WORDS, mix64, seeded, slices, text_bytes, word_hashes, written
from ledgerlint.llm.exact_dedup import BLOCK_BITS, MAX_FILTER_BYTES, _count_slots, _merge_blocks, _slot_bits, _slots
from ledgerlint.llm.fm_index import FMIndex
from ledgerlint.plans.materialize import Intermediates

WIDTH = 35
ANCHOR_WORDS = 8
HOT = 5_000
SHARD_WORDS = 400_000

_BASES = [int(b) | 1 for b in seeded(2, 41)]


def _runs(n: int) -> list[np.ndarray]:
    """Powers of both bases."""
    out = []
    for base in _BASES:
        p = np.empty(n, np.uint64)
        p[0] = 1
        done = 1
        while done < n:
            take = min(done, n - done)
            p[done : done + take] = p[:take] * np.uint64(pow(base, done, 1 << 64))
            done += take
        out.append(p)
    return out


def _content(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of the word sequences of given starts and lengths."""
    out = []
    with np.errstate(over="ignore"):
        for base, power in zip(_BASES, _runs(len(words) + 1)):
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * power[: len(words)], out=total[1:])
            inverse = pow(base, -1, 1 << 64)
            back = np.empty(len(words) + 1, np.uint64)
            back[0] = 1
            done = 1
            while done <= len(words):
                take = min(done, len(words) + 1 - done)
                back[done : done + take] = back[:take] * np.uint64(pow(inverse, done, 1 << 64))
                done += take
            out.append(mix64((total[start + length] - total[start]) * back[start] + length.astype(np.uint64)).view(np.int64))
    return out


def segments(words: np.ndarray, offsets: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """The segments of all texts: text, start (word in it), windows, anchor, and the content's hashes c1 and c2."""
    n = len(words)
    size = np.diff(offsets)
    counts = np.maximum(size - width + 1, 0)
    total = int(counts.sum())
    if not total:
        return {k: np.empty(0, np.int64) for k in ("text", "start", "windows", "anchor", "c1", "c2")}
    text = np.repeat(np.arange(len(size)), counts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    start = np.arange(total) - first[text]
    m = min(ANCHOR_WORDS, width)
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(m):
            grams[: n - m + 1] = mix64(grams[: n - m + 1] + words[k : n - m + 1 + k]) if n >= m else 0
    span, least, place, have = width - m + 1, grams, np.arange(n, dtype=np.int32), 1
    while have < span:  # the least of `have` grams from each position on, and where it is (the first of equal ones)
        take = min(have, span - have)
        later, there = least[take:], place[take:]
        less = later < least[: n - take]
        least = np.concatenate([np.where(less, later, least[: n - take]), least[n - take :]])
        place = np.concatenate([np.where(less, there, place[: n - take]), place[n - take :]])
        have += take
    at = offsets[:-1][text] + start
    anchor, place = least[at], place[at]
    change = np.ones(total, bool)
    change[1:] = place[1:] != place[:-1]
    at = np.flatnonzero(change)
    windows = np.diff(np.append(at, total))
    c1, c2 = _content(words, offsets[:-1][text[at]] + start[at], windows + width - 1)
    return {"text": text[at], "start": start[at], "windows": windows, "anchor": anchor[at].view(np.int64), "c1": c1, "c2": c2}


class Repeated:
    """A broadcast Bloom filter (see :mod:`exact_dedup`) of the hashes that occur twice, asked inside the tasks' own Python code.

    One Python process a task serves a whole stage: memory for a second one, as
    a chain of functions would start, is worth more than the filter takes.
    """

    def __init__(self, counted: DataFrame, bits: int):
        n_blocks, step = 1 << (bits - BLOCK_BITS), (1 << BLOCK_BITS) // 8
        merged = counted.repartition(min(n_blocks, 512), "block").sortWithinPartitions("block").mapInPandas(_merge_blocks, "block long, bits binary")
        filled = np.zeros((1 << bits) // 8, np.uint8)
        for row in merged.toLocalIterator():  # at most max_filter_bytes in all
            filled[row["block"] * step : (row["block"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
        self.bits, self.shared = bits, counted.sparkSession.sparkContext.broadcast(filled)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """True for every hash that occurs at least twice, and seldom for others."""
        table, out = self.shared.value, np.ones(len(h), bool)
        for s in _slots(h, self.bits):
            out &= (table[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def _counted_anchors(width: int, bits: int):
    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["body"].tolist()
            for lo, hi in slices(texts):
                yield pd.DataFrame({"h": segments(*word_hashes(texts[lo:hi], WHITE_SPACE_WORDS), width)["anchor"]})

    return lambda batches: _count_slots(bits)(anchors(batches))


def _only(member: Repeated):
    """The rows whose ``key`` the filter has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(member(b["key"].to_numpy())))

    return run


def _segment_rows(width: int, maybe: Repeated):
    """The segments of every text whose anchor may occur twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["body"].tolist()
            ids, ties = b["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None), b["tie"].to_numpy()
            for lo, hi in slices(texts):
                s = segments(*word_hashes(texts[lo:hi], WHITE_SPACE_WORDS), width)
                keep = maybe(s["anchor"])
                s = {k: v[keep] for k, v in s.items()}
                yield pd.DataFrame({"doc_id": pd.array(ids[lo:hi][s["text"]], "Int64"), "tie": ties[lo:hi][s["text"]]} | {k: s[k] for k in ("start", "windows", "anchor", "c1", "c2")})

    return run


def _segment_words(width: int):
    """The words of the segments asked for, as bytes of their hashes; of hot anchors each window's two hashes instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["body"].tolist()
            for lo, hi in slices(texts):
                words, offsets = word_hashes(texts[lo:hi], WHITE_SPACE_WORDS)
                out = []
                for k, asked in enumerate(b["asked"].iloc[lo:hi]):
                    own = words[offsets[k] : offsets[k + 1]]
                    for s in asked:
                        if not s["hot"]:
                            out.append((s["anchor"], 0, s["c1"], s["c2"], 0, s["single"], own[s["start"] : s["start"] + s["windows"] + width - 1].tobytes()))
                            continue
                        starts = s["start"] + np.arange(s["windows"])
                        hashes = _content(own, starts, np.full(len(starts), width))
                        out += [(h1, h2, s["c1"], s["c2"], i, s["single"], None) for i, (h1, h2) in enumerate(zip(*(h.tolist() for h in hashes)))]
                yield pd.DataFrame(out, columns=["key", "key2", "c1", "c2", "from", "single", "words"])

    return run


def _search(width: int):
    """Rows sorted by shard: index a shard's texts, and stream those with one place against it."""

    def found(rows: list[tuple]) -> pd.DataFrame:
        texts = [np.frombuffer(r[3], np.uint64) for r in rows]
        asked = np.array([i for i, r in enumerate(rows) if r[2]], np.int64)
        if not len(asked):
            return pd.DataFrame([], columns=["c1", "c2", "hits"])
        hits = FMIndex(texts).repeated_windows(asked, width)
        out = [(rows[i][0], rows[i][1], h.tolist()) for i, h in zip(asked, hits) if len(h)]
        return pd.DataFrame(out, columns=["c1", "c2", "hits"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = None, []
        for b in batches:
            for shard, *row in zip(b["shard"], b["c1"], b["c2"], b["single"], b["words"]):
                if shard != current and held:
                    yield found(held)
                    held = []
                current = shard
                held.append(row)
        if held:
            yield found(held)

    return run


def _remove(width: int, touched: Repeated | None = None):
    """What is left of texts with their covered windows, or, given ``touched``, of the texts whose ``key`` it does not have."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (b.iloc[lo : lo + 500] for b in batches for lo in range(0, len(b), 500)):
            if touched is not None:
                b = b[~touched(b["key"].to_numpy())].assign(covered=None)
            out = []
            for doc, body, covered in zip(b["doc_id"].astype("Int64"), b["body"], b["covered"]):
                words = body.split()  # bytes: ASCII white space alone
                removed = 0
                if covered is not None:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for s in covered:
                        if s["hits"] is None:
                            gone[s["start"]] += 1
                            gone[s["start"] + s["windows"] + width - 1] -= 1
                        else:
                            at = s["start"] + np.asarray(s["hits"], np.int64)
                            np.add.at(gone, at, 1)
                            np.add.at(gone, at + width, -1)
                    keep = np.cumsum(gone)[:-1] == 0
                    removed = int(len(words) - keep.sum())
                    left = [w for w, k in zip(words, keep.tolist()) if k]
                else:
                    left = words
                kept = b" ".join(left)
                out.append((doc, len(words), removed, hashlib.sha256(kept).hexdigest(), kept.decode()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]).astype({"doc_id": "Int64"})

    return run


def _key():
    """One number for a document's id and text: it deals documents and tests membership, and never decides alone."""
    return F.xxhash64("doc_id", "tie")


def _more(*cols: str):
    """A key that only makes a join shuffle by itself, so that adaptive execution can split a frequent one."""
    return F.crc32(F.concat_ws(",", *[F.col(c).cast("string") for c in cols]).cast("binary"))


def _member(found: DataFrame, max_filter_bytes: int) -> Repeated:
    """A filter that has all values of ``key``: given twice, they are repeated."""
    keys = found.select(F.col("key").alias("h"))
    bits = _slot_bits(2 * keys.count(), max_filter_bytes)
    return Repeated(keys.unionAll(keys).mapInPandas(_count_slots(bits), "block long, slots binary"), bits)


def _of_document(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Join on ``key`` and ``tie``, which then deal the rows; ids, which may be null, are compared without being a key of the join."""
    other = found.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.col("key").alias("_key"), *[c for c in found.columns if c not in ("doc_id", "tie", "key")])
    return rows.join(other, (F.col("key") == F.col("_key")) & (F.col("tie") == F.col("_tie")) & F.coalesce(F.col("doc_id") == F.col("_id"), F.col("doc_id").isNull() & F.col("_id").isNull()), how).drop("_id", "_tie", "_key")


def _covered(rows: DataFrame, text_chars: int, width: int, max_filter_bytes: int, tables: Intermediates) -> DataFrame:
    """Repeated windows of each document: doc_id, tie, key, covered (start, windows, hits; hits null: all of them)."""
    # The filter is sized by an estimate (about 6 bytes a word, 14 windows a segment); its size affects speed alone.
    bits = _slot_bits(max(1, text_chars // 80), max_filter_bytes)
    maybe = Repeated(rows.select("body").mapInPandas(_counted_anchors(width, bits), "block long, slots binary"), bits)
    schema = "doc_id long, tie long, start long, windows long, anchor long, c1 long, c2 long"
    kept = tables.write(rows.select("doc_id", "tie", "body").mapInPandas(_segment_rows(width, maybe), schema), "segments")
    first = F.min(F.struct("doc_id", "tie", "start", "windows")).alias("first")
    contents = tables.write(kept.groupBy("anchor", "c1", "c2").agg(F.count(F.lit(1)).alias("places"), first), "contents")
    many = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("different")).filter("different > 1").withColumn("more", _more("anchor"))
    shared = contents.withColumn("more", _more("anchor")).join(many, ["anchor", "more"])
    asked = F.struct("anchor", "c1", "c2", "first.start", "first.windows", (F.col("different") > HOT).alias("hot"), (F.col("places") == 1).alias("single"))
    by_doc = shared.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie")).agg(F.collect_list(asked).alias("asked"))
    by_doc = tables.write(by_doc.withColumn("key", _key()), "asked")
    # Only texts that are asked for shuffle, once: the join's dealing serves the choice of one row of equal ones too.
    wanted = rows.mapInArrow(_only(_member(by_doc, max_filter_bytes)), rows.schema)
    texts = _of_document(wanted, by_doc, "inner").dropDuplicates(["key", "doc_id", "tie"])
    words = texts.select("body", "asked").mapInPandas(_segment_words(width), "key long, key2 long, c1 long, c2 long, `from` long, single boolean, words binary")
    words = written(words, "segment-words")
    windows = words.filter("words is null")
    repeated = windows.groupBy("key", "key2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "key2").withColumn("more", _more("key", "key2"))
    hot = windows.filter("single").withColumn("more", _more("key", "key2")).join(repeated, ["key", "key2", "more"]).select("c1", "c2", F.array("from").alias("hits"))
    n_shards = max(1, (words.agg(F.sum(F.length("words"))).first()[0] or 0) // (8 * SHARD_WORDS))
    sharded = words.filter("words is not null").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(n_shards))).repartition("shard").sortWithinPartitions("shard")
    hits = sharded.select("shard", "c1", "c2", "single", "words").mapInPandas(_search(width), "c1 long, c2 long, hits array<long>")
    hits = hits.unionByName(hot).groupBy("c1", "c2").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    whole = contents.filter("places > 1").select("c1", "c2", F.lit(None).cast("array<long>").alias("hits"))
    known = whole.unionByName(hits).withColumn("more", _more("c1", "c2"))
    found = kept.withColumn("more", _more("c1", "c2")).join(known, ["c1", "c2", "more"])
    return found.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("start", "windows", "hits")).alias("covered")).withColumn("key", _key())


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept_text (the kept words joined by one space)."""
    rows = docs.select(docs[id].alias("doc_id"), F.xxhash64(text_bytes(docs[text])).alias("tie"), text_bytes(docs[text]).alias("body")).withColumn("key", _key())
    chars = rows.agg(F.sum(F.length("body"))).first()[0] or 0
    with Intermediates(docs.sparkSession) as tables:
        covered = written(_covered(rows, chars, width, max_filter_bytes, tables), "covered")
    # Documents without repeated windows pass straight through; only the others shuffle.
    touched = _member(covered, max_filter_bytes)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    clean = rows.select("doc_id", "body", "key").mapInPandas(_remove(width, touched), schema)
    joined = _of_document(rows.mapInArrow(_only(touched), rows.schema), covered, "left").select("doc_id", "body", "covered")
    return clean.unionByName(joined.mapInPandas(_remove(width), schema))
