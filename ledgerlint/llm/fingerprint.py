"""Document fingerprints: threshold-scaled sketches of word shingles.

A fingerprint keeps every hash of a text's five-word shingles that lies below a
fixed fraction of the hash range, so sketches of texts of any length are
comparable, and the sketch of a union is the union of sketches.  A text whose
sketch would hold fewer than ``LEAST`` hashes keeps its ``LEAST`` smallest ones,
which lowers nothing: two sketches are compared below the lesser of the
thresholds up to which each is complete.

Written form: ``n:h1,h2,...`` with the number of distinct shingles and the kept
hashes, ascending, in 16 hexadecimal digits.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased.  Defined cases: a null text is empty; a text without words has the
fingerprint ``0:``; equal fingerprints have likeness 1, and if one is empty it
is 0; rows that share an id are ordered by a hash of the text, null ids come
last; a single document is its own next; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import FOLDED_WORDS, shingle_hashes, slices, text_bytes, word_hashes

WIDTH = 5
FRACTION = 1 / 8
LEAST = 16
RANGE_ROWS = 2_000
#: Ranges of ids that the driver holds at most (with one row each), as a range partitioning does.
MAX_RANGES = 100_000

Sketch = tuple[int, np.ndarray]


def sketches(texts: list[bytes], width: int = WIDTH, fraction: float = FRACTION, least: int = LEAST) -> Iterator[Sketch]:
    """(number of distinct shingles, kept hashes) of each text."""
    limit = np.uint64(int(fraction * 2**64))
    for lo, hi in slices(texts):
        hashes, offsets = shingle_hashes(*word_hashes(texts[lo:hi], FOLDED_WORDS), width)
        for a, b in zip(offsets, offsets[1:]):
            own = np.unique(hashes[a:b])
            yield len(own), own[: max(least, int(np.searchsorted(own, limit)))]


def written_form(sketch: Sketch) -> str:
    return f"{sketch[0]}:" + ",".join(f"{h:016x}" for h in sketch[1].tolist())


def parsed(fingerprint: str) -> Sketch:
    n, _, hashes = fingerprint.partition(":")
    return int(n), np.array([int(h, 16) for h in hashes.split(",") if h], np.uint64)


def _complete_below(sketch: Sketch, limit: int) -> int:
    n, hashes = sketch
    return 1 << 64 if len(hashes) == n else max(limit, int(hashes[-1]) + 1)


def merged(a: Sketch, b: Sketch, fraction: float = FRACTION) -> np.ndarray:
    """Hashes of the union of two texts' shingles, below what both sketches cover."""
    below = min(_complete_below(s, int(fraction * 2**64)) for s in (a, b))
    both = np.union1d(a[1], b[1])
    return both if below > 0xFFFFFFFFFFFFFFFF else both[both < np.uint64(below)]


def likeness(a: Sketch, b: Sketch, fraction: float = FRACTION) -> tuple[float, float]:
    """Estimates of containment (of the lesser in the larger) and of Jaccard similarity."""
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0, 1.0
    below = min(_complete_below(s, int(fraction * 2**64)) for s in (a, b))
    x, y = (s[1] if below > 0xFFFFFFFFFFFFFFFF else s[1][: int(np.searchsorted(s[1], np.uint64(below)))] for s in (a, b))
    if not len(x) or not len(y):
        return 0.0, 0.0
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared / min(len(x), len(y)), shared / (len(x) + len(y) - shared)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """One row per document: doc_id, fingerprint."""

    @F.pandas_udf("string")
    def form(body: pd.Series) -> pd.Series:
        return pd.Series([written_form(s) for s in sketches(body.tolist(), width, fraction)], dtype=object)

    return docs.select(docs[id].alias("doc_id"), form(text_bytes(docs[text])).alias("fingerprint"))


def _ranges(docs: DataFrame, id: str, text: str):
    """A function of (ids, ties) to the ranges each row belongs to, in descending order of ids.

    The first row of each range belongs to the range before too (twice the
    number plus one), as the next document of that range's last row.
    """
    rows = docs.select(docs[id].alias("doc_id"), F.xxhash64(text_bytes(docs[text])).alias("tie"))
    n = min(MAX_RANGES, max(1, -(-docs.count() // RANGE_ROWS)))
    bounds = np.unique(np.array(rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else [], np.float64).astype(np.int64))

    def range_of(ids: pd.Series) -> np.ndarray:
        out = len(bounds) - np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), "left")
        out[ids.isna().to_numpy()] = len(bounds) + 1
        return out

    @F.pandas_udf("long")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(range_of(ids.astype("Int64")))

    found = rows.groupBy(number("doc_id").alias("range")).agg(F.max(F.struct("doc_id", "tie")).alias("first")).collect()  # a row for each range
    found.sort(key=lambda r: r["range"])
    before = {(r["first"]["doc_id"], r["first"]["tie"]): found[k - 1]["range"] for k, r in enumerate(found)}

    @F.pandas_udf("array<long>")
    def places(ids: pd.Series, ties: pd.Series) -> pd.Series:
        ids = ids.astype("Int64")
        own = range_of(ids)
        out = []
        for i, t, r in zip(ids, ties, own):
            also = before.get((None if i is pd.NA else i, t))
            out.append([2 * r] if also is None else [2 * r, 2 * also + 1])
        return pd.Series(out, dtype=object)

    return places


def _edited(text: str, following: str) -> str:
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _pairs(fraction: float, width: int):
    """Rows in order, each with the one that follows it in its range."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for b in batches:
            ids = b["doc_id"].astype("Int64")
            texts = [t.decode() for t in b["body"]]
            rows = [] if last is None else [last]
            rows += zip(b["range"], b["follows"], ids, texts, sketches(b["body"].tolist(), width, fraction))
            if not rows:
                continue
            last = rows[-1]
            pairs = [(x, y) for x, y in zip(rows, rows[1:]) if x[0] == y[0] and not x[1]]
            edits = [_edited(x[3], y[3]).encode() for x, y in pairs]
            out = []
            for (x, y), edit, sketch in zip(pairs, edits, sketches(edits, width, fraction)):
                near, near_j = likeness(x[4], sketch, fraction)
                following, following_j = likeness(x[4], y[4], fraction)
                out.append((x[2], len(x[3]), hashlib.sha256(edit).hexdigest(), written_form(x[4]), written_form(sketch), near, following, near_j, following_j))
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "jaccard_edited", "jaccard_next"]).astype({"doc_id": "Int64"})

    return run


def with_edits(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text and of its edit, whose last third comes from the next document by descending id.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (containment
    estimates), jaccard_edited, jaccard_next.
    """
    places = _ranges(docs, id, text)
    rows = docs.select(docs[id].alias("doc_id"), F.xxhash64(text_bytes(docs[text])).alias("tie"), text_bytes(docs[text]).alias("body"))
    dealt = rows.withColumn("place", F.explode(places("doc_id", "tie")))
    dealt = dealt.select(F.floor(F.col("place") / 2).alias("range"), (F.col("place") % 2 == 1).alias("follows"), "doc_id", "tie", "body")
    ordered = dealt.repartition("range").sortWithinPartitions("range", "follows", F.desc_nulls_last("doc_id"), F.desc("tie"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, jaccard_edited double, jaccard_next double"
    return ordered.mapInPandas(_pairs(fraction, width), schema)
