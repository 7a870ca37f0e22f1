"""Small helpers shared by the text operators: shared-folder tables and vectorised word hashing."""

from __future__ import annotations

import ctypes
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlint.session import fresh_path

# Bytes that separate words, as arrays indexed by byte value.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Words are runs of bytes that are not ASCII white space; nothing is folded.
WHITE_SPACE_WORDS = (~_WHITE, np.arange(256, dtype=np.uint8))
_alnum = np.zeros(256, bool)
_alnum[0x30:0x3A] = _alnum[0x41:0x5B] = _alnum[0x61:0x7B] = _alnum[0x80:] = True
_fold = np.arange(256, dtype=np.uint8)
_fold[0x41:0x5B] += 0x20
#: Words are runs of ASCII letters and digits and of non-ASCII characters, with A-Z lower-cased.
FOLDED_WORDS = (_alnum, _fold)


#: Bytes of rows that a task hands to Python at a time: both sides hold them outside the JVM's heap.
ARROW_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if it is not installed for them, and get their rows in small batches."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [known.get("PYTHONPATH"), root]))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and not again after the loss of an executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class PerWorker:
    """One object that a Python worker keeps between tasks (a tokenizer, a cache): the latest asked for by any operator."""

    latest: tuple | None = None

    @classmethod
    def get(cls, name: str, make):
        if cls.latest is None or cls.latest[0] != name:
            cls.latest = None  # frees the one before first
            cls.latest = (name, make())
        return cls.latest[1]

    @classmethod
    def clear(cls) -> None:
        """Let go of it, and give freed memory back to the system, which a worker would else keep from task to task."""
        cls.latest = None
        if sys.platform == "linux":
            getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)(0)


def text_bytes(col: Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(col, F.lit("")).cast("binary")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (public SplitMix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit values."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE_CODE = seeded(256, 11)
_BASE = 0x5851F42D4C957F2D  # odd, hence invertible modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            old = _POWERS[k]
            _POWERS[k] = np.concatenate([old, old * np.uint64(pow(base, len(old), 1 << 64))])
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[bytes], words: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and the offsets of each text in them.

    Hashes every byte of the whole batch at once (a polynomial over coded
    bytes, taken between word ends by differences of a running sum).
    """
    is_word, fold = words
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    if not len(buf):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = is_word[buf]
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts_at = ends - sizes
    before[starts_at[starts_at < len(buf)]] = False
    first = np.flatnonzero(inside & ~before)
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[ends[ends > 0] - 1] = False
    last = np.flatnonzero(inside & ~after) + 1
    power, inverse = _powers(len(buf) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[fold[buf]] * power[: len(buf)], out=run[1:])
        out = mix64((run[last] - run[first]) * inverse[first] + (last - first).astype(np.uint64))
    offsets = np.concatenate([[0], np.searchsorted(first, ends)])
    return out, offsets


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and the offsets of each text in them.

    A text of fewer words has one shingle, of all its words; a text without words has none.
    """
    n = np.diff(offsets)
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_offsets = np.concatenate([[0], np.cumsum(counts)])
    start = np.repeat(offsets[:-1] - out_offsets[:-1], counts) + np.arange(out_offsets[-1])
    length = np.repeat(np.minimum(n, width), counts)
    acc = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            w = words[np.minimum(start + k, max(len(words) - 1, 0))] if len(words) else words
            acc = np.where(k < length, mix64(acc * np.uint64(_BASE) + w), acc)
    return acc, out_offsets


def slices(texts: list[bytes], max_bytes: int = 1 << 20):
    """Consecutive index ranges of texts of about ``max_bytes`` (one larger text stands alone): bounds memory."""
    lo, total = 0, 0
    for i, t in enumerate(texts):
        if i > lo and total + len(t) > max_bytes:
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def running_offsets(df: DataFrame, group: list[str], order: list[str], n_rows: int, size: Column | None = None, out: str = "offset") -> DataFrame:
    """Add ``out``: the sum of ``size`` (default 1) over the rows of the same group that come before.

    The order is fixed by the values in ``order``.  Groups of any size are dealt
    into small hash buckets; only the buckets' sums are summed up in turn, so no
    task sees a whole group.  Group columns must not be null.
    """
    size = F.lit(1).cast("long") if size is None else size
    n = max(1, -(-n_rows // 400))
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n))).withColumn("_size", size)
    before = lambda keys, by: Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    run = lambda value, keys, by: F.coalesce(F.sum(value).over(before(keys, by)), F.lit(0)).cast("long")
    sums = rows.groupBy(*group, "_bucket").agg(F.sum("_size").alias("_sum")).withColumn("_block", F.floor(F.col("_bucket") / 512))
    blocks = sums.groupBy(*group, "_block").agg(F.sum("_sum").alias("_sum"))
    blocks = blocks.select(*group, "_block", run("_sum", group, ["_block"]).alias("_block_offset"))
    sums = sums.select(*group, "_block", "_bucket", run("_sum", [*group, "_block"], ["_bucket"]).alias("_bucket_offset"))
    starts = sums.join(blocks, [*group, "_block"]).select(*group, "_bucket", (F.col("_block_offset") + F.col("_bucket_offset")).alias("_start"))
    local = rows.withColumn("_local", run("_size", [*group, "_bucket"], order))
    return local.join(starts.hint("merge"), [*group, "_bucket"]).withColumn(out, F.col("_start") + F.col("_local")).drop("_bucket", "_size", "_start", "_local")
