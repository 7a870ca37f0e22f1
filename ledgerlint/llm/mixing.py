"""Mix sources to target weights, in fixed-length blocks of words.

The words of each source form one stream, cut into blocks of ``block`` words.
A source's target says how many slots of the mix its blocks fill.  Slot ``j``
of a source takes block ``perm(j mod n)`` of its ``n`` blocks, under a
pseudorandom permutation of the source and of the pass ``j div n``; so a block
is taken once before any is taken again.

The mix is dealt to output shards of about ``SHARD_SLOTS`` slots.  How many
slots a shard takes of each source is a multinomial draw conditioned on the
sources' fixed totals: every slot of a source falls into a shard uniformly and
independently (by a hash), and is counted.  Running sums of these counts, shard
after shard, give each shard its own range of the source's slots, hence through
the permutation its blocks.  Slots and blocks meet in a join on the block's index.

The permutation is a composition of three bijections on ``0..n-1``: a rotation
of each run of 1024 indices by a hash of the run, an affine map with a
multiplier prime to ``n``, and another rotation.

All steps are DataFrame functions.  The source table (one row a source with
its weight, as the mix is configured) is held by the driver and broadcast; it
is bounded by ``MAX_SOURCES``, beyond which :func:`source_targets` raises.

Defined cases: a null text has no words; a null source is a source of its own
that sorts last; a document without words has ``taken`` 0; repeated rows are
separate documents; an empty table gives an empty result; extra columns are
ignored by :func:`taken_words` and kept by :func:`mixed_documents`.
"""

from __future__ import annotations

import math
import random
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import running_offsets, written

BLOCK = 64
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
SHARD_SLOTS = 65_536
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"
_RUN = 1024
_CHUNK = 16_384


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut off is shared again."""
    out = [0.0] * len(sizes)
    free = list(range(len(sizes)))
    left = total
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit >= most * sizes[i]]
        if not full:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def _permutation(seed: int, n: int) -> tuple[int, int]:
    """Multiplier (prime to n, below 2**20) and shift of an affine permutation of 0..n-1."""
    rng = random.Random(seed)
    a = rng.randrange(1, 1 << 20)
    while math.gcd(a, n) != 1:
        a = a % (1 << 20) + 1
    return a, rng.randrange(n)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """One row a source: its number, size, target, blocks, slots and permutations. ``sized`` has source and size."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["source_size"]) for r in rows]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
    out = []
    for i, (r, size, target) in enumerate(zip(rows, sizes, targets)):
        n = -(-size // block)
        slots = min(math.ceil(most * n), round(target / size * n)) if size else 0
        maps = [_permutation(crc32(f"{seed} {i} {p}".encode()), n) for p in range(-(-slots // n))] if n else []
        out.append((r["source"], i, size, float(target), n, slots, [a for a, _ in maps], [c for _, c in maps]))
    schema = "source string, source_id int, source_size long, target double, n_blocks long, slots long, multipliers array<long>, shifts array<long>"
    return sized.sparkSession.createDataFrame(out, schema)


def _rotated(at: Column, n: Column, *seed: Column) -> Column:
    """Rotate each full run of 1024 indices by a hash of the run; the last, shorter run stays."""
    run = F.floor(at / _RUN)
    turned = run * _RUN + F.pmod(at + F.pmod(F.xxhash64(*seed, run), F.lit(_RUN)), F.lit(_RUN))  # the sum of whole hashes could overflow
    return F.when((run + 1) * _RUN <= n, turned).otherwise(at)


def _tasks(total_slots: int) -> int:
    """A number of tasks for steps that turn few rows into many slots; a number that is given is not merged into fewer."""
    return min(50_000, max(1, -(-total_slots // (2 * _CHUNK))))


def shard_counts(sources: DataFrame, total_slots: int, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> DataFrame:
    """source_id, shard, n: how many slots of each source a shard takes (shards that take none are left out)."""
    n_shards = max(1, -(-total_slots // shard_slots))
    chunks = sources.filter("slots > 0").select("source_id", "slots", F.explode(F.expr(f"sequence(0L, (slots - 1) div {_CHUNK})")).alias("chunk"))
    chunks = chunks.repartition(_tasks(total_slots), "source_id", "chunk")
    slots = chunks.select("source_id", F.explode(F.expr(f"sequence(chunk * {_CHUNK}, least(slots, (chunk + 1) * {_CHUNK}) - 1)")).alias("slot"))
    shard = F.pmod(F.xxhash64(F.lit(seed + 2), "source_id", "slot"), F.lit(n_shards).cast("long"))
    return slots.groupBy("source_id", shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def slot_plan(sources: DataFrame, total_slots: int, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> DataFrame:
    """Every slot of the mix: shard, source_id, slot, block."""
    counts = shard_counts(sources, total_slots, shard_slots, seed)
    ranges = running_offsets(counts, ["source_id"], ["shard"], max(1, total_slots // shard_slots), F.col("n"), out="first")
    ranges = ranges.join(F.broadcast(sources.select("source_id", "n_blocks", "multipliers", "shifts")), "source_id").repartition(_tasks(total_slots), "source_id", "shard")
    slots = ranges.select("shard", "source_id", "n_blocks", "multipliers", "shifts", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    n = F.col("n_blocks")
    slots = slots.withColumn("pass", F.expr("cast(slot div n_blocks as int)")).withColumn("at", F.expr("slot % n_blocks"))
    slots = slots.withColumn("at", _rotated(F.col("at"), n, F.lit(seed), F.col("source_id"), F.col("pass")))
    slots = slots.withColumn("at", F.expr("(at * multipliers[pass] + shifts[pass]) % n_blocks"))
    slots = slots.withColumn("at", _rotated(F.col("at"), n, F.lit(seed + 1), F.col("source_id"), F.col("pass")))
    return slots.select("shard", "source_id", "slot", F.col("at").alias("block"))


def block_pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each document's share of each block: block, from (word in the document) and words; one row with nulls if it has no words."""
    spans = F.expr(f"CASE WHEN size > 0 THEN sequence(offset div {block}, (offset + size - 1) div {block}) END")
    pieces = placed.withColumn("block", F.explode_outer(spans))
    pieces = pieces.withColumn("from", F.expr(f"greatest(block * {block} - offset, 0L)"))
    return pieces.withColumn("words", F.expr(f"least((block + 1) * {block} - offset, size) - `from`"))


def _mix(sized: DataFrame, weights, share, most, block, seed):
    """Pieces with ``times``, how often their block is taken, and ``shards``, by which ones. ``sized``: doc_id, source, size, tie and others."""
    n_rows = sized.count()
    sources = source_targets(sized, weights, share, most, block, seed)
    total = sources.agg(F.sum("slots")).first()[0] or 0
    named = sized.join(F.broadcast(sources.select(F.col("source").alias("_source"), "source_id", "source_size", "target")), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = running_offsets(named, ["source_id"], ["doc_id", "tie"], n_rows, F.col("size"))
    times = slot_plan(sources, total, seed=seed).groupBy("source_id", "block").agg(F.count(F.lit(1)).alias("times"), F.collect_list("shard").alias("shards"))
    # Spark can't foresee how many slots the source table becomes: without the hint it may broadcast them.
    return block_pieces(placed, block).join(times.hint("merge"), ["source_id", "block"], "left")


def _sized(docs: DataFrame, id: str, text: str, source: str, *more: Column) -> DataFrame:
    return docs.select(docs[id].alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size"), F.xxhash64(docs[text]).alias("tie"), *more)


def taken_words(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS, block: int = BLOCK, seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, shards.

    ``shards`` has the output shards that take words of the document, with how many: ``shard:words``, comma-joined by shard.
    """
    sized = written(_sized(docs, id, text, source), "mix-sizes")
    pieces = _mix(sized, weights, share, most, block, seed)
    # A document with words has its own place in its source's stream; those without are counted and told apart again.
    keys = ["doc_id", "size", "source_size", "target", "source_id", "offset", "tie"]
    by_shard = pieces.withColumn("shard", F.explode_outer("shards")).groupBy(*keys, "shard").agg(F.sum(F.when(F.col("shard").isNotNull(), F.col("words"))).alias("words"), F.count(F.lit(1)).alias("rows"))
    parts = F.array_sort(F.collect_list(F.when(F.col("shard").isNotNull(), F.struct("shard", "words"))))
    found = by_shard.groupBy(*keys).agg(F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"), parts.alias("parts"), F.max("rows").alias("rows"))
    text_of = F.array_join(F.transform("parts", lambda p: F.concat_ws(":", p["shard"].cast("string"), p["words"].cast("string"))), ",")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.when(F.col("size") > 0, F.lit(1).cast("long")).otherwise(F.col("rows"))))
    return found.select("doc_id", "size", "source_size", "target", "taken", text_of.alias("shards"), copies.alias("copy")).drop("copy")


def mixed_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", n_chars: str = "n_chars",
    weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS, block: int = BLOCK, seed: int = 7,
) -> DataFrame:
    """The mix as documents: a row for each pass that takes words of a document, with the words it takes.

    A pass that takes a whole document leaves its text as it is; else the taken
    words are joined by one space.
    """
    # Numbered once and stored: another reading of ``docs`` may be split otherwise and number its rows anew.
    packed = written(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[docs[c] for c in docs.columns]).alias("row")), "mix-rows")
    numbered = packed.select("rid", F.col("row")[id].alias("doc_id"), F.col("row")[source].alias("source"), word_count(F.col("row")[text]).alias("size"), F.xxhash64(F.col("row")[text]).alias("tie"))
    sized = written(numbered, "mix-sizes")
    pieces = _mix(sized, weights, share, most, block, seed).filter("times > 0")
    passes = pieces.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    parts = passes.groupBy("rid", "pass", "size").agg(F.sort_array(F.collect_list(F.struct("from", "words"))).alias("parts"), F.sum("words").alias("n"))
    full = parts.join(packed, "rid")
    body = F.col("row")[text]
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(F.col("all_words"), (p["from"] + 1).cast("int"), p["words"].cast("int")))), " ")
    full = full.withColumn("all_words", F.when(F.col("n") < F.col("size"), words))
    full = full.withColumn("taken_text", F.when(F.col("n") < F.col("size"), cut).otherwise(body))
    new = {text: F.col("taken_text"), n_chars: F.length("taken_text").cast("long")}
    return full.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
