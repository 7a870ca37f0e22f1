"""C4 cross-check: the distributed join form against an in-row fold.

The fold walks each row's tokens with ``aggregate`` and literal dictionaries;
it only works for small dictionaries, which is why the library uses the join
form.  On the sf0.001 fixture both must agree on every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlint.functions.lookups import EXCLUDE_FIRST, EXCLUDE_LAST, NAME_SUFFIXES
from ledgerlint.functions.text import NOT_WORD_OR_WS_RE, split_words, strip
from ledgerlint.operators.names import full_name_from_dedup
from ledgerlint.operators.relational import dedup_by_key
from ledgerlint.sources.fixture import dirty_transactions


def fold_full_name(col, first_names, last_names):
    fd = F.array(*[F.lit(n) for n in first_names])
    ld = F.array(*[F.lit(n) for n in last_names])
    ex_f = F.array(*[F.lit(n) for n in EXCLUDE_FIRST])
    ex_l = F.array(*[F.lit(n) for n in EXCLUDE_LAST])
    sfx = F.array(*[F.lit(n) for n in NAME_SUFFIXES])
    words = split_words(F.regexp_replace(col, NOT_WORD_OR_WS_RE, " "))

    def step(acc, t):
        low = F.lower(t)
        is_f = F.array_contains(fd, low) & ~F.array_contains(ex_f, low)
        is_l = F.array_contains(ld, low) & ~F.array_contains(ex_l, low)
        is_s = F.array_contains(sfx, low)
        return F.struct(
            F.when(is_f, t).otherwise(acc["f"]).alias("f"),
            F.when(is_f, acc["l"]).when(is_l, t).when(is_s, F.concat(acc["l"], F.lit(" "), t)).otherwise(acc["l"]).alias("l"),
        )

    init = F.struct(F.lit("").alias("f"), F.lit("").alias("l"))
    res = F.aggregate(words, init, step)
    return F.nullif(strip(F.concat(res["f"], F.lit(" "), res["l"])), F.lit(""))


def test_join_form_equals_fold(spark):
    raw = dirty_transactions(spark, SF_SMALL)
    dedup = dedup_by_key(raw)
    first = sorted({r[0] for r in dedup.select(F.lower("first_name")).dropna().distinct().collect()})
    last = sorted({r[0] for r in dedup.select(F.lower("last_name")).dropna().distinct().collect()})
    joined = full_name_from_dedup(raw.select("src_row", "full_name"), dedup, "src_row")
    folded = raw.select("src_row", fold_full_name(F.col("full_name"), first, last).alias("full_name"))
    a = {r["src_row"]: r["full_name"] for r in joined.collect()}
    b = {r["src_row"]: r["full_name"] for r in folded.collect()}
    assert len(a) == raw.count()
    assert a == b
