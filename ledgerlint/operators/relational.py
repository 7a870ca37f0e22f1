"""Row-level relational steps of the cleaning job (R1-R4, R6, R8, R12-R15)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.digest import named
from ..functions.lookups import ROW_ID_PATTERN


# R2 -------------------------------------------------------------------------
def drop_null_key(df: DataFrame, key: str = "customer_id") -> DataFrame:
    return df.dropna(subset=[key])


# R1 -------------------------------------------------------------------------
def dedup_by_key(df: DataFrame, keys: Sequence[str] = ("customer_id",), tiebreak: str | None = "src_row", null_keys: bool = False) -> DataFrame:
    """Keep one row per key: the one with the smallest ``tiebreak``, then the smallest whole row.

    The order is total, so the survivor never depends on partitioning; without
    a tiebreak column the whole row alone decides (nulls first).

    Null keys are removed first (R2): they would form one group that is
    dropped afterwards anyway, and removing them shrinks the shuffle.  With
    ``null_keys`` they stay, and a null counts as a key's value like any other.

    Planned as ``groupBy(keys).agg(min(struct(tiebreak, rest)))``: the
    partial aggregate runs before the exchange, so each map task ships at most
    one row per key.  A key that holds a third of all rows therefore costs
    one row per map task in the shuffle instead of landing in one task, which
    a ``row_number()`` window would do.
    """
    keys = list(keys)
    if not null_keys:
        df = df.filter(reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys]))
    rest = [c for c in df.columns if c not in keys]
    # A struct is never null, so a key whose rows all lack a tiebreak still keeps one of them.
    first = [named(tiebreak).isNull().alias("_no_tiebreak"), named(tiebreak).alias("_tiebreak")] if tiebreak in df.columns else []
    survivor = F.min(F.struct(F.struct(*first, F.lit(0).alias("_")).alias("order"), F.struct(*map(named, rest), F.lit(0).alias("_")).alias("row"))).alias("_first")
    return df.groupBy(*map(named, keys)).agg(survivor).select(*[named(c) if c in keys else F.col("_first.row").getField(c).alias(c) for c in df.columns])


# R3 -------------------------------------------------------------------------
def id_filter(df: DataFrame, columns: Sequence[str] = ("customer_id", "transaction_id"), pattern: str = ROW_ID_PATTERN) -> DataFrame:
    """Keep rows whose raw ids all match ``pattern`` (null fails); no columns, no filter.

    The test is one expression, not a conjunction: Spark then keeps it above
    the one-row-per-key aggregate, whose shuffle the branches of the job share.
    """
    if not columns:
        return df
    matches = [named(c).rlike(pattern) for c in columns]
    return df.filter(F.coalesce(reduce(lambda a, b: a & b, matches), F.lit(False)))


# R4 -------------------------------------------------------------------------
def drop_columns(df: DataFrame, columns: Sequence[str] = ("unused_field", "temp_data")) -> DataFrame:
    return df.drop(*columns)


# R6 -------------------------------------------------------------------------
def drop_empty_rows(
    df: DataFrame,
    keys: Sequence[str] = ("transaction_id", "customer_id", "legacy_id"),
    null_tokens: Sequence[str] = (),
) -> DataFrame:
    """Drop rows whose non-key columns are all null (works across mixed types).

    ``null_tokens`` (e.g. ``["NULL", ""]``) are treated as null in string
    columns, which lets the filter act on raw text as well.
    """
    non_keys = [c for c in df.columns if c not in keys]
    if not non_keys:
        return df
    types = dict(df.dtypes)

    def present(c: str) -> Column:
        x = named(c)
        if null_tokens and types[c] == "string":
            return x.isNotNull() & ~x.isin(list(null_tokens))
        return x.isNotNull()

    cond = present(non_keys[0])
    for c in non_keys[1:]:
        cond = cond | present(c)
    return df.filter(cond)


# R8 -------------------------------------------------------------------------
def typed_cast(df: DataFrame, columns: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """Cast each listed column that exists to its type (null when invalid).

    Missing columns are skipped, not fatal.  Columns keep the listed order;
    columns not listed are dropped.
    """
    have = set(df.columns)
    out = []
    for name, dtype in columns:
        if name not in have:
            continue
        c = named(name)
        out.append((c if df.schema[name].dataType == dtype else c.try_cast(dtype)).alias(name))
    return df.select(*out)


# R12 ------------------------------------------------------------------------
def top_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """Per column: value counts, the ``n`` most frequent (ties by value, nulls first).

    One pass: the columns are unpivoted to (column, value) and counted with a
    partially aggregated group-by; only the small count table is ranked.
    """
    counts = unpivoted(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return top_ranked(counts, ["column"], n)


def unpivoted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text) of every cell of the listed columns that exist."""
    pairs = [F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value")) for c in columns if c in df.columns]
    return df.select(F.explode(F.array(*pairs)).alias("_cv")).select("_cv.column", "_cv.value")


def top_ranked(counts: DataFrame, group: Sequence[str], n: int, parts: int = 64) -> DataFrame:
    """The ``n`` largest counts of each group with their ``rank`` (ties by value, nulls first).

    Two steps, whatever ``n`` is: the best ``n`` of each of 64 hash parts of a
    group, then the best of those; no task sorts all values of a group.
    """
    order = [F.desc("count"), F.asc_nulls_first("value")]
    part = F.pmod(F.xxhash64("value"), F.lit(parts))
    best = counts.withColumn("_part", part).withColumn("_r", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)))
    best = best.filter(F.col("_r") <= n).drop("_part", "_r")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= n)


# R13 ------------------------------------------------------------------------
def hash_sample(df: DataFrame, fraction: Column | float, key: str | Column) -> DataFrame:
    """Repeatable Bernoulli sample: a row is kept when a hash of its key falls below ``fraction``.

    Unlike ``DataFrame.sample``, the choice depends only on the key, so it is
    the same on every run, every partitioning and after task retries.
    """
    k = F.col(key) if isinstance(key, str) else key
    u = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    frac = F.lit(fraction) if not isinstance(fraction, Column) else fraction
    return df.filter(u < frac)


# R14 ------------------------------------------------------------------------
def name_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Distinct lower-cased raw values (not stripped) of ``column``; stays distributed."""
    return df.select(F.lower(F.col(column)).alias("name")).dropna().distinct()


# R15 ------------------------------------------------------------------------
def describe_numeric(df: DataFrame, columns: Sequence[str], cast_text: bool = False) -> DataFrame:
    """count / mean / stddev / min / max per column in a single aggregation pass.

    ``cast_text`` converts text columns with ``try_cast`` first (raw data).
    """
    cols = [c for c in columns if c in df.columns]
    if not cols:
        schema = "column string, count bigint, mean double, stddev double, min double, max double"
        return df.sparkSession.createDataFrame([], schema)

    return numeric_rows(df.agg(*[c.alias(n) for n, c in numeric_aggregates(df, cols, cast_text).items()]), cols)


def numeric_aggregates(df: DataFrame, columns: Sequence[str], cast_text: bool = False) -> dict[str, Column]:
    """The aggregates of :func:`describe_numeric`, by name."""
    out = {}
    for i, c in enumerate(columns):
        v = named(c).try_cast("double") if cast_text or df.schema[c].dataType == T.StringType() else named(c).cast("double")
        out |= {f"count{i}": F.count(v), f"mean{i}": F.avg(v), f"stddev{i}": F.stddev_samp(v), f"min{i}": F.min(v), f"max{i}": F.max(v)}
    return out


def numeric_rows(one: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row for each column from the one row of :func:`numeric_aggregates`."""
    measures = ("count", "mean", "stddev", "min", "max")
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{m}{i}").alias(m) for m in measures]) for i, c in enumerate(columns)])))
