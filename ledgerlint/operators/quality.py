"""Data-quality reports (Q1-Q15) as DataFrames.

Each report is a single lazy plan, mostly one scan and one aggregation; the
caller decides when to run it.  The reports are schema-generic, so they work
on any table, not only the transaction table.
"""

from __future__ import annotations

import datetime as _dt
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digest import digest, named
from ..schema import CRITICAL_COLUMNS, DISTRIBUTION_COLUMNS, NUMERIC_COLUMNS
from .relational import describe_numeric, hash_sample, numeric_aggregates, numeric_rows, top_ranked, unpivoted


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def _rows(structs: list[Column]) -> Column:
    return F.inline(F.array(*structs))


# Several reports in one pass ---------------------------------------------------
@dataclass(frozen=True)
class Report:
    """A report's aggregates over one table, by name, and how the one row of them becomes the report."""

    aggregates: dict[str, Column]
    rows: Callable[[DataFrame], DataFrame]

    def of(self, df: DataFrame) -> DataFrame:
        return self.rows(df.agg(*[c.alias(n) for n, c in self.aggregates.items()]))


def combined(df: DataFrame, reports: dict[str, Report], store: Callable[[DataFrame], DataFrame] = lambda one: one) -> dict[str, DataFrame]:
    """All reports from one aggregate over ``df``, which is read once.

    ``store`` keeps the one row (a written table, say), so that evaluating the
    reports one after the other does not compute it again.
    """
    one = store(df.agg(*[c.alias(f"{k}/{n}") for k, r in reports.items() for n, c in r.aggregates.items()]))
    return {k: r.rows(one.select(*[named(f"{k}/{n}").alias(n) for n in r.aggregates])) for k, r in reports.items()}


def row_count() -> Report:
    return Report({"rows": F.count(F.lit(1))}, lambda one: one)


# Q1 --------------------------------------------------------------------------
def null_profile(df: DataFrame, nonzero_only: bool = False) -> DataFrame:
    """column, null_count, null_pct, and the table's total_rows and n_columns: one aggregation pass over all columns."""
    return null_report(df.columns, nonzero_only).of(df)


def null_report(cols: Sequence[str], nonzero_only: bool = False) -> Report:
    aggregates = {"_total": F.count(F.lit(1))} | {f"_n{i}": F.count_if(named(c).isNull()) for i, c in enumerate(cols)}
    return Report(aggregates, lambda one: _null_rows(one, cols, nonzero_only))


def _null_rows(one: DataFrame, cols: Sequence[str], nonzero_only: bool) -> DataFrame:
    out = one.select(
        _rows(
            [
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"_n{i}").alias("null_count"),
                    _pct(F.col(f"_n{i}"), F.col("_total")).alias("null_pct"),
                    F.col("_total").alias("total_rows"),
                    F.lit(len(cols)).alias("n_columns"),
                )
                for i, c in enumerate(cols)
            ]
        )
    )
    return out.filter(F.col("null_count") > 0) if nonzero_only else out


# Q2 --------------------------------------------------------------------------
def before_after_counts(original: DataFrame, cleaned: DataFrame) -> DataFrame:
    """original_rows, cleaned_rows, difference, difference_pct in one job (no join)."""
    sides = original.select(F.lit(1).alias("o"), F.lit(0).alias("c")).unionByName(
        cleaned.select(F.lit(0).alias("o"), F.lit(1).alias("c"))
    )
    return difference(sides.agg(F.sum("o").cast("long").alias("original_rows"), F.sum("c").cast("long").alias("cleaned_rows")))


def difference(counts: DataFrame) -> DataFrame:
    """The report from the row with original_rows and cleaned_rows."""
    diff = F.col("original_rows") - F.col("cleaned_rows")
    return counts.select(
        F.coalesce("original_rows", F.lit(0)).alias("original_rows"),
        F.coalesce("cleaned_rows", F.lit(0)).alias("cleaned_rows"),
        F.coalesce(diff, F.lit(0)).alias("difference"),
        _pct(diff, F.col("original_rows")).alias("difference_pct"),
    )


# Q3 --------------------------------------------------------------------------
def value_distribution(
    original: DataFrame,
    cleaned: DataFrame,
    columns: Sequence[str] = DISTRIBUTION_COLUMNS,
    n: int = 10,
) -> DataFrame:
    """side, column, value, count, rank: the ``n`` most frequent values per column and side.

    Ties are broken by value (nulls first) so the cut is repeatable.
    """
    sides = [unpivoted(df, columns).withColumn("side", F.lit(side)) for df, side in ((original, "original"), (cleaned, "cleaned"))]
    counts = sides[0].unionByName(sides[1]).groupBy("side", "column", "value").agg(F.count(F.lit(1)).alias("count"))
    return top_ranked(counts, ["side", "column"], n).select("side", "column", "value", "count", "rank")


# Q4 --------------------------------------------------------------------------
def quality_metrics(df: DataFrame, intended: bool = False, approx_distinct: bool = False) -> DataFrame:
    """Per column: total (non-null), null_count, distinct_values, empty_strings,
    whitespace_only, valid, completeness, uniqueness; a row for every column, also of an empty table.

    ``valid`` subtracts nulls from the non-null count as the studied rule does
    (so completeness can go negative); ``intended=True`` subtracts only empty
    and blank strings.  All but the distinct counts come from one narrow
    aggregate.  Exact distinct counts come from one unpivot of the non-null
    values' 128-bit digests and a two-level group-by (no per-column jobs, no
    multi-distinct expansion, and no text in the shuffle); ``approx_distinct`` adds HyperLogLog sketches to the aggregate
    instead.
    """
    cols = df.columns
    none = F.lit(0).cast("long")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (c, t) in enumerate(df.dtypes):
        x = named(c)
        aggs.append(F.count(x).alias(f"t{i}"))
        aggs.append((F.count_if(x == "") if t == "string" else none).alias(f"e{i}"))
        aggs.append((F.count_if(x.rlike(r"^\s+$")) if t == "string" else none).alias(f"w{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(x).alias(f"d{i}"))
    per_column = [
        F.struct(
            F.lit(i).alias("i"),
            F.lit(c).alias("column"),
            F.col(f"t{i}").alias("total"),
            (F.col("_rows") - F.col(f"t{i}")).alias("null_count"),
            *([F.col(f"d{i}").alias("distinct_values")] if approx_distinct else []),
            F.col(f"e{i}").alias("empty_strings"),
            F.col(f"w{i}").alias("whitespace_only"),
        )
        for i, c in enumerate(cols)
    ]
    counted = df.agg(*aggs).select("_rows", _rows(per_column))
    if not approx_distinct:
        cells = []
        for i, c in enumerate(cols):
            h1, h2 = digest(df, [c])
            cells.append(F.struct(F.lit(i).alias("i"), F.when(named(c).isNotNull(), h1).alias("h1"), h2.alias("h2")))
        values = df.select(F.inline(F.array(*cells))).filter(F.col("h1").isNotNull()).distinct()
        distinct = values.groupBy("i").agg(F.count(F.lit(1)).alias("d"))
        counted = counted.join(distinct, "i", "left").withColumn("distinct_values", F.coalesce("d", F.lit(0)))
    valid = F.col("total") - F.col("empty_strings") - F.col("whitespace_only")
    out = counted.withColumn("valid", valid if intended else valid - F.col("null_count"))
    return out.select(
        "column",
        "total",
        "null_count",
        "distinct_values",
        "empty_strings",
        "whitespace_only",
        "valid",
        _pct(F.col("valid"), F.col("_rows")).alias("completeness"),
        F.when(F.col("valid") > 0, _pct(F.col("distinct_values"), F.col("valid"))).otherwise(F.lit(0.0)).alias("uniqueness"),
    )


# Q5 --------------------------------------------------------------------------
def quality_flags(metrics: DataFrame, min_completeness: float = 90.0, min_uniqueness: float = 80.0) -> DataFrame:
    """column, check, value for columns below the completeness / uniqueness bars."""
    low = lambda check, bar: F.when(F.col(check) < bar, F.struct("column", F.lit(check).alias("check"), F.col(check).alias("value")))
    return metrics.select(F.inline(F.array_compact(F.array(low("completeness", min_completeness), low("uniqueness", min_uniqueness)))))


# Q6 --------------------------------------------------------------------------
# Rule, column and the range [low, high] outside which a value violates it (None: open).
RANGE_RULES = (
    ("invalid_amounts", "transaction_amount", 0, 100000),
    ("invalid_ages", "age", 0, 120),
    ("invalid_credit_scores", "credit_score", 300, 850),
    ("negative_balances", "account_balance", -10000, None),
    ("extremely_high_balances", "account_balance", None, 10000000),
    ("invalid_risk_scores", "risk_score", 0, 1),
)
# Rule and date column; dates before 1900 or after the day of the report violate it.
DATE_RULES = (
    ("invalid_transaction_dates", "transaction_date"),
    ("invalid_dob_dates", "dob"),
    ("invalid_account_dates", "account_open_date"),
)
FIRST_DATE = _dt.date(1900, 1, 1)
LAST_FOUR = ("invalid_card_last_four", "card_last_four", r"^\d{4}$")


def _outside(c: str, low, high) -> Column:
    tests = [F.col(c) < low] * (low is not None) + [F.col(c) > high] * (high is not None)
    return reduce(lambda a, b: a | b, tests)


def rule_conditions(as_of: Column) -> list[tuple[str, str, Column]]:
    """(rule, column, violation) of every business rule."""
    rules = [(name, c, _outside(c, low, high)) for name, c, low, high in RANGE_RULES]
    rules += [(name, c, _outside(c, F.lit(FIRST_DATE), as_of)) for name, c in DATE_RULES]
    return [*rules, (LAST_FOUR[0], LAST_FOUR[1], ~F.col(LAST_FOUR[1]).rlike(LAST_FOUR[2]))]


def business_rules(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """rule, violations, violation_pct; nulls never count; rules on absent columns are
    skipped, except the three date rules, which then report 0."""
    return rule_report(df.columns, as_of).of(df)


def rule_report(columns: Sequence[str], as_of: Column | None = None) -> Report:
    always = {name for name, _ in DATE_RULES}
    conditions = rule_conditions(F.current_date() if as_of is None else as_of)
    counts = {name: F.count_if(violated) if c in columns else F.lit(0).cast("long") for name, c, violated in conditions if c in columns or name in always}
    rows = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations"), _pct(F.col(name), F.col("_total")).alias("violation_pct")) for name in counts]
    return Report({"_total": F.count(F.lit(1))} | counts, lambda one: one.select(_rows(rows)))


# Q15 -------------------------------------------------------------------------
def rule_summary(rules: DataFrame) -> DataFrame:
    return rules.select(
        "rule", "violations", F.when(F.col("violations") > 0, "violation").otherwise("passed").alias("status")
    )


# Q7 --------------------------------------------------------------------------
def stat_compare(original: DataFrame, cleaned: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """column, side, count, mean, stddev, min, max; raw text is converted with try_cast."""
    cols = [c for c in columns if c in original.columns and c in cleaned.columns]
    return sides(describe_numeric(original, cols, cast_text=True), describe_numeric(cleaned, cols))


def sides(before: DataFrame, after: DataFrame) -> DataFrame:
    """The report from the statistics of both sides."""
    both = before.withColumn("side", F.lit("original")).unionByName(after.withColumn("side", F.lit("cleaned")))
    return both.select("column", "side", "count", "mean", "stddev", "min", "max")


def numeric_report(df: DataFrame, columns: Sequence[str], cast_text: bool = False) -> Report:
    """The statistics of ``describe_numeric`` as a report."""
    return Report(numeric_aggregates(df, columns, cast_text), lambda one: numeric_rows(one, columns))


# Q8 / Q9 ---------------------------------------------------------------------
def sample_validation(df: DataFrame, sample_size: int = 1000, key: str = "customer_id") -> DataFrame:
    """A repeatable sample of about ``sample_size`` rows (fraction = min(n/total, 1)).

    The total is a scalar subquery, so the plan stays distributed; an empty
    input gives an empty sample.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    fraction = F.least(F.try_divide(F.lit(float(sample_size)), total), F.lit(1.0))
    return hash_sample(df, fraction, key)


def sample_exact(df: DataFrame, sample_size: int = 1000, key: str = "customer_id") -> DataFrame:
    """A repeatable sample of exactly ``sample_size`` rows (all rows of a smaller table).

    The rows whose keys have the least hashes: a top-k, so no total is needed
    and each task passes on ``sample_size`` rows at most.  Rows that share a
    key are ordered by a digest of the whole row.
    """
    return df.orderBy(F.md5(named(key).cast("string")), *digest(df, df.columns)).limit(sample_size)


# Q10 / Q11 -------------------------------------------------------------------
# Condition, column, comparison and the value compared with.
EDGE_RULES = (
    ("amount_gt_10000", "transaction_amount", "gt", 10000),
    ("amount_lt_1", "transaction_amount", "lt", 1),
    ("card_type_unknown", "card_type", "eq", "Unknown"),
    ("credit_lt_50", "credit_score", "lt", 50),
    ("credit_gt_800", "credit_score", "gt", 800),
    ("age_lt_18", "age", "lt", 18),
    ("age_gt_80", "age", "gt", 80),
    ("balance_lt_0", "account_balance", "lt", 0),
    ("balance_gt_1000000", "account_balance", "gt", 1000000),
    ("is_fraud", "is_fraud", "eq", True),
    ("is_flagged", "is_flagged", "eq", True),
    ("merchant_has_null", "merchant_name", "contains", "null"),
    ("merchant_blank", "merchant_name", "like", r"^\s*$"),
)
_COMPARE = {"gt": operator.gt, "lt": operator.lt, "eq": operator.eq, "contains": Column.contains, "like": Column.rlike}


def edge_conditions(df: DataFrame) -> list[tuple[str, Column]]:
    """(name, condition) of the edge rules whose column exists."""
    return [(name, _COMPARE[how](F.col(c), value)) for name, c, how, value in EDGE_RULES if c in df.columns]


def _total(df: DataFrame, order_by: Sequence[str]) -> list[Column]:
    """A total order: the listed columns that exist, then a digest of the whole row."""
    return [named(c) for c in order_by if c in df.columns] + list(digest(df, df.columns))


def edge_cases(df: DataFrame, limit: int = 100, order_by: Sequence[str] = ("customer_id", "transaction_id")) -> DataFrame:
    """Rows hitting any edge condition, with the matched condition names in ``reasons``;
    the first ``limit`` by ``order_by`` (a top-k, not a full sort)."""
    named = [F.when(hit, name) for name, hit in edge_conditions(df)]
    reasons = F.concat_ws(",", *named) if named else F.lit("")
    return df.withColumn("reasons", reasons).filter("reasons <> ''").orderBy(*_total(df, order_by)).limit(limit)


# Q12 / Q13 -------------------------------------------------------------------
def high_value(df: DataFrame, threshold: float = 100000, limit: int = 20, order_by: Sequence[str] = ("customer_id", "transaction_id")) -> DataFrame:
    return df.filter(F.col("annual_income") > threshold).orderBy(*_total(df, order_by)).limit(limit)


def high_risk(df: DataFrame, threshold: float = 0.8, limit: int = 20, order_by: Sequence[str] = ("customer_id", "transaction_id")) -> DataFrame:
    return df.filter(F.col("risk_score") > threshold).orderBy(*_total(df, order_by)).limit(limit)


# Q14 -------------------------------------------------------------------------
def checkpoint(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS, warn_above: float = 50.0) -> DataFrame:
    """column, null_pct, status for the critical columns; evaluating it on an
    empty input raises (the job must stop there)."""
    return checkpoint_report(df.columns, columns, warn_above).of(df)


def checkpoint_report(present: Sequence[str], columns: Sequence[str] = CRITICAL_COLUMNS, warn_above: float = 50.0) -> Report:
    cols = [c for c in columns if c in present]
    none = F.array().cast("array<struct<column:string,null_pct:double>>")
    # Every output value depends on the guarded total, so the check cannot be pruned away.
    total = F.when(F.col("_total") == 0, F.raise_error(F.lit("Data pipeline resulted in empty dataset"))).otherwise(
        F.col("_total")
    )
    shares = F.array(*[F.struct(F.lit(c).alias("column"), _pct(F.col(f"_n{i}"), total).alias("null_pct")) for i, c in enumerate(cols)]) if cols else none

    def rows(one: DataFrame) -> DataFrame:
        found = one.select(F.inline(F.when(total >= 0, shares)))
        return found.select("column", "null_pct", F.when(F.col("null_pct") > warn_above, "warning").otherwise("ok").alias("status"))

    return Report({"_total": F.count(F.lit(1))} | {f"_n{i}": F.count_if(named(c).isNull()) for i, c in enumerate(cols)}, rows)
