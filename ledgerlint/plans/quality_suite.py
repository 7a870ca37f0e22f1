"""The full set of quality reports over one cleaning run.

The clean table is written once to the shared folder; every report then reads
that copy (pruned to the columns it needs), so the cleaning plan runs once
however many reports are evaluated.  Five of them (nulls, counts, rules,
statistics, checkpoint) are one aggregate: each table is read once for all
five.  The reports are lazy DataFrames, in the
order the studied suite produced them, and valid until the suite is closed:

    with quality_suite(raw) as reports:
        reports["business_rules"].show()
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..schema import NUMERIC_COLUMNS
from .materialize import Intermediates
from .pipeline import Options, clean_all


Reports = dict[str, DataFrame]


def one_pass(raw: DataFrame, clean: DataFrame, options: Options, store: Callable[[DataFrame], DataFrame]) -> tuple[Reports, Reports]:
    """The reports' parts from one aggregate over each table: rows and numbers of both, nulls, rules and checkpoint of the clean one."""
    cols = [c for c in NUMERIC_COLUMNS if c in raw.columns and c in clean.columns]
    before = Q.combined(raw, {"rows": Q.row_count(), "numbers": Q.numeric_report(raw, cols, cast_text=True)}, store)
    of_clean = {
        "rows": Q.row_count(),
        "numbers": Q.numeric_report(clean, cols),
        "nulls": Q.null_report(clean.columns),
        "rules": Q.rule_report(clean.columns, options.as_of),
        "checkpoint": Q.checkpoint_report(clean.columns),
    }
    return before, Q.combined(clean, of_clean, store)


@contextmanager
def quality_suite(raw: DataFrame, options: Options = Options(), sample_size: int = 100) -> Iterator[Reports]:
    with Intermediates(raw.sparkSession) as written:
        clean = written.write(clean_all(raw, options), "clean")
        before, after = one_pass(raw, clean, options, lambda one: written.write(one, "report-sums"))
        counts = before["rows"].select(F.col("rows").alias("original_rows")).crossJoin(after["rows"].select(F.col("rows").alias("cleaned_rows")))
        rules = after["rules"]
        metrics = Q.quality_metrics(clean)
        yield {
            "clean": clean,
            "null_profile": after["nulls"],
            "business_rules": rules,
            "quality_metrics": metrics,
            "quality_flags": Q.quality_flags(metrics),
            "before_after_counts": Q.difference(counts),
            "value_distribution": Q.value_distribution(raw, clean),
            "stat_compare": Q.sides(before["numbers"], after["numbers"]),
            "sample": Q.sample_validation(clean, sample_size),
            "edge_cases": Q.edge_cases(clean),
            "high_value": Q.high_value(clean),
            "high_risk": Q.high_risk(clean),
            "checkpoint": after["checkpoint"],
            "rule_summary": Q.rule_summary(rules),
        }
