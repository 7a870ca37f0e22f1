"""Reports in one pass, exact samples, digests instead of values, and odd column names."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlint import Options, clean_all
from ledgerlint.operators import quality as Q
from ledgerlint.operators import relational as R
from ledgerlint.plans.quality_suite import one_pass, quality_suite
from ledgerlint.sources import target as K
from ledgerlint.sources.fixture import dirty_transactions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_five_reports_read_each_table_once(spark, tmp_path):
    path = {k: str(tmp_path / k) for k in ("raw", "clean")}
    dirty_transactions(spark, SF_SMALL).write.parquet(path["raw"])
    clean_all(spark.read.parquet(path["raw"])).write.parquet(path["clean"])
    raw, clean = (spark.read.parquet(p) for p in path.values())
    stored = []

    def store(one):
        stored.append(one)
        return one

    before, after = one_pass(raw, clean, Options(), store)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in stored]
    assert [p.count("FileScan") for p in plans] == [1, 1]
    assert rows(after["nulls"]) == rows(Q.null_profile(clean))
    assert rows(after["rules"]) == rows(Q.business_rules(clean))
    assert rows(after["checkpoint"]) == rows(Q.checkpoint(clean))
    both = lambda df: sorted((r["column"], r["side"], r["count"], round(r["mean"] or 0, 6), r["min"], r["max"]) for r in df.collect())
    assert both(Q.sides(before["numbers"], after["numbers"])) == both(Q.stat_compare(raw, clean))


def test_suite_equals_the_single_reports(spark):
    raw = dirty_transactions(spark, SF_SMALL)
    clean = clean_all(raw)
    with quality_suite(raw) as suite:
        for key, single in (("null_profile", Q.null_profile(clean)), ("business_rules", Q.business_rules(clean)), ("before_after_counts", Q.before_after_counts(raw, clean)), ("checkpoint", Q.checkpoint(clean))):
            assert rows(suite[key]) == rows(single), key


def test_combined_keeps_reports_with_equal_aggregate_names_apart(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    out = Q.combined(df, {"x": Q.null_report(["a", "b"]), "y": Q.checkpoint_report(df.columns, ["b"]), "n": Q.row_count()})
    assert [(r["column"], r["null_count"]) for r in out["x"].collect()] == [("a", 1), ("b", 2)]
    assert [(r["column"], round(r["null_pct"], 9), r["status"]) for r in out["y"].collect()] == [("b", 66.666666667, "warning")] and out["n"].first()[0] == 3


def test_exact_sample(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    got = Q.sample_exact(df, 100, "k")
    assert got.count() == 100 and rows(got) == rows(Q.sample_exact(df.repartition(9, "v"), 100, "k"))
    assert Q.sample_exact(df, 9000, "k").count() == 5000 and Q.sample_exact(df.limit(0), 5, "k").count() == 0
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()
    twins = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 1)], "k string, v int")
    assert rows(Q.sample_exact(twins, 10, "k")) == rows(Q.sample_exact(twins.repartition(7), 10, "k"))


def test_distinct_counts_shuffle_digests(spark):
    df = spark.createDataFrame([("x", 0.0, None), ("x", -0.0, None), ("y", float("nan"), None), ("", float("nan"), None)], "a string, b double, c int")
    out = Q.quality_metrics(df)
    assert {r["column"]: r["distinct_values"] for r in out.collect()} == {"a": 3, "b": 2, "c": 0}
    shuffled = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line and "h1" in line]
    assert shuffled and all(re.search(r"hashpartitioning\(i#\d+, h1#\d+L, h2#\d+L", line) for line in shuffled)


ODD = "`a.b` string, `c.d` int, plain string"


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([("x", 1, "p"), ("x", None, "q"), (None, 3, "p")], ODD)
    assert {(r["column"], r["null_count"]) for r in Q.null_profile(df).collect()} == {("a.b", 1), ("c.d", 1), ("plain", 0)}
    assert {r["column"]: r["distinct_values"] for r in Q.quality_metrics(df).collect()} == {"a.b": 1, "c.d": 2, "plain": 2}
    one = R.dedup_by_key(df, ["a.b"], "c.d")
    assert one.columns == df.columns and rows(one) == [("x", 1, "p")]
    assert rows(R.top_values(df, ["a.b"], 1).select("column", "value", "count")) == [("a.b", "x", 2)]
    assert [r["max"] for r in R.describe_numeric(df, ["c.d"]).collect()] == [3.0]
    assert R.drop_empty_rows(df, keys=("plain",)).count() == 3
    other = spark.createDataFrame(df.collect(), ODD)
    assert K.data_exists(df, other, keys=None).first()["matched_rows"] == 1
    assert K.data_exists(df, other, keys=("a.b", "plain")).first()["matched_rows"] == 2
    assert K.aligned(df.select("plain", "`a.b`"), df.schema).columns == df.columns


def test_limited_reports_are_fixed_by_the_whole_row(spark):
    df = spark.createDataFrame([("k", "t", i, 0.9) for i in range(300)], "customer_id string, transaction_id string, n int, risk_score double")
    assert rows(Q.high_risk(df)) == rows(Q.high_risk(df.repartition(11))) and Q.high_risk(df).count() == 20


def test_flags_need_the_metrics_once(spark):
    metrics = Q.quality_metrics(spark.read.parquet(f"{SF_SMALL}/customer.parquet"))
    flags = Q.quality_flags(metrics, 101.0, 50.0)
    want = {(r["column"], "completeness", r["completeness"]) for r in metrics.collect()} | {(r["column"], "uniqueness", r["uniqueness"]) for r in metrics.collect() if r["uniqueness"] < 50.0}
    assert {tuple(r) for r in flags.collect()} == want
    assert "Union" not in flags._jdf.queryExecution().optimizedPlan().toString()
