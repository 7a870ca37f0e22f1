"""Plan properties the design relies on at scale (checked on small data)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlint import clean_all
from ledgerlint.operators import quality as Q
from ledgerlint.plans.quality_suite import quality_suite
from ledgerlint.sources.fixture import dirty_transactions


def physical(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_the_job(spark):
    plan = physical(clean_all(dirty_transactions(spark, SF_SMALL)))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_quality_metrics_without_expand(spark):
    plan = physical(Q.quality_metrics(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")))
    assert "Expand" not in plan
    assert "partial_count" in plan


def test_top_k_is_limited_before_the_exchange(spark):
    raw = dirty_transactions(spark, SF_SMALL)
    plan = physical(Q.value_distribution(raw, raw))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_top_k_of_many_values_is_dealt_to_parts(spark):
    """Whatever n is, no task ranks all values of a column."""
    raw = dirty_transactions(spark, SF_SMALL)
    plan = physical(Q.value_distribution(raw, raw, n=5000))
    assert re.search(r"Window .*_part", plan)


def test_job_aggregates_the_raw_rows_once(spark):
    """The name branches reuse the shuffle of the one-row-per-key aggregate, and the wide rows shuffle once."""
    df = clean_all(dirty_transactions(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    wide = [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line and "customer_id" in line]
    assert len(wide) <= 2, plan  # the rows, and the rebuilt names


def test_a_frequent_token_is_split(spark):
    """With a third of all tokens equal and no broadcast, adaptive execution splits that token's rows."""
    from ledgerlint.operators.names import rebuild_full_name

    n = 60_000
    rows = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "john").otherwise(F.concat(F.lit("n"), F.col("id"))).alias("full_name"))
    names = rows.select(F.lower("full_name").alias("name")).distinct()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = rebuild_full_name(rows.repartition(16), names, names.limit(0), "k")
        assert len(out.collect()) == n
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reports_prune_the_written_clean_table(spark):
    with quality_suite(dirty_transactions(spark, SF_SMALL)) as suite:
        plan = physical(suite["business_rules"])
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    read = [re.search(r"FileScan parquet [^\[]*\[([^\]]*)\]", line).group(1) for line in scans]
    assert read and all("notes" not in cols and "merchant_name" not in cols for cols in read), read


def test_load_check_reads_target_bucketed(spark):
    from ledgerlint.schema import CLEAN_SCHEMA
    from ledgerlint.session import fresh_path
    from ledgerlint.sources import target as K

    clean = clean_all(dirty_transactions(spark, SF_SMALL))
    loc = fresh_path(spark, "target")
    name = "t_" + loc.rsplit("-", 1)[-1]
    K.load_if_new(clean, name, CLEAN_SCHEMA, loc)
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table(name).select("customer_id", "transaction_id")
        new = clean.join(stored, ["customer_id", "transaction_id"], "left_anti")
        plan = physical(new)
        scan = [line for line in plan.splitlines() if name in line and "FileScan" in line]
        assert scan and "Bucketed: true" in scan[0]
        assert new.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        if old is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
