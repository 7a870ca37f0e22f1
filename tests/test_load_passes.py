"""The load queries over large tables: one pass over the raw rows, and no step of a few wide parts."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from ledgerlint.sources import target as K
from conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("l", T.StringType(), False), T.StructField("n", T.LongType())])


def _appended(monkeypatch):
    seen, whole = [], K.align_append
    monkeypatch.setattr(K, "align_append", lambda df, *a, **b: seen.append(df) or whole(df, *a, **b))
    return seen


def test_load_if_new_reads_the_batch_once(spark, tmp_path, monkeypatch):
    seen, name = _appended(monkeypatch), "t_" + uuid.uuid4().hex
    rows = spark.range(6).select(F.concat(F.lit("a"), F.col("id") % 3).alias("k"), F.lit("b").alias("l"), F.col("id").alias("n"))
    assert K.load_if_new(rows, name, SCHEMA, str(tmp_path / "t"), keys=("k", "l")) == 3
    assert sorted(r["n"] for r in spark.table(name).collect()) == [0, 1, 2]
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


@pytest.mark.parametrize("row", [(None, "b", 1), ("a", None, 1), (None, None, 1)])
def test_load_if_new_raises_on_a_row_without_a_key(spark, tmp_path, row):
    rows = spark.createDataFrame([("a", "b", 1), row, row], "k string, l string, n long")
    with pytest.raises(PySparkException, match="must not be null"):
        K.load_if_new(rows, "t_" + uuid.uuid4().hex, SCHEMA, str(tmp_path / "t"), keys=("k", "l"))


def test_load_if_new_keeps_rows_without_an_optional_key(spark, tmp_path):
    name, schema = "t_" + uuid.uuid4().hex, T.StructType([SCHEMA["k"], T.StructField("l", T.StringType()), SCHEMA["n"]])
    rows = spark.createDataFrame([("a", "b", 1), ("a", "b", 0), ("a", None, 2), ("a", None, 2)], "k string, l string, n long")
    assert K.load_if_new(rows, name, schema, str(tmp_path / "t"), keys=("k", "l")) == 3


@pytest.mark.parametrize("query", ["load_if_new", "load_once", "load_batch_skip_whole", "data_exists_all_columns"])
def test_loads_of_one_clean_table_read_it_stored(spark, monkeypatch, query):
    files = []
    for step in ("load_if_new", "load_once", "data_exists"):
        whole = getattr(K, step)
        monkeypatch.setattr(K, step, lambda df, *a, whole=whole, **b: files.extend(df.inputFiles()) or whole(df, *a, **b))
    E.queries()[query](spark, SF_SMALL).count()
    assert files and not [f for f in files if f.endswith("orders.parquet")]


def test_load_replay_deals_rows_to_as_many_parts_as_any_shuffle(spark, monkeypatch):
    plans, whole = [], E.run_job
    monkeypatch.setattr(E, "run_job", lambda raw, *a: plans.append(raw._jdf.queryExecution().logical().toString().splitlines()[0]) or whole(raw, *a))
    E.queries()["load_replay"](spark, SF_SMALL).count()
    assert len(set(plans)) == 2 and not [p for p in plans if re.search(r"\], \d+$", p)], plans
