"""Loads with a ledger: exactly once, whatever dies on the way."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlint.sources import target as K

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType())])


@pytest.fixture()
def table(tmp_path):
    return "t_" + uuid.uuid4().hex, str(tmp_path / "target")


def batch(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, name):
    return sorted((tuple(r) for r in K.loaded(spark, name).collect()), key=repr)


ROWS = (("a", 1, 0.5), ("b", 2, None), ("c", 3, 1.5))


def load(spark, df, table, keys=("id",)):
    return K.load_once(df, table[0], SCHEMA, table[1], keys)


def test_a_batch_is_known_in_any_order(spark, table):
    df = batch(spark, *ROWS)
    assert load(spark, df, table) == 3
    assert load(spark, batch(spark, *ROWS[::-1]).repartition(3), table) == 0
    assert stored(spark, table[0]) == sorted(ROWS)


@pytest.mark.parametrize("step", ["_write_load", "_complete_load"])
def test_a_load_that_dies_is_repeated_without_duplicates(spark, table, monkeypatch, step):
    load(spark, batch(spark, ("z", 0, 0.0)), table)
    whole = getattr(K, step)

    def dies(*args):
        if step == "_write_load":
            whole(*args)  # the rows are written, the ledger is not
        raise RuntimeError("executor lost")

    monkeypatch.setattr(K, step, dies)
    with pytest.raises(RuntimeError):
        load(spark, batch(spark, *ROWS), table)
    assert stored(spark, table[0]) == [("z", 0, 0.0)]
    monkeypatch.setattr(K, step, whole)
    assert load(spark, batch(spark, *ROWS), table) == 3
    assert stored(spark, table[0]) == [*sorted(ROWS), ("z", 0, 0.0)]


def test_a_failure_after_the_ledger_entry_appends_nothing(spark, table, monkeypatch):
    whole = K._complete_load

    def dies(*args):
        whole(*args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(K, "_complete_load", dies)
    with pytest.raises(RuntimeError):
        load(spark, batch(spark, *ROWS), table)
    monkeypatch.setattr(K, "_complete_load", whole)
    assert load(spark, batch(spark, *ROWS), table) == 0
    assert stored(spark, table[0]) == sorted(ROWS)


def test_two_writers_of_one_batch_count_once(spark, table, monkeypatch):
    load(spark, batch(spark, ("z", 0, 0.0)), table)
    df, whole = batch(spark, *ROWS), K._write_load

    def with_another_writer(rows, name):
        monkeypatch.setattr(K, "_write_load", whole)
        assert load(spark, df, table) == 3  # the other one is done first
        whole(rows, name)

    monkeypatch.setattr(K, "_write_load", with_another_writer)
    assert load(spark, df, table) == 3
    assert stored(spark, table[0]) == [*sorted(ROWS), ("z", 0, 0.0)]


def test_keys_and_repeated_rows(spark, table):
    load(spark, batch(spark, *ROWS), table)
    assert load(spark, batch(spark, ("a", 9, 9.0), ("d", 4, 4.0), ("d", 3, 4.0), (None, 5, 5.0)), table) == 1
    assert stored(spark, table[0]) == sorted([*ROWS, ("d", 3, 4.0)])


def test_without_keys_every_row_is_appended(spark, table):
    twice = batch(spark, ROWS[0], ROWS[0])
    assert load(spark, twice, table, keys=None) == 2
    assert load(spark, twice, table, keys=None) == 0
    assert load(spark, batch(spark, ROWS[0]), table, keys=None) == 1  # another batch
    assert len(stored(spark, table[0])) == 3


def test_empty_batches_and_missing_columns(spark, table):
    assert load(spark, batch(spark), table) == 0
    assert stored(spark, table[0]) == []
    assert load(spark, spark.createDataFrame([("q", "7")], "id string, n string"), table) == 1
    assert stored(spark, table[0]) == [("q", 7, None)]


def test_fingerprints_tell_batches_apart(spark):
    kinds = [ROWS, ROWS[:2], (*ROWS, ROWS[0]), (("a", None, 1.0),), (("a", 1, None),), ((None, 1, 1.0),), (("", 1, 1.0),)]
    assert len({K.batch_fingerprint(batch(spark, *k)) for k in kinds}) == len(kinds)
    assert K.batch_fingerprint(batch(spark, ("a", 1, 0.0))) == K.batch_fingerprint(batch(spark, ("a", 1, -0.0)))


# K3 on all columns ----------------------------------------------------------------
def exists(spark, incoming, target, **options):
    r = K.data_exists(batch(spark, *incoming), batch(spark, *target), keys=None, **options).first()
    return r["data_exists"], r["matched_rows"]


def test_all_columns_are_compared_as_sql_does(spark):
    assert exists(spark, [("a", 1, 0.0), ("b", 2, None), ("c", 3, 3.0)], [("a", 1, -0.0), ("b", 2, None)]) == (True, 1)
    assert exists(spark, [("a", 1, 0.0), ("b", 2, None), ("c", 3, 3.0)], [("a", 1, -0.0), ("b", 2, None)], null_safe=True) == (True, 2)
    assert exists(spark, [("a", None, 1.0)], [(None, 1, 1.0)], null_safe=True) == (False, 0)
    assert exists(spark, [("a", 1, 1.0)] * 3, [("a", 1, 1.0)] * 2) == (True, 3)
    assert exists(spark, [], [("a", 1, 1.0)]) == (False, 0)


def test_columns_of_other_types_are_still_compared(spark):
    incoming = spark.createDataFrame([("a", 1, "2.0"), ("b", 1, "x")], "id string, n long, x string").filter("id = 'a'")
    assert K.data_exists(incoming, batch(spark, ("a", 1, 2.0)), keys=None).first()["matched_rows"] == 1


@pytest.mark.parametrize("most", [0, 2, 100])
def test_digests_are_shuffled_and_not_rows(spark, monkeypatch, most):
    monkeypatch.setattr(K, "COMMON_DIGESTS", most)
    joined, plans = K._same_digest, []
    monkeypatch.setattr(K, "_same_digest", lambda *a: plans.append(joined(*a)) or plans[-1])
    assert exists(spark, ROWS[:1] + ROWS[2:], ROWS) == (True, 2)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plans[0][0]._jdf.queryExecution().sparkPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (most >= 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_digest_sees_nulls_and_order(spark):
    from ledgerlint.functions.digest import digest

    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), ("aa", ""), ("", "aa"), (None, None)], "p string, q string")
    assert df.select(F.struct(*digest(df, ["p", "q"]))).distinct().count() == 6
