"""S1 by header: columns are found by name in every file's own header."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import types as T

from ledgerlint.sources.raw import csv_headers, read_csv_by_header, read_raw_csv

SCHEMA = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("first_name", T.StringType()), T.StructField("age", T.IntegerType())])


def files(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_permuted_missing_and_unknown_columns(spark, tmp_path):
    path = files(
        tmp_path,
        a="first_name,customer_id,age\nAnn,ID-1,30\n",
        b="customer_id,unknown,unknown\nID-2,x,y\n",
        c="﻿AGE , Customer_ID\n41,ID-3\n",
    )
    assert rows(read_csv_by_header(spark, path, SCHEMA)) == [("ID-1", "Ann", 30, None), ("ID-2", None, None, None), ("ID-3", None, 41, None)]


def test_one_scan_for_each_layout(spark, tmp_path):
    path = files(tmp_path, **{f"x{i}": f"customer_id,age\nID-{i},{i}\n" for i in range(6)}, y="age,customer_id\n9,ID-9\n")
    layouts = csv_headers(spark, path)
    assert sorted(len(f) for f in layouts.values()) == [1, 6]
    df = read_csv_by_header(spark, path, SCHEMA)
    assert df.count() == 7 and df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_broken_records_are_kept_with_their_text(spark, tmp_path):
    path = files(tmp_path, a='customer_id,first_name,age\nID-1,Ann,30\nID-2,Bob\nID-3,Cy,4,5\nID-4,"a, b",oops\n')
    df = read_csv_by_header(spark, path, SCHEMA)
    assert [r[0] for r in rows(df.filter("broken_record is not null").select("broken_record"))] == ["ID-2,Bob", "ID-3,Cy,4,5"]
    assert rows(df.filter("broken_record is null").drop("broken_record")) == [("ID-1", "Ann", 30), ("ID-4", "a, b", None)]
    assert read_csv_by_header(spark, path, SCHEMA, broken=None).columns == ["customer_id", "first_name", "age"]


def test_separator_and_compressed_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("age;customer_id\n5;'ID;1'\n")
    assert rows(read_csv_by_header(spark, str(tmp_path), SCHEMA, separator=";", quote="'")) == [("ID;1", None, 5, None)]


def test_empty_files_and_headers_alone(spark, tmp_path):
    path = files(tmp_path, a="", b="customer_id,age\n", c="\n\n")
    df = read_csv_by_header(spark, path, SCHEMA)
    assert df.count() == 0 and df.columns == ["customer_id", "first_name", "age", "broken_record"]
    empty = tmp_path / "none"
    empty.mkdir()
    assert read_csv_by_header(spark, files(empty, a=""), SCHEMA).count() == 0


def test_unusable_headers_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="none of the wanted"):
        read_csv_by_header(spark, files(tmp_path, a="x,y\n1,2\n"), SCHEMA)
    with pytest.raises(ValueError, match="age more than once"):
        read_csv_by_header(spark, files(tmp_path, a="customer_id,age,AGE\n1,2,3\n"), SCHEMA)


def test_reading_by_position_raises_instead_of_swapping(spark, tmp_path):
    path = files(tmp_path, a="first_name,customer_id,age\nAnn,ID-1,30\n")
    with pytest.raises(Exception, match="does not conform"):
        read_raw_csv(spark, path, schema=SCHEMA).collect()
