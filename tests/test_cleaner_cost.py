"""The cheap forms of the date, age, boolean and title cleaners give the results of the plain ones (F4)."""

from __future__ import annotations

import itertools

from ledgerlint import clean_all
from ledgerlint.functions import columns as C
from ledgerlint.functions.dates import parse_date
from ledgerlint.functions.lookups import DATE_FORMATS, TWO_DIGIT_YEAR_PIVOT
from ledgerlint.functions.text import strip, title_case
from ledgerlint.schema import RAW_SCHEMA
from pyspark.sql import functions as F

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _plain_date(c):
    """Every layout's pattern parser behind its regex."""
    s, found = strip(c), []
    for gate, py_fmt, fmt in DATE_FORMATS:
        d = F.to_date(F.try_to_timestamp(s, F.lit(fmt)))
        if "%y" in py_fmt:
            d = F.when(F.year(d) >= 2000 + TWO_DIGIT_YEAR_PIVOT, F.add_months(d, -1200)).otherwise(d)
        found.append(F.when(s.rlike(gate), d))
    d = F.coalesce(*found)
    return F.when(F.year(d) >= 1, d)


def _dates():
    years, months, days = ["0000", "0001", "1900", "1999", "2000", "2023", "9999"], ["00", "01", "02", "12", "13"], ["00", "01", "28", "29", "30", "31", "32"]
    for y, m, d in itertools.product(years, months, days):
        yield from (f"{y}-{m}-{d}", f"{y}/{m}/{d}", f"{m}/{d}/{y}", f"{m}/{d}/{y} 10:30", f"{y}/{m}/{d} 23:59", f"{y}{m}{d}103059")
    for t in ["00:00", "24:00", "23:60", "09:5", "99:99"]:
        yield from (f"02/03/2020 {t}", f"2020/02/03 {t}", "20200203" + t.replace(":", "") + "59", "20200203" + t.replace(":", "") + "60")
    for m in ["Jan", "feb", "MAR", "Apr", "may", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec", "Foo", "Sept", "January", "february", "May", "December"]:
        for d in ["0", "5", "05", "29", "30", "31", "32"]:
            yield from (f"{d}-{m}-{y}" for y in ["00", "01", "68", "69", "96", "99", "1996", "0000", "2023"])
            yield from (f"{m}-{d}-2023", f"{m} {d} 2024", f"{d} {m} 2024", f"{m} {d}, 2024", f"{m} {d}, 0000")
    yield from (*years, "", " ", None, "20-0-01-01", "2020-0101-", "\u0662\u0660\u0662\u0660", "2020-01-01\n", "\u30002020/01/02\x85", "2020-01-01 x", "x2020-01-01", "20/20-01-01")


def test_dates_equal_the_pattern_parsers(spark):
    df = spark.createDataFrame([(t,) for t in _dates()], "t string").select("t", parse_date("t").alias("cheap"), _plain_date("t").alias("plain"))
    rows = df.collect()
    assert [r for r in rows if r["cheap"] != r["plain"]] == []
    assert len({r["cheap"] for r in rows}) > 100


def test_only_full_month_names_run_a_pattern_parser():
    assert str(parse_date("t")._jc).count("try_to_timestamp") <= 2


def test_age_equals_the_range_of_the_cast(spark):
    texts = ["0", "-0", "+0", "-00", "120", "121", "0120", "000000000000007", "+17", " 17 ", "\x0017\x7f", "17\u3000", "42.0", "4 2", "-3", "", "+", "-", "1e1", "99999999999", "\u0664\u0662", "119", "100", "200", "1\n", None]
    texts += [str(i) for i in range(-3, 130)]
    a = strip("t").try_cast("int")
    no_dob = F.lit(None).cast("date")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.clean_age("t", no_dob).alias("cheap"), F.when(a.between(0, 120), a).alias("plain")).collect()
    assert [r for r in rows if r["cheap"] != r["plain"]] == []


def test_boolean_equals_the_cast(spark):
    words = ["t", "true", "y", "yes", "1", "f", "false", "n", "no", "0"]
    texts = [x for w in words for x in (w, w.upper(), w.title(), f" {w}\t", f"\x00{w}\x7f\n", f"{w}\u00a0", f"\u3000{w}", f"{w}{w}", f"{w}.")] + ["", " ", "maybe", "2", "on", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.cast_bool("t").alias("cheap"), F.col("t").try_cast("boolean").alias("plain")).collect()
    assert [r for r in rows if r["cheap"] != r["plain"]] == []


def test_title_equals_python(spark):
    texts = ["", " ", "ab CD", "  two  gaps ", "3m co", "o'neil-smith", "\u00e9cole acme", "a\tb", "a\n", "x_y z", "UPPER"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", title_case("t").alias("x")).collect()
    assert {r["t"]: r["x"] for r in rows} == {t: t.title() for t in texts} | {None: None}


def test_clean_all_keeps_generated_methods_compilable(spark):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        clean_all(spark.createDataFrame([], RAW_SCHEMA))
        assert spark.conf.get(LIMIT) == "8000"
        spark.conf.set(LIMIT, "4000")
        clean_all(spark.createDataFrame([], RAW_SCHEMA))
        assert spark.conf.get(LIMIT) == "4000"
    finally:
        spark.conf.set(LIMIT, before)
