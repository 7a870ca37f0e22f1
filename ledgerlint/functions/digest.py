"""128-bit digests of rows and values: fixed width, order of rows irrelevant, nulls told apart from values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """A column by its exact name, also one that holds a dot or a backtick."""
    return F.col("`" + name.replace("`", "``") + "`")


def comparable(df: DataFrame, name: str) -> Column:
    """A column's value such that equal values hash alike: 0.0 and -0.0 are equal; maps count as their text."""
    x, kind = named(name), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x)
    return x.cast("string") if "map<" in kind.simpleString() else x


def digest(df: DataFrame, names: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the listed columns, from different starting points.

    ``xxhash64`` leaves out nulls, so each column goes in with a flag: (null, 'a') and ('a', null) differ.
    """
    cells = [x for c in names for x in (named(c).isNull(), comparable(df, c))]
    return F.xxhash64(F.lit(1), *cells), F.xxhash64(F.lit("second"), *reversed(cells))
