"""C4: rebuild ``full_name`` from its tokens using first/last-name dictionaries.

Rule: punctuation becomes a space and the name is split on whitespace.
Tokens are read left to right.  A token whose lower form is a known first name
(and not a placeholder word) replaces the first name; otherwise a known last
name replaces the last name, dropping any suffix collected so far; otherwise
``jr``/``sr`` is appended to the last name.  Result: ``first + " " + last``
stripped, empty -> null.

Spark form, with no driver collect and no UDF:

1. ``posexplode`` the tokens of every row (row key, position, token).
2. Left-join the token's lower form to a role table built from the two
   dictionaries.  The role table has one row per distinct name; AQE turns this
   join into a broadcast join when the measured dictionary is small and keeps
   a shuffle join (with skew splitting) when it is not.
3. One ``groupBy(row key)``: the last first-name token, the last last-name
   token and its position, and the suffix tokens; the suffixes after the last
   last-name token are concatenated in order.
4. Left-join the result back on the row key (or on the name, if there is no key).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lookups import EXCLUDE_FIRST, EXCLUDE_LAST, NAME_SUFFIXES
from ..functions.text import NOT_WORD_OR_WS_RE, split_words, strip
from .relational import name_dictionary


def name_roles(first_dict: DataFrame, last_dict: DataFrame) -> DataFrame:
    """(token, role) with role 'F' (first) taking precedence over 'L' (last).

    Both inputs have a single ``name`` column of lower-cased names.
    """
    # integer codes (1 = first, 2 = last) keep the aggregate hash-based
    f = first_dict.filter(~F.col("name").isin(EXCLUDE_FIRST)).select(F.col("name").alias("token"), F.lit(1).alias("code"))
    l_ = last_dict.filter(~F.col("name").isin(EXCLUDE_LAST)).select(F.col("name").alias("token"), F.lit(2).alias("code"))
    best = f.unionByName(l_).groupBy("token").agg(F.min("code").alias("code"))
    return best.select("token", F.when(F.col("code") == 1, "F").otherwise("L").alias("role"))


def rebuild_full_name(
    df: DataFrame,
    first_dict: DataFrame,
    last_dict: DataFrame,
    keys: str | Sequence[str] | None = None,
    column: str = "full_name",
) -> DataFrame:
    """Replace ``column`` of ``df`` by the rebuilt name.

    ``keys`` name columns that are unique per row and not null (one that is
    not unique raises when evaluated): if ``df`` is already partitioned by them,
    its rows are not shuffled again.  Without keys the name itself is the key,
    as the result depends on nothing else.

    The token join has a key more than the role table's aggregate; it then
    shuffles both sides by itself, and adaptive execution can split the rows
    of a very frequent token.
    """
    by = [column] if keys is None else [keys] if isinstance(keys, str) else list(keys)
    own = [f"_k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(k).alias(o) for k, o in zip(by, own)], F.col(column).alias("_name"))
    if keys is None:
        rows = rows.distinct()
    words = split_words(F.regexp_replace("_name", NOT_WORD_OR_WS_RE, " "))
    tokens = rows.select(*own, F.posexplode(words).alias("pos", "tok")).withColumn("low", F.lower("tok"))
    roles = name_roles(first_dict, last_dict)
    same = (tokens["low"] == roles["token"]) & (F.crc32(tokens["low"].cast("binary")) == F.crc32(roles["token"].cast("binary")))
    tagged = tokens.join(roles, same, "left").select(
        *own,
        "pos",
        "tok",
        F.when(F.col("role").isNotNull(), F.col("role")).when(F.col("low").isin(NAME_SUFFIXES), F.lit("S")).alias("role"),
    )
    pos_tok = F.struct("pos", "tok")
    parts = tagged.groupBy(*own).agg(
        F.max(F.when(F.col("role") == "F", pos_tok)).alias("f"),
        F.max(F.when(F.col("role") == "L", pos_tok)).alias("l"),
        F.collect_list(F.when(F.col("role") == "S", pos_tok)).alias("s"),
        # Positions of one row are 0, 1, ...: more tokens than that come from several rows.
        (F.count("pos") > F.max("pos") + 1).alias("twice"),
    )
    last_pos = F.coalesce(F.col("l.pos"), F.lit(-1))
    sfx = F.array_sort(F.filter(F.col("s"), lambda x: x["pos"] > last_pos))
    last = F.concat(
        F.coalesce(F.col("l.tok"), F.lit("")),
        F.array_join(F.transform(sfx, lambda x: F.concat(F.lit(" "), x["tok"])), ""),
    )
    full = strip(F.concat(F.coalesce(F.col("f.tok"), F.lit("")), F.lit(" "), last))
    checked = F.when(F.col("twice"), F.raise_error(F.lit(f"{by} is not unique per row")).cast("string")).otherwise(F.nullif(full, F.lit("")))
    names = parts.select(*own, checked.alias("_full"))
    out = df.join(names, reduce(lambda a, b: a & b, [df[k] == names[o] for k, o in zip(by, own)]), "left")
    return out.select(*[F.col("_full").alias(column) if c == column else df[c] for c in df.columns])


def full_name_from_dedup(df: DataFrame, dedup: DataFrame, keys: str | Sequence[str] | None = None) -> DataFrame:
    """C4 with the dictionaries (R14) of the deduplicated frame, as the job does."""
    return rebuild_full_name(df, name_dictionary(dedup, "first_name"), name_dictionary(dedup, "last_name"), keys)
