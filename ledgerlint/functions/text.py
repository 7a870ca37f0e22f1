"""Text helpers that give Python ``str`` semantics with JVM-side expressions.

Spark's ``trim`` removes only the space character and Java's ``\\s``/``\\w``
are ASCII by default, whereas the cleaning rules we reproduce were specified
with Python's ``str.strip()``, ``str.split()``, ``str.title()`` and the
Unicode-aware ``re`` classes.  The character classes below spell out the
Python definitions explicitly so that Java regex (Spark) and RE2 (DuckDB,
used as the test oracle) agree with them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python whitespace (str.isspace / re "\s" on str): ASCII controls, the
# information separators 0x1C-0x1F, NEL and every Unicode separator (Z*).
WS = r"\t\n\x0B\f\r\x1C-\x1F\p{Z}\x{85}"
# Python "\w" on str: letters, numbers and underscore.
WORD = r"\p{L}\p{N}_"
# Python "\d" on str: decimal digits of any script.
DIGIT = r"\p{Nd}"
# Letters that have case; Python's title() starts a new word after anything else.
CASED = r"\p{Lu}\p{Ll}\p{Lt}"

# Python whitespace as plain characters, derived from Python's own
# definition (every whitespace code point lies below U+3001), for a
# character-set trim that needs no regex.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
WS_RUN_RE = f"[{WS}]+"
NOT_WORD_OR_WS_RE = f"[^{WORD}{WS}]"
NON_DIGIT_RE = f"[^{DIGIT}]"
CASE_RUNS_RE = f"[{CASED}]+|[^{CASED}]+"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.trim(col_of(c), F.lit(PY_WHITESPACE))


def digits_only(c: str | Column) -> Column:
    """Python ``re.sub(r"\\D", "", s)``."""
    return F.regexp_replace(col_of(c), NON_DIGIT_RE, "")


def split_words(c: str | Column) -> Column:
    """Python ``s.split()``: whitespace-separated tokens, no empty tokens."""
    return F.filter(F.split(strip(c), WS_RUN_RE), lambda t: t != "")


def title_case(c: str | Column) -> Column:
    """Python ``str.title()``.

    The string is cut into runs of cased letters and runs of everything else;
    ``initcap`` on a run of letters upper-cases its first letter and
    lower-cases the rest, which is exactly what ``title()`` does per word.
    A string of ASCII letters and spaces needs no cutting: its words are its runs.
    """
    c = col_of(c)
    runs = F.regexp_extract_all(c, F.lit(CASE_RUNS_RE), 0)
    return F.when(c.rlike(r"^[A-Za-z ]*\z"), F.initcap(c)).otherwise(F.array_join(F.transform(runs, lambda r: F.initcap(r)), ""))
