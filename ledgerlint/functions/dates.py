"""C5: free-form date text -> DateType, as one JVM-side expression.

The layouts are mutually exclusive, so the first one that fits decides.  A
layout of fixed length is told by the length and one separator before its
regex confirms it: of the 13 regexes, a text then runs one or two.  Its
numbers stand at fixed places and are cut out there and checked as text, so
neither a pattern parser nor (for most invalid dates) an exception runs per
row.  The two layouts with full month names are parsed with
``try_to_timestamp``.  Two rules of strptime are kept:

* two-digit years: 69-99 belong to the 1900s;
* year 0000 is rejected (Spark accepts it).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lookups import DATE_FORMATS, MONTHS, TWO_DIGIT_YEAR_PIVOT
from .text import col_of, strip


def _is_fixed(fmt: str) -> bool:
    """Whether every text of the layout is as long as its pattern."""
    return "MMMM" not in fmt


def _fits(s: Column, gate: str, fmt: str) -> Column:
    if not _is_fixed(fmt):  # the year stands last
        return s.rlike(gate) & ~s.endswith("0000")
    separators = [F.substring(s, i + 1, 1) == ch for i, ch in enumerate(fmt) if not ch.isalpha()]
    return reduce(lambda a, b: a & b, [F.length(s) == len(fmt), *separators[:1], s.rlike(gate)])


def _cut(s: Column, fmt: str) -> Column:
    """The date of a text of a fixed layout; null if there is no such day or time."""

    def part(letter: str) -> Column:
        return F.substring(s, fmt.index(letter) + 1, fmt.count(letter))

    year = part("y")
    if fmt.count("y") == 2:
        year = F.concat(F.when(year >= f"{TWO_DIGIT_YEAR_PIVOT:02}", "19").otherwise("20"), year)
    month = F.lit("01")
    if "MMM" in fmt:
        names = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, f"{i + 1:02}")])
        month = F.try_element_at(names, F.lower(part("M")))
    elif "M" in fmt:
        month = part("M")
    day = part("d") if "d" in fmt else F.lit("01")
    # Two digits each: text order is number order.
    ok = [year != "0000"] + ([month.between("01", "12")] if "MM" in fmt else [])
    ok += [part(x).between(low, high) for x, low, high in (("d", "01", "31"), ("H", "00", "23"), ("m", "00", "59"), ("s", "00", "59")) if x in fmt]
    d = F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")
    return F.when(reduce(lambda a, b: a & b, ok), d)


def parse_date(c: str | Column) -> Column:
    s = strip(col_of(c))
    d = F
    for gate, _, fmt in DATE_FORMATS:
        d = d.when(_fits(s, gate, fmt), _cut(s, fmt) if _is_fixed(fmt) else F.to_date(F.try_to_timestamp(s, F.lit(fmt))))
    return d


def age_on(dob: Column, as_of: Column) -> Column:
    """Whole years between ``dob`` and ``as_of`` (birthday not yet reached -> one less)."""

    def month_day(d: Column) -> Column:
        return F.month(d) * 100 + F.dayofmonth(d)

    return F.year(as_of) - F.year(dob) - F.when(month_day(as_of) < month_day(dob), 1).otherwise(0)
