"""Partial dates and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cratework.functions.text import let

_THREE_PARTS = r"^([0-9]+)[-_. ]([0-9]+)[-_. ]([0-9]+)\z"


def _iso(y: Column, m: Column, d: Column) -> Column:
    """The DATE of three integers, null if they make none."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")


def _real(y: Column, m: Column, d: Column) -> Column:
    return _iso(y, m, d).isNotNull()


def parse_partial_date(c: Column | str) -> Column:
    """struct (year, month, day), each nullable, from dates of uneven completeness; all null if none fits.

    Three numbers parted by one of ``-_. `` (on the untrimmed text) and padded to two digits: the year always
    counts, ``00`` for month or day means unknown and a day needs a month. Otherwise all but digits is removed, a
    five-digit rest is year and one-digit month, and the layouts yyyyMMdd, yyyyMM, yyMMdd, yyyy, yy are tried in
    this order, the first that makes a real date winning. Two-digit years from 69 on are of the 20th century.
    """
    c = F.col(c) if isinstance(c, str) else c
    return let(_digits(c), _by_length)


def _digits(c: Column) -> Column:
    """The digits of the date, padded; one regular expression sees the text."""

    def three(p: Column) -> Column:
        two = lambda x: F.when(F.length(x) == 1, F.concat(F.lit("0"), x)).otherwise(x)
        y, m, d = p[0], two(p[1]), two(p[2])
        return F.concat(y, F.when(m != "00", m).otherwise(""), F.when((m != "00") & (d != "00"), d).otherwise(""))

    # A three-part date becomes its parts with commas, which can't be in one; anything else stays as it is.
    parts = F.split(F.regexp_replace(c, _THREE_PARTS, ",$1,$2,$3,"), ",")
    is_three = lambda p: (F.size(p) == 5) & (p[0] == "") & (p[4] == "") & (F.length(p[1]) > 0)
    plain = lambda p: F.regexp_replace(F.array_join(p, ","), "[^0-9]", "")
    raw = let(parts, lambda p: F.when(is_three(p) & ~F.startswith(c, F.lit(",")), three(F.slice(p, 2, 3))).otherwise(plain(p)))
    return let(raw, lambda x: F.when(F.length(x) == 5, F.concat(F.substr(x, F.lit(1), F.lit(4)), F.lit("0"), F.substr(x, F.lit(5), F.lit(1)))).otherwise(x))


def _by_length(digits: Column) -> Column:
    n = F.length(digits)
    cut = lambda a, k: F.substr(digits, F.lit(a), F.lit(k)).try_cast("int")
    full = lambda yy: F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)
    none = F.lit(None).cast("int")
    date = lambda yy, mm, dd: F.struct(yy.alias("year"), mm.alias("month"), dd.alias("day"))
    return (
        F.when((n == 8) & _real(cut(1, 4), cut(5, 2), cut(7, 2)), date(cut(1, 4), cut(5, 2), cut(7, 2)))
        .when((n == 6) & cut(5, 2).between(1, 12), date(cut(1, 4), cut(5, 2), none))
        .when((n == 6) & _real(full(cut(1, 2)), cut(3, 2), cut(5, 2)), date(full(cut(1, 2)), cut(3, 2), cut(5, 2)))
        .when(n == 4, date(cut(1, 4), none, none))
        .when(n == 2, date(full(cut(1, 2)), none, none))
        .otherwise(date(none, none, none))
    )


def release_date(parsed: Column) -> Column:
    """the DATE of a parsed partial date, month and day taken as 1 where unknown; null without a year."""
    build = lambda p: F.when(p["year"].isNotNull(), _iso(p["year"], F.coalesce(p["month"], F.lit(1)), F.coalesce(p["day"], F.lit(1))))
    return let(parsed, build)


def first_of_next_month(c: Column | str) -> Column:
    """the first day of the month after a date: the exclusive horizon of its month."""
    return F.add_months(F.trunc(c, "MM"), 1)


def in_month(c: Column | str, first: Column) -> Column:
    """P5: half-open month range, first <= c < first of the next month."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= first) & (c < first_of_next_month(first))
