"""Text expressions: trimming, canonical forms. All are JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 25 white-space code points.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def trim_to_null(c: Column | str) -> Column:
    """F1/F8: strip the 25 white-space characters from both ends; an empty rest becomes null."""
    return F.nullif(F.btrim(_col(c), F.lit(WHITE_SPACE)), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True where the text is null or holds nothing but white space (never null)."""
    return trim_to_null(c).isNull()


def letters_and_digits(c: Column | str) -> Column:
    """Lower case without anything but Unicode letters and digits; null stays null."""
    return F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]+", "")


def or_empty(c: Column | str) -> Column:
    """null becomes the empty text."""
    return F.coalesce(_col(c), F.lit(""))


def last_segment(c: Column | str, separator: str = "/") -> Column:
    """F16: the part after the last separator; the whole text if there is none."""
    return F.substring_index(_col(c), separator, -1)


def reduce_descriptions(c: Column | str) -> Column:
    """trim each element, drop empty ones, wrap each as ``[d:...]`` and join by commas; null if none is left.

    Order and repeats are kept; a null list gives null.
    """
    kept = F.filter(F.transform(_col(c), trim_to_null), lambda x: x.isNotNull())
    return F.nullif(F.array_join(F.transform(kept, lambda x: F.concat(F.lit("[d:"), x, F.lit("]"))), ","), F.lit(""))


def format_hash_source(name: Column, description: Column, quantity_text: Column, text: Column) -> Column:
    """the four fields joined by U+0000, a null field standing as U+0001."""
    absent = F.lit("\u0001")
    return F.concat_ws("\u0000", *[F.coalesce(x, absent) for x in (name, description, quantity_text, text)])


def entity_name(c: Column | str) -> Column:
    """F17 for one value: trimmed, lower case, one trailing ``s`` removed."""
    return F.regexp_replace(F.lower(F.btrim(_col(c), F.lit(WHITE_SPACE))), "s$", "")


def entity_names(c: Column | str) -> Column:
    """normalise every entity of a list and drop repeats, first places kept."""
    return F.array_distinct(F.transform(_col(c), entity_name))
