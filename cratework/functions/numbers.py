"""Quantities and progress metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cratework.functions.text import let, trim_to_null

MAX_INT = 2147483647


def quantity(c: Column | str) -> Column:
    """struct (quantity INT, quantity_text STRING, valid) of a decimal quantity of any length.

    Trimmed; blank gives nulls and is valid. Otherwise only ASCII digits are valid; leading zeros go (one zero
    stays), and the integer is null where it exceeds 2147483647 while the text keeps all digits.
    """

    def parts(t: Column) -> Column:
        ok = F.translate(t, "0123456789", "") == ""
        return let(F.when(ok, F.ltrim(t, F.lit("0"))), lambda bare: fields(t, bare))

    def fields(t: Column, bare: Column) -> Column:
        text = F.when(bare == "", "0").otherwise(bare)
        number = F.when(F.length(bare) <= 10, text.try_cast("long"))
        return F.struct(
            F.when(number <= MAX_INT, number.cast("int")).alias("quantity"), text.alias("quantity_text"), (t.isNull() | bare.isNotNull()).alias("valid")
        )

    return let(trim_to_null(c), parts)


def quantity_consistent(number: Column, text: Column) -> Column:
    """whether a stored pair is canonical: no negative number, number and text agree, no number beside an
    oversized text. A pair of nulls is; a number without a text isn't."""
    same = lambda q: q["valid"] & text.eqNullSafe(q["quantity_text"]) & number.eqNullSafe(q["quantity"])
    return F.coalesce(let(quantity(text), same), F.lit(False))


def round_metric(c: Column) -> Column:
    """two decimals, half away from zero, of the binary product (not of the decimal text)."""
    scaled = c * F.lit(100.0)
    return F.signum(scaled) * F.floor(F.abs(scaled) + F.lit(0.5)) / F.lit(100.0)


def percent_done(done: Column, total: Column) -> Column:
    """done * 100 / total, 100 where the total is 0."""
    return F.when(total == 0, F.lit(100.0)).otherwise(done * F.lit(100.0) / F.nullif(total, F.lit(0)))


def rate(items: Column, initial: Column, elapsed: Column) -> Column:
    """(items - initial) / elapsed, 0 where no time has passed."""
    return F.when(elapsed > 0, (items - initial) / F.when(elapsed > 0, elapsed)).otherwise(F.lit(0.0))


def clamp_progress(c: Column, total: Column, partition: list, order: list) -> Column:
    """progress that never falls and never exceeds the total, in the order given."""
    return F.least(F.max(c).over(W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)), total)
