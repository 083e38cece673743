"""References to records that do not exist: anti-joins by null mask under declared match semantics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.operators.skew import fresh, salted_join
from cratework.session import settle

MATCHES = ("simple", "partial", "full")


def orphan_references(
    refs: DataFrame,
    targets: DataFrame,
    keys: Sequence[tuple[str, str]],
    match: str = "simple",
    required: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``refs`` whose composite key is in no row of ``targets``; all columns of ``refs`` are kept.

    ``keys`` are pairs (column of refs, column of targets). References are grouped by their null mask (which of
    the key columns are null) and each mask is anti-joined on its non-null columns only. What a mask with nulls
    means is declared by ``match``, as in SQL: ``simple`` - any null satisfies the constraint, so only complete
    keys are looked up; ``partial`` - the non-null columns must match some target row; ``full`` - all null is
    satisfied, a mixture is a broken reference by itself. An all-null key is never an orphan. Columns in
    ``required`` hold in every mask: rows with a null there are skipped.

    Each mask works on distinct keys first (combined map-side), both sides of the anti-join are unique by then,
    and only the orphan keys are joined back to the rows, hot keys (by the counts of the first step) salted; a key
    that holds a third of all references costs no more than others. Repeated reference rows stay repeated. Empty targets make every
    looked-up reference an orphan; empty refs give no rows.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    cols = [r for r, _ in keys]
    rows = refs
    for c in required:
        rows = rows.filter(F.col(c).isNotNull())
    renamed = targets.select(*[F.col(t).alias(r) for r, t in keys])
    parts = []
    for mask in product((False, True), repeat=len(cols)):
        if all(mask) or (any(mask) and match == "simple") or any(m and c in required for m, c in zip(mask, cols)):
            continue
        here = rows
        for null, c in zip(mask, cols):
            here = here.filter(F.col(c).isNull() if null else F.col(c).isNotNull())
        if any(mask) and match == "full":
            parts.append(here)
            continue
        on = [c for null, c in zip(mask, cols) if not null]
        n = fresh("n")
        wanted = here.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
        there = renamed.select(*on).dropna().distinct()
        missing = settle(wanted.join(there, on, "left_anti"))  # the orphan keys only, used three times
        parts.append(salted_join(here, missing.select(*on), on, "left_semi", counts=missing).select(*refs.columns))
    return reduce(DataFrame.unionByName, parts) if parts else rows.limit(0)


def orphan_report(orphans: DataFrame, groups: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Orphan references a group (say table and period): rows and distinct missing keys, combined map-side.

    Null groups count as one group; no orphans give no rows.
    """
    n = fresh("n")
    per_key = orphans.groupBy(*groups, *key).agg(F.count(F.lit(1)).alias(n))
    return per_key.groupBy(*groups).agg(
        F.sum(n).alias("orphan_rows"), F.count(F.lit(1)).alias("missing_keys")
    )
