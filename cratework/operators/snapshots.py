"""What changed between consecutive full snapshots, in a single aggregation shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SNAPSHOTS = 10_000


def snapshot_dates(df: DataFrame, period: str) -> list:
    """The delivered periods in order (nulls are no snapshot). A table of more than MAX_SNAPSHOTS is refused."""
    rows = df.select(period).filter(F.col(period).isNotNull()).distinct().limit(MAX_SNAPSHOTS + 1).collect()
    if len(rows) > MAX_SNAPSHOTS:
        raise ValueError(f"more than {MAX_SNAPSHOTS} snapshots in {period}")
    return sorted(r[0] for r in rows)


def snapshot_changes(
    df: DataFrame, period: str, key: Sequence[str], compare: Sequence[Column], unchanged: bool = False
) -> DataFrame:
    """period (the later of two neighbouring snapshots), key columns, change_kind: added, removed or changed.

    Every row is tagged as the later side of its own snapshot and as the earlier side of the next one; rows are
    hashed over ``compare`` (null differs from any value) and the two sides of a key meet in one aggregation,
    combined map-side. A snapshot's rows of one key are compared as the set of their distinct
    hashes, so repeated rows don't matter and conflicting versions count as changed whenever any version comes or goes. Keys with nulls are keys like others. The first snapshot gives no rows, nor does a
    table with fewer than two snapshots. ``unchanged`` also returns the keys that stayed the same.
    """
    dates = snapshot_dates(df, period)
    kind = df.schema[period].dataType
    following = [(a, b) for a, b in zip(dates, dates[1:])]
    if not following:
        empty = df.select(F.col(period), *key, F.lit("").alias("change_kind"))
        return empty.filter(F.lit(False))
    pairs = [F.lit(x).cast(kind) for pair in following for x in pair]
    next_of = F.element_at(F.create_map(*pairs), F.col(period))
    later, version = F.lit(True), F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in compare], *[c.isNull() for c in compare])
    sides = F.array(
        F.struct(F.when(F.col(period) > F.lit(dates[0]).cast(kind), F.col(period)).alias("at"), later.alias("later")),
        F.struct(next_of.alias("at"), F.lit(False).alias("later")),
    )
    tagged = df.filter(F.col(period).isNotNull()).select(
        *key, version.alias("__v"), F.explode(F.filter(sides, lambda x: x["at"].isNotNull())).alias("__side")
    )
    new, old = F.when(F.col("__side.later"), F.col("__v")), F.when(~F.col("__side.later"), F.col("__v"))
    both = tagged.groupBy(F.col("__side.at").alias(period), *key).agg(
        F.sort_array(F.collect_set(new)).alias("__n"), F.sort_array(F.collect_set(old)).alias("__o")
    )
    change = (
        F.when(F.size("__o") == 0, "added")
        .when(F.size("__n") == 0, "removed")
        .when(F.col("__n") != F.col("__o"), "changed")
        .otherwise("unchanged")
    )
    out = both.select(period, *key, change.alias("change_kind"))
    return out if unchanged else out.filter(F.col("change_kind") != "unchanged")
