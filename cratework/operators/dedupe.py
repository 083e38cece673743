"""Removing exact repeats and finding conflicting ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cratework.operators.skew import fresh
from cratework.session import settle


class ConflictError(ValueError):
    """Rows with the same key and different content."""


def distinct_in_order(df: DataFrame, columns: Sequence[str], position: str) -> DataFrame:
    """A1: distinct values of ``columns`` with the smallest ``position`` of each (nulls are equal to each other)."""
    return df.groupBy(*columns).agg(F.min(position).alias(position))


def _states(df: DataFrame, key: Sequence[str], payload: Sequence[str], first_by: str | None) -> DataFrame:
    """Per key the least and greatest payload, the number of rows and the row to keep: one aggregation, combined map-side."""
    content = F.struct(*[F.col(c) for c in payload]) if payload else F.struct(F.lit(1).alias("one"))
    rest = [c for c in df.columns if c not in key]
    kept = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(1).alias("one"))
    keep = F.min_by(kept, F.struct(F.col(first_by), F.xxhash64(*df.columns))) if first_by else F.min(kept)
    return df.groupBy(*key).agg(F.min(content).alias("__low"), F.max(content).alias("__high"), F.count(F.lit(1)).alias("__n"), keep.alias("__kept"))


def conflicts(df: DataFrame, key: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """A2/A5: key columns and n_rows of the keys whose rows differ in ``payload`` (nulls are equal to each other)."""
    states = _states(df.select(*dict.fromkeys([*key, *payload])), key, payload, None)
    return states.filter(~F.col("__low").eqNullSafe(F.col("__high"))).select(*key, F.col("__n").alias("n_rows"))


def keyed_dedupe(
    df: DataFrame, key: Sequence[str], payload: Sequence[str] | None = None, first_by: str | None = None, name: str = "rows", check: bool = True
) -> DataFrame:
    """A2: one row a key; rows of a key that differ in ``payload`` are an error that names the table and sample keys.

    ``payload`` defaults to all other columns; columns outside it may differ, the row with the least ``first_by``
    (else the least row) is kept. Null keys are equal to each other. With ``check`` off, a conflict raises inside
    the plan when the rows are read, which costs no pass of its own.
    """
    payload = [c for c in df.columns if c not in key] if payload is None else list(payload)
    states = _states(df, key, payload, first_by)
    clash = ~F.col("__low").eqNullSafe(F.col("__high"))
    if check:
        bad = states.filter(clash).select(*key).limit(5).collect()
        if bad:
            raise ConflictError(f"{name}: conflicting rows for {', '.join(key)}: {[tuple(r) for r in bad]}")
    else:
        message = F.concat(F.lit(f"{name}: conflicting rows for "), F.to_json(F.struct(*key)))
        states = states.filter(F.when(clash, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return states.select(*[F.col(c) if c in key else F.col("__kept")[c].alias(c) for c in df.columns])


def digest_dedupe(df: DataFrame, scope: Sequence[str], digest: str, legacy: str, payload: Sequence[str], name: str = "rows", check: bool = True) -> DataFrame:
    """A5: one row a (scope, digest); payload and legacy hash must agree, else ConflictError."""
    return keyed_dedupe(df, [*scope, digest], [*payload, legacy], name=name, check=check)


def newest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Group columns and ``keep`` of the row with the greatest ``order`` (nulls lowest), by one aggregation.

    The row is found by ``max_by``, combined map-side, not by a window: a group of any size is no single task.
    Ties in ``order`` are broken by the greatest kept row.
    """
    row = F.struct(*[F.col(c) for c in keep])
    best = F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], row.alias("row")))
    return df.groupBy(*group).agg(best["row"].alias("__row")).select(*group, *[F.col("__row")[c].alias(c) for c in keep])


def count_windows(df: DataFrame, position: str, size: int, measures: dict[str, Column] | None = None) -> DataFrame:
    """Windows of ``size`` consecutive positions: chunk_index, first_item_index, item_count and ``measures``."""
    chunk = F.floor(F.col(position) / size).cast("long").alias("chunk_index")
    extra = [c.alias(n) for n, c in (measures or {}).items()]
    rows = df.groupBy(chunk).agg(F.count(F.lit(1)).alias("item_count"), *extra)
    return rows.withColumn("first_item_index", F.col("chunk_index") * size)


def audit_duplicates(raw: DataFrame, kept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rows_in, rows_out and duplicates of a deduplication, by group if wanted."""
    tagged = raw.select(*by, F.lit(1).alias("__in"), F.lit(0).alias("__out")).unionAll(kept.select(*by, F.lit(0), F.lit(1)))
    counts = tagged.groupBy(*by).agg(F.sum("__in").alias("rows_in"), F.sum("__out").alias("rows_out"))
    return counts.withColumn("duplicates", F.col("rows_in") - F.col("rows_out"))


def not_increasing(df: DataFrame, position: str, value: str) -> DataFrame:
    """The rows whose ``value`` isn't greater than the one before them by ``position``.

    Rows are range-partitioned by position, as many ranges as there are shuffle partitions, which bounds both what one
    task sorts and the table of the ranges' last values that the first row of each range is held against. Positions are
    unique; nulls in ``value`` are never reported.
    """
    b, w = fresh("b"), W.partitionBy("__b").orderBy(position)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = settle(df.repartitionByRange(parts, F.col(position)).withColumn("__b", F.spark_partition_id()))
    ends = rows.groupBy("__b").agg(F.max_by(value, position).alias("__last"))
    ahead = ends.select(F.col("__b").alias(b), F.lag("__last").over(W.orderBy("__b")).alias("__ahead"))  # a row a range
    inner = rows.withColumn("__prev", F.lag(value).over(w)).withColumn("__head", F.row_number().over(w) == 1)
    joined = inner.join(F.broadcast(ahead), F.col("__b") == F.col(b), "left")
    previous = F.when(F.col("__head"), F.col("__ahead")).otherwise(F.col("__prev"))
    return joined.withColumn("previous", previous).filter(F.col("previous") >= F.col(value)).drop("__b", b, "__prev", "__head", "__ahead")


def union_counts(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """table_name and n_rows of several frames."""
    return reduce(DataFrame.unionAll, [df.select(F.lit(n).alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows")) for n, df in parts])
