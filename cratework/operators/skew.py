"""Joins and running sums that hold when one key, source or group has a third of all rows.

Every plan here keeps a hot key from landing in one task: hot keys are found by a counted pass (of which there
can be at most four times the shuffle partitions, a proven bound for the broadcast), rows of a hot key are spread over
as many salts as the key's size asks for, and running sums go through bounded sub-buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_PARTS = 4


def fresh(stem: str) -> str:
    """A column name that can't clash with a caller's."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


def hot_share(spark: SparkSession) -> float:
    """A key is hot from a quarter of an even partition's rows on: one in 4 * partitions of all rows."""
    return 1.0 / (HOT_PARTS * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _hot(counts: DataFrame, keys: Sequence[str], n: str, share: float | None, salts: str) -> DataFrame:
    share = share or hot_share(counts.sparkSession)
    part = F.lit(share) * counts.select(F.sum(n)).scalar()
    hot = counts.filter(F.col(n) > part).dropna(subset=list(keys))
    return hot.select(*keys, F.ceil(F.col(n) / part).cast("int").alias(salts))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float | None = None) -> DataFrame:
    """The keys that hold more than ``share`` of the rows: at most ``1 / share`` rows, whatever the input.

    ``share`` defaults to one in four times the shuffle partitions, so that it follows the size of the cluster. Keys
    with a null in any column are no keys. An empty table gives no rows. Counts are combined map-side, so a hot key
    sends one partial count a task.
    """
    n = fresh("n")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    return _hot(counts, keys, n, share, fresh("salts")).select(*keys)


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", share: float | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Equi-join of a skewed ``left`` with a ``right`` that has few rows a key, hot left keys salted.

    ``how``: inner, left, left_semi or left_anti. Left rows of a hot key spread over as many partitions as the key has
    parts of the size at which a key is hot, and the right rows of that key are repeated so many times; all other rows
    are joined as they are. Rows with a null key match nothing and are spread as well. ``counts`` (the keys and one
    more column, their rows in ``left``) saves the pass that counts them, if the caller has it. Columns are those of
    ``left`` then (inner, left) the rest of ``right``; other column names must differ.
    """
    salt, salts, n = fresh("salt"), fresh("salts"), fresh("n")
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    else:
        counts = counts.withColumnRenamed(next(c for c in counts.columns if c not in keys), n)
    hot = F.broadcast(_hot(counts, keys, n, share, salts))  # at most 1 / share rows
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    hashed = F.xxhash64(*left.columns)
    spread = F.when(null_key, F.pmod(hashed, F.lit(int(1 / (share or hot_share(left.sparkSession)))))).otherwise(F.pmod(hashed, F.coalesce(salts, F.lit(1))))
    left_salted = left.join(hot, list(keys), "left").select(*left.columns, spread.cast("int").alias(salt))
    right_salted = right.join(hot, list(keys), "left").select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - 1)).alias(salt)
    )
    return left_salted.join(right_salted, [*keys, salt], how).drop(salt)


def running_sums(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    value: Column | str | Sequence[Column | str],
    name: str | Sequence[str],
    buckets: int = 256,
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows before this one in its group (exclusive running sum).

    Several values and names are summed in the same passes. The order inside a group is by a bucket of the hash of
    ``order`` and then by ``order`` itself: a fixed shuffle, the same in every run. Groups of any size are cut into
    ``buckets`` even parts, so that no task holds a whole hot group: part totals are combined first, then each part
    sums by itself. ``order`` must tell the rows of a group apart (ties would have to be broken by chance). Null
    groups count as one group.
    """
    names = [name] if isinstance(name, str) else list(name)
    values = [value] if isinstance(name, str) else list(value)
    bucket, vs, befores = fresh("bucket"), [fresh("v") for _ in names], [fresh("before") for _ in names]
    h = F.xxhash64(*order)
    rows = df.withColumns({v: F.col(x) if isinstance(x, str) else x for v, x in zip(vs, values)})
    rows = rows.withColumn(bucket, F.pmod(F.shiftright(h, 13), F.lit(buckets)).cast("int"))
    totals = rows.groupBy(*groups, bucket).agg(*[F.sum(v).alias(b) for v, b in zip(vs, befores)])
    parts = W.partitionBy(*groups).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(*[F.col(g).alias(f"__r_{g}") for g in groups], F.col(bucket).alias(f"__r_{bucket}"), *[F.coalesce(F.sum(b).over(parts), F.lit(0)).alias(b) for b in befores])
    inside = W.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumns({n: F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in zip(names, vs)})
    on = F.lit(True)
    for g in [*groups, bucket]:
        on = on & F.col(g).eqNullSafe(F.col(f"__r_{g}"))
    return local.join(starts, on, "left").select(*df.columns, *[(F.col(n) + F.col(b)).alias(n) for n, b in zip(names, befores)])
