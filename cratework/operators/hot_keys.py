"""Per-key results where a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_summary(df: DataFrame, key: str, member: str, latest: str) -> DataFrame:
    """key_id, n_rows, n_members (distinct non-null members), latest: one row a key, null key included as null.

    Two algebraic aggregations, both combined map-side: by (key, member) and then by key. A hot key is spread by
    its members in the first and arrives as one partial state a task in the second, so no task sees its rows.
    An empty table gives no rows; repeated rows count in n_rows.
    """
    by_member = df.groupBy(F.col(key).alias("key_id"), F.col(member).alias("__member")).agg(
        F.count(F.lit(1)).alias("__n"), F.max(latest).alias("__latest")
    )
    return by_member.groupBy("key_id").agg(
        F.sum("__n").alias("n_rows"), F.count("__member").alias("n_members"), F.max("__latest").alias("latest")
    )


def heavy_keys(summary: DataFrame, rows: DataFrame, share: float) -> DataFrame:
    """The keys of the ``keyed_summary`` of ``rows`` that hold more than ``share`` of them (null is no key, but counts in the total).

    The total is a scalar subquery that reads no column.
    """
    total = rows.select(F.count(F.lit(1))).scalar()
    return summary.filter(F.col("key_id").isNotNull() & (F.col("n_rows") > F.lit(share) * total))
