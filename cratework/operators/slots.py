"""Slot allocation: collision-safe 32-bit keys inside a scope."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.functions.hashing import IdentityDomain, compat_slot
from cratework.session import settle


def slot_of(domain: IdentityDomain, relation: str, digest: bytes, attempt: int) -> int:
    """The candidate slot of a digest, as the column expression ``compat_slot`` gives it."""
    frame = domain.slot.encode() + b"\0" + relation.encode() + b"\0" + digest + attempt.to_bytes(4, "big")
    return int.from_bytes(hashlib.sha256(frame).digest()[:4], "big", signed=True)


def allocate_slots(df: DataFrame, scope: Sequence[str], legacy: str, digest: str, domain: IdentityDomain, relation: str) -> DataFrame:
    """Adds ``slot`` to rows that are unique by (scope, digest).

    Inside a scope, by ascending legacy hash and, within one, ascending digest (unsigned bytes): the first digest
    of a hash keeps it; each further one takes its first candidate (attempt 0, 1, ...) that is no legacy hash of
    the scope and wasn't given out to an earlier row.

    The order is a common priority, so rounds of proposals give the same result as going through the rows one by
    one: every open row proposes to its next candidate, each slot keeps the first of its proposers in priority, the
    others go on. One round nearly always does. Rows that are first for their hash take no part, so a scope of any
    size is spread over all tasks. Rows with a null scope, hash or digest keep the hash as it is. Empty input
    gives no rows.
    """
    s = list(scope)
    firsts = df.groupBy(*s, legacy).agg(F.min(digest).alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    rows = df.select(*s, F.col(legacy).alias("__legacy"), F.col(digest).alias("__digest"))
    later = rows.join(firsts.withColumnRenamed(legacy, "__legacy"), [*s, "__legacy"]).filter("__digest <> __first").drop("__first")
    waiting = settle(later.withColumn("__attempt", F.lit(0)))
    if waiting.isEmpty():
        return df.withColumn("slot", F.col(legacy))
    reserved = df.select(*s, F.col(legacy).alias("slot")).distinct()
    held = None
    while not waiting.isEmpty():
        asked = waiting.withColumn("slot", compat_slot(domain, relation, F.col("__digest"), F.col("__attempt")))
        asked = settle(asked.join(reserved.withColumn("__taken", F.lit(True)), [*s, "slot"], "left"))
        fair = asked.filter("__taken is null").drop("__taken")
        fair = fair if held is None else fair.unionByName(held)
        best = fair.groupBy(*s, "slot").agg(F.min(F.struct("__legacy", "__digest")).alias("__best"))
        judged = settle(fair.join(best, [*s, "slot"]).withColumn("__won", (F.col("__best.__legacy") == F.col("__legacy")) & (F.col("__best.__digest") == F.col("__digest"))))
        columns = [*s, "__legacy", "__digest", "__attempt"]
        held = judged.filter("__won").select(*columns, "slot")
        again = judged.filter("not __won").select(*columns).unionByName(asked.filter("__taken").select(*columns))
        waiting = settle(again.withColumn("__attempt", F.col("__attempt") + 1))
    given = held.select(*s, F.col("__digest").alias(digest), F.col("slot").alias("__slot"))
    return df.join(given, [*s, digest], "left").select(*df.columns, F.coalesce("__slot", legacy).alias("slot"))
