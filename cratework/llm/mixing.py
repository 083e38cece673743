"""Mixing sources to target weights by weighted fair queueing.

Every document of a wanted source gets a virtual finish time: the tokens of its source up to and including it, in
a fixed shuffled order and over all copies so far, divided by the source's weight. The documents of all sources
are then taken in the order of these times, which keeps every source at its share at any point of the mix, until
the total budget is reached; a source whose copies run out leaves its place to the others. Running sums go
through bounded buckets, so a source with most documents is no single task; the global order is cut by counting times
in slots and counting the slot of the cut again in narrower ones, until it is small enough to be ordered by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cratework.functions.text import WHITE_SPACE
from cratework.llm.tokens import DEFAULT_VOCABULARY, with_token_counts
from cratework.operators.skew import running_sums, salted_join
from cratework.session import settle

# Queues that the driver orders itself, and up to which sources are broadcast; more are halved and joined by a shuffle.
FEW_SOURCES = 10_000
BUCKET_ROWS = 100_000
SLOTS = 1024
COPIES = 4096


@dataclass
class Mix:
    """``records``: source, doc, n_tokens, copy, finish (the order), of the chosen copies. ``report``: a row a wanted source."""

    records: DataFrame
    report: DataFrame


def source_key(c):
    """Sources are compared trimmed and in lower case."""
    return F.lower(F.btrim(c, F.lit(WHITE_SPACE)))


def fair_end(capacities: list[tuple[float, float]], budget: float, at: float = 0.0, served: float = 0.0, others: float = 0.0) -> float:
    """The virtual time at which queues of (weight, capacity) have served ``budget`` in all, or all they have.

    ``others`` is the weight of queues that end later than all of these; by ``at``, all queues have served ``served``.
    """
    queues = sorted((c / w, w) for w, c in capacities if w > 0 and c > 0)
    rate = others + sum(w for _, w in queues)
    for end, w in queues:
        if served + rate * (end - at) >= budget:
            break
        served += rate * (end - at)
        at, rate = end, rate - w
    return at + (budget - served) / rate if rate > 1e-12 and served < budget else at


def _end(plan: DataFrame, budget: float, few: int) -> float:
    """``fair_end`` of the plan's sources: halved at the median queue until few enough are left to be ordered here."""
    queues = plan.select(F.col("target_share").cast("double").alias("w"), (F.col("size") * F.col("max_repeats")).cast("double").alias("c"))
    queues = queues.filter("w > 0 and c > 0").withColumn("end", F.col("c") / F.col("w"))
    low, high = 0.0, float("inf")
    while True:
        inside = queues.filter((F.col("end") > F.lit(low)) & (F.col("end") <= F.lit(high)))
        n, middle, top = inside.agg(F.count(F.lit(1)), F.percentile_approx("end", 0.5), F.max("end")).first()
        if n <= few or middle in (low, high, top):
            break
        by_then = queues.agg(F.sum(F.least("c", F.col("w") * F.lit(middle)))).first()[0]
        low, high = (low, middle) if by_then >= budget else (middle, high)
    served = queues.agg(F.sum(F.least("c", F.col("w") * F.lit(low)))).first()[0] or 0.0
    others = queues.filter(F.col("end") > F.lit(high)).agg(F.sum("w")).first()[0] or 0.0
    same = inside.groupBy("end").agg(F.sum("w").alias("w")).limit(few + 1).collect()
    return fair_end([(r["w"], r["end"] * r["w"]) for r in same], budget, low, served, others)


def _within(served: DataFrame, budget: int, few: int, slots: int = SLOTS) -> DataFrame:
    """The longest row of ``served`` (with tokens), in order of finish, source_key, doc and copy, that fits the budget."""
    low, high = (x or 0.0 for x in served.agg(F.min("finish"), F.max("finish")).first())
    taken = 0
    while True:
        width = max((high - low) / slots, 1e-300)
        slot = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit(width)), F.lit(slots - 1))
        part = served.filter(F.col("finish").between(low, high)).groupBy(slot.alias("slot"))
        counts = part.agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.min("finish").alias("a"), F.max("finish").alias("b")).orderBy("slot").collect()  # at most `slots` rows
        for r in counts:
            if taken + r["t"] > budget:
                break
            taken += r["t"]
        else:
            return served
        narrower = (r["a"], r["b"]) != (low, high)
        low, high = r["a"], r["b"]
        if r["n"] <= few or low == high or not narrower:
            break
    order = W.orderBy("finish", "source_key", "doc", "copy").rowsBetween(W.unboundedPreceding, 0)  # of the last slot only
    last = served.filter(F.col("finish").between(low, high)).withColumn("so_far", F.sum("n_tokens").over(order)).filter(F.col("so_far") <= F.lit(budget - taken))
    return served.filter(F.col("finish") < F.lit(low)).unionAll(last.drop("so_far"))


def mix_sources(
    documents: DataFrame,
    targets: DataFrame,
    doc: str = "doc_id",
    source: str = "source",
    text: str = "text",
    vocabulary: str = DEFAULT_VOCABULARY,
    budget: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
    few_sources: int = FEW_SOURCES,
) -> Mix:
    """Mix ``documents`` to ``targets`` (source, target_share, max_repeats).

    ``budget`` is in tokens; without it, it is the size of all documents, those of unlisted or null source
    included. Targets of the same source in different spelling are one (shares summed, the larger repeats); null
    shares or repeats are 0. The report has source (as spelled first in the targets), target_share, size (tokens
    once), available (size times max_repeats), n_chosen, tokens, actual_share, falls_short: whether the last copy
    of the source leaves its queue before the budget's end in fair order, that is, whether available is less than
    the target. Documents without tokens are taken once, if their turn comes. Empty documents give an empty mix in which nothing falls short. Repeated document rows are
    documents of their own.
    """
    key = source_key(F.col(source)).alias("source_key")
    sizes = settle(with_token_counts(documents.select(F.col(doc).alias("doc"), key, F.col(text).alias("text")), ["doc", "source_key"], vocabulary=vocabulary))
    wanted = (
        targets.select(source_key(F.col("source")).alias("source_key"), "source", F.coalesce("target_share", F.lit(0.0)).alias("s"), F.coalesce("max_repeats", F.lit(0)).alias("r"))
        .filter(F.col("source_key").isNotNull())
        .groupBy("source_key")
        .agg(F.min("source").alias("source"), F.sum("s").alias("target_share"), F.max("r").cast("long").alias("max_repeats"))
    )
    by_source = settle(sizes.groupBy("source_key").agg(F.sum("n_tokens").alias("size"), F.count(F.lit(1)).alias("n")))
    total, rows = by_source.agg(F.sum("size"), F.sum("n")).first()
    total = total or 0
    buckets = max(64, -(-(rows or 0) // bucket_rows))
    budget = total if budget is None else budget
    plan = settle(wanted.join(by_source.drop("n"), "source_key", "left").withColumn("size", F.coalesce("size", F.lit(0))))
    end = _end(plan, float(budget), few_sources)

    def named(rows: DataFrame, *columns: str) -> DataFrame:
        right = plan.select("source_key", *columns)
        return rows.join(F.broadcast(right), "source_key") if few else salted_join(rows, right, ["source_key"])

    few = plan.limit(few_sources + 1).count() <= few_sources
    listed = named(sizes, "target_share", "max_repeats", "size").filter("target_share > 0 and max_repeats > 0")
    queued = running_sums(listed, ["source_key"], ["doc", "n_tokens"], "n_tokens", "before", buckets)
    # copies that start by the end: those of a document are no more than the end holds, however many are allowed
    last = F.when(F.col("size") > 0, F.floor((F.lit(end) * F.col("target_share") - F.col("before")) / F.col("size"))).otherwise(F.col("max_repeats") - 1)
    chances = queued.withColumn("last", F.least(F.col("max_repeats") - 1, last)).filter("last >= 0 and n_tokens > 0")
    zero = F.lit(0).cast("long")
    blocks = chances.withColumn("block", F.explode(F.sequence(zero, F.floor(F.col("last") / COPIES)))).withColumn("start", F.col("block") * COPIES)
    served = blocks.withColumn("copy", F.explode(F.sequence("start", F.least(F.col("start") + (COPIES - 1), F.col("last"))))).select(
        "source_key", "doc", "n_tokens", "copy",
        (F.col("size") * F.col("copy") + F.col("before") + F.col("n_tokens")).alias("done"),
        ((F.col("size") * F.col("copy") + F.col("before") + F.col("n_tokens")) / F.col("target_share")).alias("finish"),
    )
    served = settle(served)
    fits = _within(served, budget, bucket_rows)
    # documents without tokens take no place: once each, if their turn comes by the end
    nothing = queued.filter("n_tokens = 0").withColumn("copy", F.lit(0).cast("long")).withColumn("finish", F.col("before") / F.col("target_share"))
    nothing = nothing.filter(F.col("finish") <= F.lit(end))
    columns = ["source_key", "doc", "n_tokens", "copy", "finish"]
    chosen = settle(fits.select(*columns).unionAll(nothing.select(*columns)))

    got = chosen.groupBy("source_key").agg(F.count(F.lit(1)).alias("n_chosen"), F.sum("n_tokens").alias("tokens"))
    ends = served.groupBy("source_key").agg(F.max("done").alias("done"))
    all_tokens = chosen.agg(F.sum("n_tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(all_tokens)) if all_tokens else F.lit(0.0)
    report = (
        plan.join(got, "source_key", "left").join(ends, "source_key", "left").na.fill(0, ["n_chosen", "tokens", "done"])
        .select(
            "source", "target_share", "size", (F.col("size") * F.col("max_repeats")).alias("available"), "n_chosen", "tokens",
            share.alias("actual_share"), (F.col("done") < F.col("target_share") * F.lit(float(budget))).alias("falls_short"),
        )
    )
    records = named(chosen, "source").select("source", "doc", "n_tokens", "copy", "finish")
    return Mix(records, report)
