"""Chunk ledgers: which windows of a dump are done, whether they cover it, where a run resumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = ["import_run_id", "entity_type"]


def valid_range(size: Column, total: Column | None = None) -> Column:
    """First item = index * size, at most ``size`` items; with ``total``, only the last chunk may be short."""
    ok = (F.col("first_item_index") == F.col("chunk_index") * size) & (F.col("item_count") <= size) & (F.col("item_count") > 0)
    if total is None:
        return ok
    last = F.col("first_item_index") + F.col("item_count") >= total
    return ok & (last | (F.col("item_count") == size)) & (F.col("first_item_index") + F.col("item_count") <= total)


def record_chunks(ledger: DataFrame, done: DataFrame, runs: DataFrame) -> DataFrame:
    """Append chunks of running runs only; a chunk that is recorded already is left as it is."""
    running = runs.filter(F.col("status") == "running").select(F.col("id").alias("import_run_id"))
    fenced = done.join(running, "import_run_id", "left_semi").dropDuplicates([*RUN, "chunk_index"])
    new = fenced.join(ledger.select(*RUN, "chunk_index"), [*RUN, "chunk_index"], "left_anti")
    return ledger.unionByName(new.select(ledger.columns))


def coverage(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """For each row of ``runs`` (run, entity, chunk_size, total_items, total_chunks) whether its chunks cover it.

    n_chunks, n_items, valid_chunks and complete; runs without chunks have zeros.
    """
    joined = ledger.join(runs.select(*RUN, "chunk_size", "total_items"), RUN)
    per_run = joined.groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.coalesce(F.sum("item_count"), F.lit(0)).alias("n_items"),
        F.count_if(valid_range(F.col("chunk_size"), F.col("total_items"))).alias("valid_chunks"),
    )
    out = runs.join(per_run, RUN, "left").na.fill(0, ["n_chunks", "n_items", "valid_chunks"])
    complete = (F.col("n_chunks") == F.col("total_chunks")) & (F.col("n_items") == F.col("total_items")) & (F.col("valid_chunks") == F.col("n_chunks"))
    return out.withColumn("complete", F.coalesce(complete, F.lit(False)))


def pending_chunks(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """The chunks of a dump that no ledger row has yet (skipped before anything is exploded)."""
    keys = [c for c in (*RUN, "chunk_index") if c in chunks.columns]
    return chunks.join(ledger.select(*keys).distinct(), keys, "left_anti").select(chunks.columns)


def range_mismatches(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Recorded chunks whose range differs from the dump's: an error on resume."""
    old = ledger.select(*RUN, "chunk_index", F.col("first_item_index").alias("old_first"), F.col("item_count").alias("old_count"))
    both = chunks.join(old, [*RUN, "chunk_index"])
    return both.filter((F.col("first_item_index") != F.col("old_first")) | (F.col("item_count") != F.col("old_count")))
