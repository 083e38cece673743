"""Questions about import runs, as plans over the control tables.

``runs``: id, manifest, status, completed_at, force_requested. ``run_dumps``: import_run_id, entity_type, dump_id,
revision, chunk_size, processed_items, total_items, total_chunks, completed_at. ``chunks``: the chunk ledger.
``checkpoints``: entity_type, import_run_id, dump_date, applied_at (the last success of each entity).
``dumps``: id, entity_type, dump_date, checksum. ``revisions``: entity_type, current_revision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratework.functions.dates import first_of_next_month
from cratework.operators.dedupe import newest_per_group


def revision_of(entity: Column, revisions: dict[str, int]) -> Column:
    """the contract revision of an entity, null for an unknown one."""
    pairs = [F.lit(x) for kv in revisions.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), entity)


def newest_success(runs: DataFrame, manifest: Column | str) -> DataFrame:
    """O1: the newest successful run of a manifest (a TakeOrdered of one row)."""
    done = runs.filter((F.col("manifest") == manifest) & (F.col("status") == "success"))
    return done.orderBy(F.desc("completed_at"), F.desc("id")).limit(1)


def checkpoints(runs: DataFrame, run_dumps: DataFrame, dumps: DataFrame) -> DataFrame:
    """The last successful run of each entity: entity_type, import_run_id, dump_date, applied_at, dump_id, revision."""
    done = runs.filter(F.col("status") == "success").select(F.col("id").alias("import_run_id"), F.col("completed_at").alias("applied_at"))
    rows = run_dumps.select("import_run_id", "entity_type", "dump_id", "revision").join(done, "import_run_id")
    rows = rows.join(dumps.select(F.col("id").alias("dump_id"), "dump_date"), "dump_id")
    return newest_per_group(rows, ["entity_type"], [F.col("applied_at"), F.col("import_run_id")], ["import_run_id", "dump_date", "applied_at", "dump_id", "revision"])


def checkpoint_compatibility(expected: DataFrame, points: DataFrame, failed: DataFrame) -> DataFrame:
    """For each expected (entity_type, dump_id, expected_revision) whether the stored state is just that.

    Compatible: the entity's checkpoint has this dump and revision, and no run of the entity failed after it
    (later time, or the same time and a greater run id). ``failed``: entity_type, id, completed_at.
    """
    f = failed.select(F.col("entity_type").alias("fe"), F.col("id").alias("fid"), F.col("completed_at").alias("fat"))
    p = points.alias("p")
    later = (F.col("p.entity_type") == F.col("fe")) & ((F.col("fat") > F.col("p.applied_at")) | ((F.col("fat") == F.col("p.applied_at")) & (F.col("fid") > F.col("p.import_run_id"))))
    clean = p.join(f, later, "left_anti").select(F.col("p.entity_type").alias("ce"), F.col("p.dump_id").alias("cd"), F.col("p.revision").alias("cr"))
    joined = expected.join(clean, F.col("entity_type") == F.col("ce"), "left")
    same = (F.col("cd") == F.col("dump_id")) & (F.col("cr") == F.col("expected_revision"))
    return joined.select(*expected.columns, F.coalesce(same, F.lit(False)).alias("compatible"))


def compatibility_summary(compatibility: DataFrame) -> DataFrame:
    """One row: compatible and all entities, and the incompatible ones as ordered text ('' if none)."""
    return compatibility.agg(
        F.count_if("compatible").alias("compatible_entities"),
        F.count(F.lit(1)).alias("selected_entities"),
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col("compatible"), F.col("entity_type")))), ",").alias("incompatible"),
    )


def resumable_runs(runs: DataFrame, run_dumps: DataFrame, chunks: DataFrame, points: DataFrame, revisions: dict[str, int], manifest: str, chunk_size: int, entities: int) -> DataFrame:
    """Failed runs of the manifest, newest first, from which a run may resume.

    Not forced, as many entities as wanted, every entity at the current revision and chunk size, its processed
    items equal to the sum of its chunks, all chunk ranges valid, and no newer checkpoint of another dump or
    revision. All conditions but the last are one aggregation of the run's entities.
    """
    sums = chunks.groupBy("import_run_id", "entity_type").agg(
        F.sum("item_count").alias("n_items"), F.count_if((F.col("first_item_index") != F.col("chunk_index") * F.lit(chunk_size)) | (F.col("item_count") > chunk_size)).alias("bad")
    )
    each = run_dumps.join(sums, ["import_run_id", "entity_type"], "left")
    fine = (
        F.col("revision").eqNullSafe(revision_of(F.col("entity_type"), revisions))
        & F.col("chunk_size").eqNullSafe(F.lit(chunk_size))
        & (F.col("processed_items") == F.coalesce("n_items", F.lit(0)))
        & (F.coalesce("bad", F.lit(0)) == 0)
    )
    whole = each.groupBy("import_run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(fine, F.lit(False))).alias("ok"))
    good = whole.filter((F.col("n") == entities) & (F.col("ok") == entities)).select(F.col("import_run_id").alias("id"))
    failed = runs.filter((F.col("manifest") == manifest) & (F.col("status") == "failed") & ~F.col("force_requested")).join(good, "id", "left_semi")
    p = points.select("entity_type", F.col("import_run_id").alias("pid"), "applied_at", F.col("dump_id").alias("pdump"), F.col("revision").alias("prev"))
    mine = run_dumps.select(F.col("import_run_id").alias("id"), "entity_type", "dump_id", "revision").join(p, "entity_type")
    other = mine.filter((F.col("pdump") != F.col("dump_id")) | (F.col("prev") != F.col("revision")))
    late = failed.join(other, "id").filter((F.col("applied_at") > F.col("completed_at")) | ((F.col("applied_at") == F.col("completed_at")) & (F.col("pid") > F.col("id"))))
    return failed.join(late.select("id").distinct(), "id", "left_anti").orderBy(F.desc("completed_at"), F.desc("id"))


def superseded_failures(runs: DataFrame, run_dumps: DataFrame, points: DataFrame) -> DataFrame:
    """Failed runs all of whose dumps are what the checkpoints have now: their chunks may go. Column import_run_id."""
    p = points.select(F.col("entity_type").alias("pe"), F.col("dump_id").alias("pd"), F.col("revision").alias("pr"))
    failed = runs.filter(F.col("status") == "failed").select(F.col("id").alias("import_run_id"))
    joined = run_dumps.join(p, F.col("entity_type") == F.col("pe"), "left")
    needed = joined.filter(~F.col("pd").eqNullSafe(F.col("dump_id")) | ~F.col("pr").eqNullSafe(F.col("revision")))
    return failed.join(needed.select("import_run_id").distinct(), "import_run_id", "left_anti")


def prune_chunks(chunks: DataFrame, superseded: DataFrame) -> DataFrame:
    return chunks.join(superseded, "import_run_id", "left_anti").select(chunks.columns)


def mark_abandoned(runs: DataFrame, run_dumps: DataFrame, entities: list[str], now: Column) -> DataFrame:
    """Running runs that touch one of the entities become failed; other rows stay."""
    touched = run_dumps.filter(F.col("entity_type").isin(entities)).select(F.col("import_run_id").alias("__id")).distinct()
    joined = runs.join(touched, F.col("id") == F.col("__id"), "left")
    gone = F.col("__id").isNotNull() & (F.col("status") == "running")
    return joined.select(
        *[
            F.when(gone, F.lit("failed")).otherwise(F.col(c)).alias(c) if c == "status" else F.when(gone, now).otherwise(F.col(c)).alias(c) if c == "completed_at" else F.col(c)
            for c in runs.columns
        ]
    )


def copy_progress(run_dumps: DataFrame, source_run: int, target_run: int) -> DataFrame:
    """The target run's rows take over the progress of the source run's rows of the same entity, dump and chunk size."""
    keys = ["entity_type", "dump_id", "chunk_size"]
    taken = ["processed_items", "total_items", "total_chunks", "completed_at"]
    source = run_dumps.filter(F.col("import_run_id") == source_run).select(*keys, F.struct(*taken).alias("__s"))
    joined = run_dumps.join(source, keys, "left")
    take = (F.col("import_run_id") == target_run) & F.col("__s").isNotNull()
    return joined.select(*[F.when(take, F.col("__s")[c]).otherwise(F.col(c)).alias(c) if c in taken else F.col(c) for c in run_dumps.columns])


def consolidated(expected: DataFrame, points: DataFrame, run_dumps: DataFrame, new_run: int) -> DataFrame:
    """The run rows of a run that only records that all its dumps are stored already."""
    rows = expected.select("entity_type", F.col("dump_id").alias("ed"), F.col("expected_revision").alias("er")).join(points.select("entity_type", F.col("import_run_id").alias("pid")), "entity_type")
    source = run_dumps.alias("s")
    on = (F.col("s.import_run_id") == F.col("pid")) & (F.col("s.entity_type") == rows["entity_type"]) & (F.col("s.dump_id") == F.col("ed")) & (F.col("s.revision") == F.col("er"))
    kept = [F.lit(new_run).cast(run_dumps.schema[c].dataType).alias(c) if c == "import_run_id" else F.col(f"s.{c}") for c in run_dumps.columns]
    return source.join(rows, on).select(*kept)


def downgrades(selected: DataFrame, points: DataFrame) -> DataFrame:
    """Selected dumps (entity_type, dump_date) older than the entity's checkpoint; entities without one are fine."""
    p = points.select("entity_type", F.col("dump_date").alias("checkpoint_date"))
    return selected.join(p, "entity_type").filter(F.col("dump_date") < F.col("checkpoint_date"))


def dependency_states(requirements: DataFrame, completed: DataFrame, dumps: DataFrame) -> DataFrame:
    """State of each required entity: 'missing', 'newer', 'no provenance', 'stale', 'reissued' or 'fine'.

    ``requirements``: entity_type, horizon (exclusive). ``completed``: entity_type, dump_date, checksum, completed_at,
    import_run_id of complete runs at the current revision. The newest completed one is held against the newest
    catalogue dump before the horizon; checksums are compared trimmed and without case.
    """
    point = newest_per_group(completed, ["entity_type"], [F.col("completed_at"), F.col("import_run_id")], ["dump_date", "checksum"])
    before = dumps.join(requirements.select("entity_type", "horizon"), "entity_type").filter(F.col("dump_date") < F.col("horizon"))
    wanted = newest_per_group(before, ["entity_type"], [F.col("dump_date"), F.col("id")], ["dump_date", "checksum"]).select(
        "entity_type", F.col("dump_date").alias("expected_date"), F.col("checksum").alias("expected_checksum")
    )
    joined = requirements.join(point, "entity_type", "left").join(wanted, "entity_type", "left")
    plain = lambda c: F.lower(F.trim(c))
    state = (
        F.when(F.col("dump_date").isNull(), "missing")
        .when(F.col("dump_date") >= F.col("horizon"), "newer")
        .when(F.col("expected_date").isNull() | F.col("expected_checksum").isNull(), "no provenance")
        .when(F.col("dump_date") < F.col("expected_date"), "stale")
        .when((F.col("dump_date") == F.col("expected_date")) & (plain("checksum") != plain("expected_checksum")), "reissued")
        .otherwise("fine")
    )
    return joined.select("entity_type", "horizon", "dump_date", "expected_date", state.alias("state"))


def dependency_requirements(selected: DataFrame, dependencies: dict[str, tuple[str, ...]]) -> DataFrame:
    """entity_type, horizon, required_by of the entities that selected dumps need but that aren't selected themselves."""
    pairs = [x for k, v in dependencies.items() if v for x in (F.lit(k), F.array(*[F.lit(e) for e in v]))]
    needs = F.try_element_at(F.create_map(*pairs), F.col("entity_type"))
    rows = selected.select(F.col("entity_type").alias("by"), first_of_next_month("dump_date").alias("h"), F.explode(needs).alias("entity_type"))
    rows = rows.join(selected.select("entity_type"), "entity_type", "left_anti")
    return rows.groupBy("entity_type").agg(F.max("h").alias("horizon"), F.array_join(F.sort_array(F.collect_set("by")), ",").alias("required_by"))
