"""Import of whole dumps: read once, build all tables, converge them to the stored ones, publish at once."""

from __future__ import annotations

import datetime as dt
import os
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.operators.converge import converge_relation, insert_or_ignore, reconcile_backlinks, upsert_if_changed
from cratework.operators.dedupe import count_windows
from cratework.plans import transforms
from cratework.plans.control import Control, Progress, entity_locks
from cratework.plans.registry import ENTITIES, TABLES
from cratework.plans.store import Store
from cratework.session import settle
from cratework.sources import catalog
from cratework.sources.xml import read_entity

EARLIEST = (2008, 3)
WRITERS = 6


@dataclass
class ImportConfig:
    """``dumps``: entity -> (path, dump date as yyyy-mm-dd, SHA-256 of the file), or, without them, ``entities`` to be
    found in the ``catalogue`` (an address or a local copy of it) and fetched into ``data_dir``."""

    store: str
    dumps: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    entities: tuple[str, ...] = ()
    dump_month: str | None = None
    catalogue: str | None = None
    data_dir: str = "dumps"
    max_workers: int = WRITERS
    chunk_size: int = 5000
    partitions: int | None = None
    force: bool = False
    allow_downgrade: bool = False
    cleanup: bool = False
    strict_references: bool = False
    observed_at: str | None = None
    messages: list[str] = field(default_factory=list)

    def validate(self, today: dt.date | None = None) -> None:
        """P10: known entities, months from 2008-03 to now, a positive 32-bit chunk size, local paths."""
        today = today or dt.date.today()
        named = set(self.dumps) | set(self.entities)
        if named - set(ENTITIES) or not named:
            raise ValueError(f"entities must be of {ENTITIES}, got {sorted(named)}")
        for name in ("chunk_size", "max_workers"):
            if not 0 < getattr(self, name) <= 2147483647:
                raise ValueError(f"{name} must be a positive 32-bit number")
        if self.dump_month is not None:
            if not re.fullmatch(r"[0-9]{4}-(0[1-9]|1[0-2])", self.dump_month):
                raise ValueError(f"not a month (yyyy-mm): {self.dump_month}")
            if not EARLIEST <= tuple(int(x) for x in self.dump_month.split("-")) <= (today.year, today.month):
                raise ValueError(f"month out of range: {self.dump_month}")
        if not self.dumps and not self.catalogue:
            raise ValueError("without dumps, a catalogue must be named")
        for entity, (path, date, checksum) in self.dumps.items():
            day = dt.date.fromisoformat(date)
            if not EARLIEST <= (day.year, day.month) <= (today.year, today.month):
                raise ValueError(f"{entity}: month out of range: {date}")
            if urlparse(path).scheme in ("http", "https"):
                raise ValueError(f"{entity}: fetch {path} first")
            if not re.fullmatch(r"[0-9a-fA-F]{64}", checksum):
                raise ValueError(f"{entity}: not a SHA-256: {checksum}")


def numbered(df: DataFrame) -> DataFrame:
    """Adds ``row_idx``, the place of each record in source order (from 0). Call it right after a scan."""
    spark = df.sparkSession
    parts = df.withColumn("__pid", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = {r[0]: r[1] for r in parts.groupBy("__pid").count().collect()}  # a row a scan partition
    starts, at = [], 0
    for pid in sorted(sizes):
        starts.append((pid, at))
        at += sizes[pid]
    offsets = spark.createDataFrame(starts or [(-1, 0)], "__pid int, __start long")
    return parts.join(F.broadcast(offsets), "__pid").withColumn("row_idx", F.col("__at") + F.col("__start")).drop("__pid", "__at", "__start")


def import_entity(store: Store, entity: str, records: DataFrame, observed_at: str, seed: bool = False, strict: bool = False, fence=None, workers: int = WRITERS) -> dict[str, str]:
    """Import one entity's records; returns the published versions.

    Root rows are updated only where they changed; relations of the dump's roots become exactly what the dump has;
    roots that the dump lacks stay with their relations. A dump of releases ends with the back-links of masters.
    """
    id_column = "id" if entity in ("artist", "label") else "_id"
    at = F.lit(observed_at).cast("timestamp")
    dump_ids = records.select(F.col(id_column).alias("id"))
    empty = dump_ids.limit(0)
    known = {e: transforms.known_ids(dump_ids if e == entity else None, store.read(e), strict and e == entity) if (e == entity or store.read(e) is not None) else empty for e in ("artist", "label", "master")}
    build = transforms.BUILDERS[entity]
    tables = build(records, known, seed) if entity == "master" else build(records, known)

    def stage(name: str) -> tuple[str, str]:
        t = TABLES[name]
        incoming = transforms.observed(transforms.canonical(tables[name], t), t, at)
        stored = store.read(name)
        if stored is None:
            merged = incoming
        elif t.is_root:
            merged = upsert_if_changed(stored, incoming, "id", t.business, "last_modified_at")
        elif t.is_dimension:
            merged = insert_or_ignore(stored, incoming, t.key)
        else:
            merged = converge_relation(stored, incoming, dump_ids.select(F.col("id").alias(t.root)), t.root, t.match, t.nullable)
        return name, store.stage(name, merged)

    with ThreadPoolExecutor(workers) as pool:  # tables are independent of each other until they are published
        staged = dict(pool.map(stage, tables))
    if entity == "release" and (masters := store.read("master")) is not None:
        releases = store.staged("release_item", staged["release_item"])
        linked = reconcile_backlinks(masters, releases, "id", "main_release_id", "master_id", "id", [F.col("last_modified_at")], F.coalesce(F.col("is_master"), F.lit(False)))
        staged["master"] = store.stage("master", linked)
    store.publish(staged, fence)
    return staged


def resolve_dumps(spark: SparkSession, config: ImportConfig, control: Control, fetch=None) -> dict[str, tuple[str, str, str]]:
    """The dumps of the configured entities: from the stored catalogue or a fresh one, fetched and verified.

    For an exact month the stored catalogue comes first and is refreshed only if it lacks a dump; without a month it
    is refreshed first, and what is stored serves if that fails.
    """
    if config.dumps:
        return config.dumps
    fetch = fetch or catalog.opener(config.catalogue)

    def refresh() -> None:
        control.store_dumps(spark, catalog.fetch_catalogue(spark, fetch, config.entities, config.dump_month))

    plan, failure = None, None
    if config.dump_month:
        try:
            plan = control.plan_of(spark, config.entities, config.dump_month)
        except LookupError:
            refresh()
    else:
        try:
            refresh()
        except (OSError, ValueError) as x:
            failure = x
    try:
        plan = plan or control.plan_of(spark, config.entities, config.dump_month)
    except LookupError as x:
        raise (failure or x) from x
    found = {}
    for e, d in plan.items():
        path = os.path.join(config.data_dir, d["uri"].rsplit("/", 1)[-1])
        found[e] = (catalog.fetch_verified(lambda uri: fetch("download", uri), d["uri"], path, d["checksum"]), d["dump_date"], d["checksum"])
    return found


def verify_dumps(dumps: dict[str, tuple[str, str, str]]) -> None:
    """Each dump must be the file that its checksum says."""
    for entity, (path, _, checksum) in dumps.items():
        if catalog.sha256_of(path) != checksum.lower():
            raise ValueError(f"{entity}: checksum mismatch for {path}")


def run_import(spark: SparkSession, config: ImportConfig, progress: Progress | None = None, fetch=None) -> dict:
    """The whole plan: validate, find and verify dumps, lock, admit (skip, resume, refuse), import in dependency order, finish, clean up.

    Each entity's records are parsed once, numbered in source order and kept as Parquet beside the tables until the
    entity is published; the ledger's chunks are counted from these numbers.
    """
    config.validate()
    store = Store(spark, config.store)
    control = Control(os.path.join(config.store, "control.json"))
    found = resolve_dumps(spark, config, control, fetch)
    dumps = [{"entity_type": e, "dump_date": d, "checksum": c, "uri": p} for e, (p, d, c) in found.items()]
    with entity_locks(os.path.join(config.store, "locks"), found):
        verify_dumps(found)
        plan = control.admit(spark, dumps, config.chunk_size, config.force, config.allow_downgrade)
        if not plan["skip"]:
            run = plan["run"]
            try:
                control.check_dependencies(spark, dumps)
                for entity in ENTITIES:
                    if entity not in found or entity in plan["complete"]:
                        continue
                    raw = store.stage(f"_raw_{entity}", numbered(settle(read_entity(spark, found[entity][0], entity))))
                    records = store.staged(f"_raw_{entity}", raw)
                    chunks = count_windows(records, "row_idx", config.chunk_size)
                    if config.partitions:
                        records = records.repartition(config.partitions)
                    observed = config.observed_at or dt.datetime.now(dt.UTC).strftime("%Y-%m-%d %H:%M:%S")
                    seed = entity == "master" and "release" in found and store.read("release_item") is None
                    import_entity(store, entity, records.drop("row_idx"), observed, seed, config.strict_references, lambda: control.fence(run), config.max_workers)
                    total = records.count()
                    control.finish_entity(spark, run, entity, chunks, total)
                    store.discard(f"_raw_{entity}", raw)
                    if progress:
                        progress.report(entity, total, total, force=True)
                control.finish(spark, run)
            except BaseException as x:
                control.finish(spark, run, str(x)[:500] or type(x).__name__)
                raise
        if config.cleanup:
            catalog.delete_files([p for p, _, _ in found.values()])
    return plan
