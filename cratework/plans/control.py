"""Run control on the driver: locks, the control tables, admission, progress records."""

from __future__ import annotations

import datetime as dt
import fcntl
import hashlib
import json
import os
import tempfile
import threading
import time
from collections.abc import Callable, Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.plans import runs as R
from cratework.plans.ledger import coverage, record_chunks
from cratework.plans.registry import CONTRACT_REVISIONS, DEPENDENCIES, ENTITIES
from cratework.sources.catalog import latest_dump, store_dumps

SCHEMAS = {
    "runs": "id bigint, manifest string, status string, completed_at timestamp, force_requested boolean, failure string",
    "run_dumps": "import_run_id bigint, entity_type string, dump_id bigint, revision int, chunk_size bigint, processed_items bigint, "
    "total_items bigint, total_chunks bigint, completed_at timestamp",
    "chunks": "import_run_id bigint, entity_type string, chunk_index bigint, first_item_index bigint, item_count bigint",
    "states": "entity_type string, state string, operation string, import_run_id bigint, changed_at timestamp",
    "dumps": "id bigint, entity_type string, dump_date date, checksum string, uri string",
}


LEASE = 60.0


class PartialImportError(RuntimeError):
    """Some entities of the manifest are stored already and others aren't."""


class DowngradeError(RuntimeError):
    pass


class DependencyError(RuntimeError):
    pass


def manifest_of(dumps: Iterable[dict]) -> str:
    """The fingerprint of a selection: SHA-256 over its sorted (entity, date, checksum)."""
    lines = sorted(f"{d['entity_type']}\t{d['dump_date']}\t{d['checksum'].lower()}" for d in dumps)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def lock_entities(selected: Iterable[str]) -> list[str]:
    """The entities an import locks: those selected and those they depend on, in import order."""
    wanted = {e for s in selected for e in (s, *DEPENDENCIES[s])}
    return [e for e in ENTITIES if e in wanted]


@contextmanager
def exclusive(path: str):
    """A short critical section between processes; the lock ends with the process that holds it."""
    with open(f"{path}.mutex", "a") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        yield


def _take(path: str, lease: float) -> None:
    """Create a lock file; one whose holder hasn't renewed it for ``lease`` seconds is taken away (by one rename, so by one taker)."""
    try:
        os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
    except FileExistsError:
        try:
            if time.time() - os.stat(path).st_mtime <= lease:
                raise
            gone = f"{path}.{os.getpid()}.stale"
            os.rename(path, gone)
            os.unlink(gone)
        except FileNotFoundError:
            pass
        os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))


@contextmanager
def entity_locks(folder: str, entities: Iterable[str], lease: float = LEASE):
    """One lock file an entity, taken in import order, given back in reverse; a held one raises FileExistsError.

    The holder renews its locks while it lives; those of a killed process can be taken after ``lease`` seconds.
    """
    os.makedirs(folder, exist_ok=True)
    held: list[str] = []
    over = threading.Event()

    def renew() -> None:
        while not over.wait(lease / 4):
            for path in list(held):
                try:
                    os.utime(path)
                except OSError:
                    pass

    keeper = threading.Thread(target=renew, daemon=True)
    try:
        for e in lock_entities(entities):
            path = os.path.join(folder, f"{e}.lock")
            _take(path, lease)
            held.append(path)
        keeper.start()
        yield
    finally:
        over.set()
        for path in reversed(held):
            if os.path.exists(path):
                os.unlink(path)


class Control:
    """The control tables. They are small (a row a run, entity and chunk), kept in one file that is replaced at once.

    Each change reads the file, changes it and writes it back in one critical section, so that runs of other entities
    lose nothing.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.load()

    def load(self) -> None:
        self.tables: dict[str, list[dict]] = {k: [] for k in SCHEMAS}
        if os.path.exists(self.path):
            with open(self.path) as f:
                self.tables |= json.load(f)

    @contextmanager
    def change(self):
        with exclusive(self.path):
            self.load()
            yield
            self.save()

    def save(self) -> None:
        fd, temporary = tempfile.mkstemp(dir=os.path.dirname(self.path) or ".")
        with os.fdopen(fd, "w") as f:
            json.dump(self.tables, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, self.path)

    def replace(self, name: str, df: DataFrame) -> None:
        """Take the rows of a plan over a control table as the table's next state."""
        text = lambda v: v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v
        self.tables[name] = [{c: text(v) for c, v in r.asDict().items()} for r in df.collect()]

    def frame(self, spark: SparkSession, name: str) -> DataFrame:
        """A control table as a frame; dates and instants are kept as ISO text in the file."""
        import pyspark.sql.types as T

        schema = T._parse_datatype_string(SCHEMAS[name])
        kinds = {f.name: f.dataType for f in schema.fields}

        def value(row: dict, c: str):
            v = row.get(c)
            if v is None:
                return None
            if isinstance(kinds[c], T.TimestampType):
                return dt.datetime.fromisoformat(v)
            return dt.date.fromisoformat(v) if isinstance(kinds[c], T.DateType) else v

        return spark.createDataFrame([tuple(value(r, c) for c in kinds) for r in self.tables[name]], schema)

    def next_id(self, name: str) -> int:
        return max((r["id"] for r in self.tables[name]), default=0) + 1

    def dump_id(self, entity: str, date: str, checksum: str, uri: str) -> int:
        """K5: the stored dump of (date, entity, checksum), stored if it isn't there."""
        for r in self.tables["dumps"]:
            if (r["entity_type"], r["dump_date"], r["checksum"]) == (entity, date, checksum.lower()):
                return r["id"]
        row = {"id": self.next_id("dumps"), "entity_type": entity, "dump_date": date, "checksum": checksum.lower(), "uri": uri}
        self.tables["dumps"].append(row)
        return row["id"]

    def checkpoints(self, spark: SparkSession) -> DataFrame:
        return R.checkpoints(self.frame(spark, "runs"), self.frame(spark, "run_dumps"), self.frame(spark, "dumps"))

    def store_dumps(self, spark: SparkSession, found: DataFrame) -> int:
        """K4: store the catalogue rows (entity_type, dump_date, checksum, uri) that aren't stored yet; returns how many were new."""
        with self.change():
            stored = self.frame(spark, "dumps").select("entity_type", "dump_date", "checksum", "uri")
            merged = store_dumps(stored, found.select("entity_type", "dump_date", "checksum", "uri")).orderBy("dump_date", "entity_type").collect()
            before = len(self.tables["dumps"])
            for r in merged:
                self.dump_id(r["entity_type"], r["dump_date"].isoformat(), r["checksum"], r["uri"])
            return len(self.tables["dumps"]) - before

    def plan_of(self, spark: SparkSession, entities: Iterable[str], month: str | None = None) -> dict[str, dict]:
        """Entity -> the stored dump to import, the newest of all or of one month (yyyy-mm); a missing one raises LookupError."""
        first = F.to_date(F.lit(f"{month}-01")) if month else None
        plan = {e: latest_dump(self.frame(spark, "dumps"), e, first).first() for e in entities}
        if missing := sorted(e for e, r in plan.items() if r is None):
            raise LookupError(f"no dump of {', '.join(missing)} for {month or 'any month'}")
        return {e: {"uri": r["uri"], "dump_date": r["dump_date"].isoformat(), "checksum": r["checksum"]} for e, r in plan.items()}

    def check_dependencies(self, spark: SparkSession, dumps: list[dict]) -> None:
        """What the selected dumps need must be complete at the current revision and not older than the catalogue; else DependencyError."""
        selected = spark.createDataFrame([(d["entity_type"], dt.date.fromisoformat(d["dump_date"])) for d in dumps], "entity_type string, dump_date date")
        needs = R.dependency_requirements(selected, dict(DEPENDENCIES))
        current = R.revision_of(F.col("entity_type"), CONTRACT_REVISIONS) == F.col("revision")
        done = self.frame(spark, "run_dumps").filter("completed_at is not null and processed_items = total_items").filter(current)
        done = done.join(self.frame(spark, "dumps").selectExpr("id as dump_id", "dump_date", "checksum"), "dump_id")
        states = R.dependency_states(needs.select("entity_type", "horizon"), done, self.frame(spark, "dumps")).filter("state not in ('fine', 'newer')").collect()
        if states:
            raise DependencyError("; ".join(f"{r['entity_type']}: {r['state']}" for r in states))

    def admit(self, spark: SparkSession, dumps: list[dict], chunk_size: int, force: bool = False, allow_downgrade: bool = False) -> dict:
        """Decide what a run does: {'skip': True}, or its id, manifest and the entities that are complete already.

        Older dumps than the stored ones raise unless allowed; required entities must be complete and up to date;
        running runs of the same entities (whose locks this run holds now) are abandoned; a manifest that is stored as a
        whole is skipped, one that is stored in part raises, one that failed with the same chunk size and contract is
        resumed, entity by entity.
        """
        with self.change():
            return self._admit(spark, dumps, chunk_size, force, allow_downgrade)

    def _admit(self, spark: SparkSession, dumps: list[dict], chunk_size: int, force: bool, allow_downgrade: bool) -> dict:
        manifest, now = manifest_of(dumps), dt.datetime.now(dt.UTC).replace(tzinfo=None)
        selected = spark.createDataFrame([(d["entity_type"], dt.date.fromisoformat(d["dump_date"])) for d in dumps], "entity_type string, dump_date date")
        points = self.checkpoints(spark)
        if not allow_downgrade and (old := R.downgrades(selected, points).collect()):
            raise DowngradeError(f"older than stored: {[(r['entity_type'], str(r['dump_date'])) for r in old]}")
        self.check_dependencies(spark, dumps)
        running = {r["id"] for r in self.tables["runs"] if r["status"] == "running"}
        if running:
            self.replace("runs", R.mark_abandoned(self.frame(spark, "runs"), self.frame(spark, "run_dumps"), [d["entity_type"] for d in dumps], F.lit(now)))
            for r in self.tables["runs"]:
                if r["id"] in running and r["status"] == "failed":
                    r["failure"] = "abandoned"
        ids = {d["entity_type"]: self.dump_id(d["entity_type"], d["dump_date"], d["checksum"], d.get("uri", "")) for d in dumps}
        runs, run_dumps = self.frame(spark, "runs"), self.frame(spark, "run_dumps")
        source = None
        if not force and R.newest_success(runs, manifest).count():
            expected = spark.createDataFrame([(e, i, CONTRACT_REVISIONS[e]) for e, i in ids.items()], "entity_type string, dump_id bigint, expected_revision int")
            failed = run_dumps.join(runs.filter("status = 'failed'").selectExpr("id as import_run_id", "id", "completed_at as at"), "import_run_id").selectExpr("entity_type", "id", "at as completed_at")
            verdict = R.compatibility_summary(R.checkpoint_compatibility(expected, points, failed)).first()
            if verdict["compatible_entities"] == verdict["selected_entities"]:
                return {"skip": True, "manifest": manifest}
            if verdict["compatible_entities"]:
                raise PartialImportError(f"import these by themselves: {verdict['incompatible']}")
        elif not force:
            found = R.resumable_runs(runs, run_dumps, self.frame(spark, "chunks"), points, CONTRACT_REVISIONS, manifest, chunk_size, len(dumps)).limit(1).collect()
            source = found[0]["id"] if found else None
        run_id = self.next_id("runs")
        stored = {r["entity_type"] for r in points.select("entity_type").collect()}
        self.tables["runs"].append({"id": run_id, "manifest": manifest, "status": "running", "completed_at": None, "force_requested": force, "failure": None})
        for e, i in ids.items():
            self.tables["run_dumps"].append({"import_run_id": run_id, "entity_type": e, "dump_id": i, "revision": CONTRACT_REVISIONS[e], "chunk_size": chunk_size, "processed_items": 0, "total_items": None, "total_chunks": None, "completed_at": None})
        if source is not None:
            self.replace("run_dumps", R.copy_progress(self.frame(spark, "run_dumps"), source, run_id))
        complete = [r["entity_type"] for r in self.tables["run_dumps"] if r["import_run_id"] == run_id and r["completed_at"]]
        for c in self.tables["chunks"]:
            if c["import_run_id"] == source and c["entity_type"] in complete:
                c["import_run_id"] = run_id
        for e in ids:
            if e not in complete:
                self.set_state(e, "importing", run_id, "refresh" if e in stored else "bootstrap")
        return {"skip": False, "run": run_id, "manifest": manifest, "complete": complete}

    def set_state(self, entity: str, state: str, run_id: int, operation: str | None = None) -> None:
        """C4: importing, ready or failed, of a bootstrap (nothing stored before) or a refresh. Only the run that is importing may end it."""
        rows = self.tables["states"]
        old = next((r for r in rows if r["entity_type"] == entity), None)
        if operation is None:
            if old is None or old["import_run_id"] != run_id:
                return
            operation = old["operation"]
        at = dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat()
        self.tables["states"] = [r for r in rows if r is not old] + [{"entity_type": entity, "state": state, "operation": operation, "import_run_id": run_id, "changed_at": at}]

    def fence(self, run_id: int) -> None:
        """Raise unless the run is still the running one in the file."""
        with open(self.path) as f:
            stored = json.load(f)["runs"]
        if not any(r["id"] == run_id and r["status"] == "running" for r in stored):
            raise RuntimeError(f"import run {run_id} isn't running any more")

    def finish_entity(self, spark: SparkSession, run_id: int, entity: str, chunks: DataFrame, total: int) -> None:
        """Record the chunks counted from an entity's records; by the ledger they must cover its ``total`` items exactly."""
        size = self._size(run_id, entity)
        tag = lambda df: df.withColumns({"import_run_id": F.lit(run_id).cast("long"), "entity_type": F.lit(entity)})
        with self.change():
            ledger = self.frame(spark, "chunks")
            merged = record_chunks(ledger, tag(chunks.select("chunk_index", "first_item_index", "item_count")), self.frame(spark, "runs"))
            run = spark.createDataFrame([(run_id, entity, size, total, -(-total // size))], "import_run_id long, entity_type string, chunk_size long, total_items long, total_chunks long")
            verdict = coverage(merged, run).first()
            if not verdict["complete"]:
                raise RuntimeError(f"chunks of {entity} don't cover its {total} items: {verdict['n_chunks']} chunks of {verdict['n_items']} items")
            self.replace("chunks", merged)
            row = self._row(run_id, entity)
            row |= {"processed_items": total, "total_items": total, "total_chunks": verdict["n_chunks"], "completed_at": dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat()}
            self.set_state(entity, "ready", run_id)

    def finish(self, spark: SparkSession, run_id: int, failure: str | None = None) -> None:
        """Success needs every entity complete; then the chunks of failed runs that it supersedes go."""
        with self.change():
            mine = [r for r in self.tables["run_dumps"] if r["import_run_id"] == run_id]
            if failure is None and any(r["completed_at"] is None for r in mine):
                raise RuntimeError("an entity of the run isn't complete")
            row = next(r for r in self.tables["runs"] if r["id"] == run_id)
            row |= {"status": "failed" if failure else "success", "completed_at": dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat(), "failure": failure}
            for r in mine:
                if failure is not None and r["completed_at"] is None:
                    self.set_state(r["entity_type"], "failed", run_id)
            if failure is None:
                superseded = R.superseded_failures(self.frame(spark, "runs"), self.frame(spark, "run_dumps"), self.checkpoints(spark))
                self.replace("chunks", R.prune_chunks(self.frame(spark, "chunks"), superseded))

    def _row(self, run_id: int, entity: str) -> dict:
        return next(r for r in self.tables["run_dumps"] if (r["import_run_id"], r["entity_type"]) == (run_id, entity))

    def _size(self, run_id: int, entity: str) -> int:
        return self._row(run_id, entity)["chunk_size"]


class Progress:
    """K6/C17: progress records as JSON lines, at most one in ``interval`` seconds and entity; failures to write are ignored."""

    def __init__(self, write: Callable[[str], object], interval: float = 5.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.write, self.interval, self.clock, self.last, self.start, self.high = write, interval, clock, {}, clock(), {}

    def report(self, entity: str, done: int, total: int, force: bool = False) -> None:
        now = self.clock()
        if not force and now - self.last.get(entity, -1e18) < self.interval:
            return
        self.last[entity] = now
        self.high[entity] = done = min(max(done, self.high.get(entity, 0)), total)
        percent = 100.0 if total == 0 else int(done * 10000 / total + 0.5) / 100
        try:
            self.write(json.dumps({"entity": entity, "done": done, "total": total, "percent": percent, "elapsed": round(now - self.start, 2)}))
        except Exception:  # noqa: BLE001
            pass
