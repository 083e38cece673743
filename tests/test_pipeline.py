import json
import os
import subprocess
import sys
import time
from pathlib import Path

import fixtures
import pytest
from pyspark.sql import functions as F

from cratework.cli import parse
from cratework.operators.dedupe import count_windows
from cratework.plans import control as C
from cratework.plans.pipeline import ImportConfig, numbered, run_import
from cratework.plans.registry import DEPENDENCIES, TABLES, key_columns
from cratework.plans.store import Store
from cratework.plans.transforms import release_formats
from cratework.sources.xml import read_entity
from cratework.streaming.chunks import insert_stream


def config(tmp_path, date="2024-01-01", sub="a", observed="2024-02-01 00:00:00", **texts):
    folder = tmp_path / sub
    folder.mkdir(exist_ok=True)
    base = {"artist": fixtures.ARTISTS, "label": fixtures.LABELS, "master": fixtures.MASTERS, "release": fixtures.releases(extra=fixtures.RELEASE_1002)} | texts
    dumps = {}
    for e, t in base.items():
        if t is not None:
            path, checksum = fixtures.write(folder, e, t)
            dumps[e] = (path, date, checksum)
    return ImportConfig(str(tmp_path / "store"), dumps, chunk_size=2, observed_at=observed)


def state(store):
    return {n: sorted(repr(tuple(r)) for r in store.read(n).select(*sorted(store.read(n).columns)).collect()) for n in TABLES if store.read(n) is not None}


def values(store, table, *columns):
    return sorted((tuple(r) for r in store.read(table).select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def imported(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("import")
    run_import(spark, config(tmp))
    return tmp, Store(spark, str(tmp / "store"))


def test_rows_of_all_tables(imported):
    _, s = imported
    assert values(s, "artist", "id", "name", "profile") == [(1, "Nola Quist", None), (2, "Second & Co", None), (3, "Third", "line one\nline two"), (4, "Fourth", None)]
    assert values(s, "artist_url", "artist_id", "url") == [(1, "http://nola.example")]
    assert len({r[0] for r in values(s, "artist_name_variation", "hash")}) == 2
    assert values(s, "artist_alias", "artist_id", "alias_id") == [(1, 2), (2, 1)]
    assert values(s, "artist_group", "artist_id", "group_id") == [(2, 3)]
    assert values(s, "artist_member", "artist_id", "member_id") == [(1, 3)]
    assert values(s, "label", "id", "contact_info") == [(10, None), (11, None), (12, None)]
    assert values(s, "label_sub_label", "parent_label_id", "sub_label_id") == [(10, 11)]
    assert values(s, "master_style", "master_id", "style") == [(100, "Drone")]
    assert values(s, "master_artist", "master_id", "artist_id") == [(100, 1)]
    assert len(values(s, "master_video", "hash")) == 1
    assert values(s, "master", "id", "main_release_id", "year") == [(100, 1000, 1999), (101, 1002, None), (102, None, None)]
    assert values(s, "genre", "name") == [("Folk",)] and values(s, "style", "name") == [("Drone",)]
    got = values(s, "release_item", "id", F.col("release_date").cast("string"), "has_valid_month", "has_valid_day", "master_id", "is_master", "listed_release_date")
    assert got == [(1000, "1999-03-01", True, False, 100, True, "1999-03-00"), (1001, None, False, False, None, True, "x"), (1002, "2010-03-22", True, True, 101, True, "100322")]
    assert values(s, "label_release_item", "label_id", "category_notation") == sorted([(10, None), (10, "QX 311"), (10, "QX311")], key=repr)
    for t, n in {"release_item_artist": 1, "release_item_credited_artist": 1, "release_item_work": 1, "release_item_genre": 1, "release_item_style": 1, "release_item_identifier": 1, "release_item_track": 3, "release_item_video": 1, "release_item_format": 2}.items():
        assert s.read(t).count() == n, t
    assert values(s, "release_item_format", "name", "description", "quantity", "quantity_text") == [("CD", "[d:Album]", 2, "2"), ("LP", None, None, "99999999999999999999")]
    hashes = [r[0] for r in values(s, "release_item_track", "hash")]
    assert len(set(hashes)) == 3 and -942642753 in hashes


def test_same_dump_again_changes_nothing(spark, imported):
    tmp, s = imported
    before = state(s)
    assert run_import(spark, config(tmp))["skip"]
    forced = config(tmp, observed="2024-03-01 00:00:00")
    forced.force = True
    assert not run_import(spark, forced)["skip"]
    assert state(s) == before


def test_new_dump_converges(spark, imported, tmp_path):
    run_import(spark, config(tmp_path))
    s = Store(spark, str(tmp_path / "store"))
    before = dict(values(s, "release_item_track", "title", F.col("last_modified_at").cast("string")))
    labels = values(s, "label_release_item", "release_item_id", "category_notation", "last_modified_at")
    nxt = config(tmp_path, date="2024-02-01", sub="b", observed="2024-03-01 00:00:00", release=fixtures.releases(track="Two", main="false"))
    run_import(spark, nxt)
    after = dict(values(s, "release_item_track", "title", F.col("last_modified_at").cast("string")))
    assert set(after) == {"Aa tone", "BB tone", "Two"} and after["Aa tone"] == before["Aa tone"] and after["Two"] == "2024-03-01 00:00:00"
    assert values(s, "label_release_item", "release_item_id", "category_notation", "last_modified_at") == labels
    got = dict(values(s, "release_item", "id", F.col("last_modified_at").cast("string")))
    assert got == {1000: "2024-03-01 00:00:00", 1001: "2024-02-01 00:00:00", 1002: "2024-02-01 00:00:00"}
    assert values(s, "release_item_format", "name") == [("CD",), ("LP",)]
    assert values(s, "master", "id", "main_release_id") == [(100, None), (101, 1002), (102, None)]
    with pytest.raises(C.DowngradeError):
        run_import(spark, config(tmp_path, date="2023-12-01", sub="c", artist=fixtures.ARTISTS + "<!-- x -->"))


def test_missing_dependency(spark, tmp_path):
    with pytest.raises(C.DependencyError, match="artist: missing"):
        run_import(spark, config(tmp_path, artist=None, label=None, release=None))


@pytest.mark.parametrize("bad", [fixtures.releases().replace('qty="0002"', 'qty="2x"'), fixtures.releases()[:-400], fixtures.releases().replace("<id>2</id>", "<id>two</id>")])
def test_bad_records_fail(spark, tmp_path, bad):
    path, _ = fixtures.write(tmp_path, "release", bad)
    with pytest.raises(Exception):
        raw = read_entity(spark, path, "release")
        raw.write.parquet(str(tmp_path / "raw"))
        release_formats(spark.read.parquet(str(tmp_path / "raw"))).collect()


def test_failed_run_resumes(spark, tmp_path):
    run = config(tmp_path, label=None, master=fixtures.MASTERS[:-300], release=None)
    for _ in range(2):
        with pytest.raises(Exception):
            run_import(spark, run)
    s = Store(spark, str(tmp_path / "store"))
    assert s.read("artist").count() == 4 and s.read("master") is None
    control = json.loads((tmp_path / "store" / "control.json").read_text())
    assert [r["status"] for r in control["runs"]] == ["failed", "failed"] and not os.listdir(tmp_path / "store" / "locks")
    assert {r["entity_type"]: r["import_run_id"] for r in control["run_dumps"] if r["completed_at"] and r["import_run_id"] == 2} == {"artist": 2}


def test_conflicting_roots(spark, tmp_path):
    twice = fixtures.ARTISTS.replace("</artists>", "<artist><id>4</id><name>Other</name></artist></artists>")
    with pytest.raises(Exception, match="artist: conflicting rows"):
        run_import(spark, config(tmp_path, artist=twice, label=None, master=None, release=None))


def test_locks(tmp_path):
    assert C.lock_entities(["release"]) == ["artist", "label", "master", "release"] and C.lock_entities(["master"]) == ["artist", "master"]
    with C.entity_locks(str(tmp_path), ["artist"]):
        with pytest.raises(FileExistsError), C.entity_locks(str(tmp_path), ["master"]):
            pass
    with C.entity_locks(str(tmp_path), ["release"]):
        assert len(os.listdir(tmp_path)) == 4
    assert os.listdir(tmp_path) == []


def test_locks_of_a_killed_process_are_taken(tmp_path):
    code = "import os, sys; sys.path.insert(0, sys.argv[2]); from cratework.plans import control as C; held = C.entity_locks(sys.argv[1], ['label']); held.__enter__(); os._exit(9)"
    subprocess.run([sys.executable, "-c", code, str(tmp_path), str(Path(__file__).parent.parent)], check=False)
    assert os.listdir(tmp_path) == ["label.lock"]
    with pytest.raises(FileExistsError), C.entity_locks(str(tmp_path), ["label"]):
        pass
    time.sleep(0.3)
    with C.entity_locks(str(tmp_path), ["label"], lease=0.2):
        time.sleep(0.5)  # renewed meanwhile
        with pytest.raises(FileExistsError), C.entity_locks(str(tmp_path), ["label"], lease=0.2):
            pass
    assert os.listdir(tmp_path) == []


def test_only_runs_of_the_same_entities_are_abandoned(spark, tmp_path):
    control = C.Control(str(tmp_path / "control.json"))
    dump = lambda e: [{"entity_type": e, "dump_date": "2024-01-01", "checksum": "a" * 64}]
    one = control.admit(spark, dump("artist"), 5)["run"]
    two = C.Control(str(tmp_path / "control.json")).admit(spark, dump("label"), 5)["run"]
    control.fence(one), control.fence(two)
    three = control.admit(spark, dump("artist"), 5)["run"]
    with pytest.raises(RuntimeError):
        control.fence(one)
    control.fence(two), control.fence(three)
    assert {r["entity_type"]: (r["state"], r["operation"], r["import_run_id"]) for r in control.tables["states"]} == {"artist": ("importing", "bootstrap", 3), "label": ("importing", "bootstrap", 2)}
    control.finish(spark, three, "broken")
    assert {r["entity_type"]: r["state"] for r in control.tables["states"]} == {"artist": "failed", "label": "importing"}


def test_ledger_must_cover_the_items(spark, tmp_path):
    control = C.Control(str(tmp_path / "control.json"))
    run = control.admit(spark, [{"entity_type": "label", "dump_date": "2024-01-01", "checksum": "a" * 64}], 4)["run"]
    rows = lambda n: count_windows(spark.range(n).withColumnRenamed("id", "row_idx"), "row_idx", 4)
    with pytest.raises(RuntimeError, match="don't cover"):
        control.finish_entity(spark, run, "label", rows(9), 10)
    control.finish_entity(spark, run, "label", rows(10), 10)
    assert sorted((c["chunk_index"], c["item_count"]) for c in control.tables["chunks"]) == [(0, 4), (1, 4), (2, 2)]
    control.finish(spark, run)


def catalogue(folder, checksum=None):
    """A local copy of a catalogue with dumps of two months and one manifest each."""
    lines, links = {}, []
    for day in ("20240101", "20240201"):
        (folder / "data" / "2024").mkdir(parents=True, exist_ok=True)
        for kind, text in (("artists", fixtures.ARTISTS), ("labels", fixtures.LABELS)):
            path, good = fixtures.write(folder / "data" / "2024", f"dumps_{day}_{kind}", text)
            os.rename(path, folder / "data" / "2024" / f"dumps_{day}_{kind}.xml.gz")
            lines.setdefault(day, []).append(f"{checksum or good} *dumps_{day}_{kind}.xml.gz")
            links.append(f'<a href="?download=data%2F2024%2Fdumps_{day}_{kind}.xml.gz">x</a>')
        (folder / "data" / "2024" / f"dumps_{day}_CHECKSUM.txt").write_text("\n".join(lines[day]))
        links.append(f'<a href="?download=data%2F2024%2Fdumps_{day}_CHECKSUM.txt">x</a>')
    (folder / "data" / "index.html").write_text('<a href="?prefix=data/2023/">a</a> <a href="?prefix=data/2024/">b</a>')
    (folder / "data" / "2024" / "index.html").write_text(" ".join(links))
    return str(folder)


def test_import_from_a_catalogue(spark, tmp_path):
    base = catalogue(tmp_path / "web")
    args = ["--store", str(tmp_path / "store"), "--catalogue", base, "--data-dir", str(tmp_path / "data"), "-e", "artists", "label"]
    assert not run_import(spark, parse([*args, "-m", "2024-01"]))["skip"]
    assert sorted(os.listdir(tmp_path / "data")) == ["dumps_20240101_artists.xml.gz", "dumps_20240101_labels.xml.gz"]
    run_import(spark, parse([*args, "--cleanup"]))  # the latest of each
    assert sorted(os.listdir(tmp_path / "data")) == ["dumps_20240101_artists.xml.gz", "dumps_20240101_labels.xml.gz"]
    control = C.Control(str(tmp_path / "store" / "control.json"))
    assert {(d["entity_type"], d["dump_date"]) for d in control.tables["dumps"]} == {(e, d) for e in ("artist", "label") for d in ("2024-01-01", "2024-02-01")}
    assert {r["entity_type"]: (r["state"], r["operation"]) for r in control.tables["states"]} == {"artist": ("ready", "refresh"), "label": ("ready", "refresh")}
    os.rename(tmp_path / "web", tmp_path / "gone")  # the stored catalogue and the files serve without it
    assert run_import(spark, parse([*args, "-m", "2024-01", "--allow-downgrade", "--force"]))["run"] == 3
    with pytest.raises(FileNotFoundError):
        run_import(spark, parse([*args, "-m", "2024-03"]))


def test_wrong_checksums_are_refused(spark, tmp_path):
    base = catalogue(tmp_path / "web", "0" * 64)
    with pytest.raises(ValueError, match="checksum mismatch"):
        run_import(spark, parse(["--store", str(tmp_path / "store"), "--catalogue", base, "--data-dir", str(tmp_path / "data"), "-e", "label"]))
    path, _ = fixtures.write(tmp_path, "label", fixtures.LABELS)
    with pytest.raises(ValueError, match="checksum mismatch"):
        run_import(spark, ImportConfig(str(tmp_path / "store"), {"label": (path, "2024-01-01", "0" * 64)}))
    assert Store(spark, str(tmp_path / "store")).versions() == {}


def test_layout_of_a_store(spark, tmp_path):
    Store(spark, str(tmp_path))
    (tmp_path / "LAYOUT").write_text("0")
    with pytest.raises(RuntimeError, match="layout"):
        Store(spark, str(tmp_path))


def test_fence_stops_publishing(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    v = s.stage("t", spark.range(3))

    def fence():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        s.publish({"t": v}, fence)
    assert s.read("t") is None and s.versions() == {}


def test_config_validation():
    ok = ("x.xml.gz", "2024-01-01", "a" * 64)
    ImportConfig("s", {"artist": ok}).validate()
    for bad in ({}, {"series": ok}, {"artist": ("x", "2008-02-01", "a" * 64)}, {"artist": ("x", "2999-01-01", "a" * 64)}, {"artist": ("http://x", "2024-01-01", "a" * 64)}, {"artist": ("x", "2024-01-01", "zz")}):
        with pytest.raises(ValueError):
            ImportConfig("s", bad).validate()
    with pytest.raises(ValueError):
        ImportConfig("s", {"artist": ok}, chunk_size=0).validate()
    got = parse(["--store", "d", "--dump", "Artists=/p,q.xml.gz,2024-01-01," + "a" * 64, "-b", "7", "--force"])
    assert got.dumps == {"artist": ("/p,q.xml.gz", "2024-01-01", "a" * 64)} and got.chunk_size == 7 and got.force


def test_progress():
    out, now = [], [0.0]
    p = C.Progress(out.append, 5, lambda: now[0])
    for t, done in ((0, 1), (1, 5), (6, 4), (12, 50)):
        now[0] = t
        p.report("artist", done, 10)
    assert [json.loads(x)["done"] for x in out] == [1, 4, 10] and json.loads(out[-1])["percent"] == 100.0
    C.Progress(lambda _: 1 / 0).report("a", 0, 0)


def test_numbered_keeps_source_order(spark, tmp_path):
    path, _ = fixtures.write(tmp_path, "artist", fixtures.ARTISTS)
    assert [tuple(r) for r in numbered(read_entity(spark, path, "artist")).select("row_idx", "id").orderBy("row_idx").collect()] == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert sorted(r[0] for r in numbered(spark.range(100).repartition(7)).select("row_idx").collect()) == list(range(100))


def test_stream_insert(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string").write.parquet(str(src))
    s = Store(spark, str(tmp_path / "store"))
    for _ in range(2):
        stream = spark.readStream.schema("k int, v string").parquet(str(src))
        insert_stream(stream, s, "t", ["k", "v"], str(tmp_path / "cp"), ["v"]).awaitTermination()
        spark.createDataFrame([(2, None), (3, "c")], "k int, v string").write.mode("append").parquet(str(src))
    assert values(s, "t", "k", "v") == sorted([(1, "a"), (2, None), (3, "c")], key=repr)


def test_registry():
    assert len(TABLES) == 28 and key_columns("artist_url") == ("artist_id", "hash") and set(DEPENDENCIES) == {t.entity for t in TABLES.values()}
    assert TABLES["release_item_track"].match == ("release_item_id", "hash", "identity_sha256")
