import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cratework.functions.hashing import CATALOGUE_DOMAIN
from cratework.operators import converge, dedupe, slots
from cratework.plans import ledger, relational_queries, runs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_keyed_dedupe(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 3), (2, None, 1), (2, None, 2), (None, "n", 1)], "k int, v string, at int")
    assert rows(dedupe.keyed_dedupe(df, ["k"], ["v"], "at")) == [(1, "a", 3), (2, None, 1), (None, "n", 1)]
    bad = df.union(spark.createDataFrame([(2, "x", 9)], df.schema))
    assert rows(dedupe.conflicts(bad, ["k"], ["v"])) == [(2, 3)]
    with pytest.raises(dedupe.ConflictError, match="things.*k"):
        dedupe.keyed_dedupe(bad, ["k"], ["v"], name="things")
    with pytest.raises(Exception, match="conflicting rows"):
        dedupe.keyed_dedupe(bad, ["k"], ["v"], name="things", check=False).collect()
    assert dedupe.keyed_dedupe(df.limit(0), ["k"]).count() == 0


def test_newest_per_group_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 5, 1), (1, 5, 2), (None, 1, 3), (2, None, 4)], "g int, o int, v int")
    assert rows(dedupe.newest_per_group(df, ["g"], [F.col("o")], ["v"])) == sorted([(1, 2), (None, 3), (2, 4)], key=repr)


def test_audits(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, 3, 2, 2, 5, None, 4])], "i int, v int")
    plain = rows(dedupe.not_increasing(df, "i", "v").select("i", "v", "previous"))
    assert plain == [(2, 2, 3), (3, 2, 2)]
    assert rows(dedupe.not_increasing(df.repartition(3), "i", "v").select("i", "v", "previous")) == plain
    a = dedupe.audit_duplicates(df.union(df), df, [])
    assert rows(a) == [(14, 7, 7)]
    assert rows(dedupe.count_windows(df, "i", 3)) == [(0, 3, 0), (1, 3, 3), (2, 1, 6)]


def brute_slots(group):
    reserved, given, out, first = {h for h, _ in group}, set(), {}, set()
    for h, d in sorted(group):
        if h not in first:
            first.add(h)
            out[d] = h
        else:
            k = 0
            while (s := slots.slot_of(CATALOGUE_DOMAIN, "r", d, k)) in reserved | given:
                k += 1
            given.add(s)
            out[d] = s
    return out


def test_slot_allocation(spark):
    rng = random.Random(2)
    data = [(rng.randrange(5), rng.randrange(4), rng.randbytes(32)) for _ in range(60)] + [(9, 1, b"\xff" * 32), (9, 2, b"\x00" * 32)]
    df = spark.createDataFrame(data, "s int, h int, d binary")
    got = {(r["s"], bytes(r["d"])): r["slot"] for r in slots.allocate_slots(df, ["s"], "h", "d", CATALOGUE_DOMAIN, "r").collect()}
    for s in {x[0] for x in data}:
        want = brute_slots([(h, d) for t, h, d in data if t == s])
        assert {d: v for (t, d), v in got.items() if t == s} == want
        assert len(set(want.values())) == len(want)
    assert slots.allocate_slots(df.limit(0), ["s"], "h", "d", CATALOGUE_DOMAIN, "r").count() == 0


def test_slots_avoid_taken(spark, monkeypatch):
    """Candidates that are reserved or go to rows before them send rows on, over several rounds."""
    monkeypatch.setattr(slots, "compat_slot", lambda dom, rel, d, k: (F.ascii(F.decode(d, "UTF-8")) % 3 + k).cast("int"))
    monkeypatch.setattr(slots, "slot_of", lambda dom, rel, d, k: d[0] % 3 + k)
    data = [(s, h, bytes([97 + i])) for s in (1, 2) for i, h in enumerate([0, 0, 0, 2, 2, 5, 5, 5, 5, 9][: 10 if s == 1 else 6])]
    df = spark.createDataFrame(data, "s int, h int, d binary")
    got = {(r["s"], bytes(r["d"])): r["slot"] for r in slots.allocate_slots(df, ["s"], "h", "d", CATALOGUE_DOMAIN, "r").collect()}
    for s in (1, 2):
        assert {d: v for (t, d), v in got.items() if t == s} == brute_slots([(h, d) for t, h, d in data if t == s])


def test_upsert(spark):
    s = spark.createDataFrame([(1, "a", None, 10, 1), (2, "b", "x", 10, 1), (3, None, None, 10, 1)], "id int, n string, p string, made int, seen int")
    i = spark.createDataFrame([(1, "a", None, 99, 2), (2, "b", None, 99, 2), (4, "d", None, 99, 2)], s.schema)
    out = converge.upsert_if_changed(s, i, "id", ["n", "p"], "seen", status=True)
    assert rows(out) == [(1, "a", None, 10, 1, "unchanged"), (2, "b", None, 10, 2, "updated"), (3, None, None, 10, 1, "retained"), (4, "d", None, 99, 2, "inserted")]
    again = converge.upsert_if_changed(out.drop("status"), i, "id", ["n", "p"], "seen", status=True)
    assert {r[-1] for r in rows(again)} == {"unchanged", "retained"}


def test_converge_relation(spark):
    s = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (1, None, 1), (2, "a", 1), (3, "z", 1)], "r int, k string, at int")
    i = spark.createDataFrame([(1, "b", 2), (1, "c", 2), (1, None, 2)], s.schema)
    roots = spark.createDataFrame([(1,), (3,)], "r int")
    safe = rows(converge.converge_relation(s, i, roots, "r", ["r", "k"], ["k"]))
    assert safe == sorted([(2, "a", 1), (1, "b", 1), (1, None, 1), (1, "c", 2)], key=repr)
    plain = rows(converge.converge_relation(s, i, roots, "r", ["r", "k"]))
    assert plain == sorted([(2, "a", 1), (1, "b", 1), (1, None, 2), (1, "c", 2)], key=repr)
    assert rows(converge.stale_rows(s, i, roots, "r", ["r", "k"], ["k"])) == [(1, "a", 1), (3, "z", 1)]
    assert rows(converge.converge_relation(s, i.limit(0), roots, "r", ["r", "k"])) == [(2, "a", 1)]
    assert rows(converge.converge_relation(s, i, roots.limit(0), "r", ["r", "k"])) == sorted([*rows(s), (1, "c", 2), (1, None, 2)], key=repr)
    twice = converge.converge_relation(converge.converge_relation(s, i, roots, "r", ["r", "k"], ["k"]), i, roots, "r", ["r", "k"], ["k"])
    assert rows(twice) == safe


def test_known_ids(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, None), (4, 7), (5, -1)], "i int, x int")
    known = spark.createDataFrame([(5,), (0,), (-1,), (None,)], "id int")
    assert rows(converge.keep_known(df, "x", known)) == [(1, 5)]
    assert [r[1] for r in rows(converge.null_unknown(df, "x", known))] == [5, None, None, None, None]
    assert rows(converge.insert_or_ignore(known.limit(1), known, ["id"])) == sorted([(5,), (0,), (-1,), (None,)], key=repr)


def test_backlinks(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    masters = spark.createDataFrame([(1, None), (2, 20), (3, 30), (4, 40), (5, 50)], "id int, main int")
    kids = spark.createDataFrame(
        [(10, 1, True, at(1)), (11, 1, True, at(1)), (20, 2, False, at(5)), (30, 3, True, at(1)), (31, 3, True, at(2)), (40, 4, True, None), (50, 5, None, at(1)), (60, None, True, at(9))],
        "id int, m int, ok boolean, at timestamp",
    )
    ok = F.coalesce(F.col("ok"), F.lit(False))
    args = ("id", "main", "m", "id", [F.col("at")], ok)
    out = converge.reconcile_backlinks(masters, kids, *args, status=True)
    assert rows(out) == [(1, 11, "set"), (2, None, "cleared"), (3, 31, "moved"), (4, 40, "unchanged"), (5, None, "cleared")]
    assert {r[2] for r in rows(converge.reconcile_backlinks(out.drop("status"), kids, *args, status=True))} == {"unchanged"}
    assert rows(converge.stale_backlinks(masters, kids, "id", "main", "m", "id", ok)) == [(2, 20), (5, 50)]


def test_ledger(spark):
    chunks = spark.createDataFrame([(1, "artist", 0, 0, 5), (1, "artist", 1, 5, 3), (2, "artist", 0, 0, 5), (2, "artist", 1, 6, 2), (3, "label", 0, 0, 4)], "import_run_id long, entity_type string, chunk_index long, first_item_index long, item_count long")
    want = spark.createDataFrame([(1, "artist", 5, 8, 2), (2, "artist", 5, 8, 2), (3, "label", 5, 9, 2), (4, "label", 5, 0, 0)], "import_run_id long, entity_type string, chunk_size long, total_items long, total_chunks long")
    got = {r["import_run_id"]: r["complete"] for r in ledger.coverage(chunks, want).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}
    running = spark.createDataFrame([(1, "running"), (3, "failed")], "id long, status string")
    new = spark.createDataFrame([(1, "artist", 0, 0, 5), (1, "artist", 2, 10, 1), (3, "label", 1, 5, 5)], chunks.schema)
    assert ledger.record_chunks(chunks, new, running).count() == 6
    assert rows(ledger.pending_chunks(new, chunks).select("import_run_id", "chunk_index")) == [(1, 2), (3, 1)]
    moved = spark.createDataFrame([(1, "artist", 1, 5, 4)], chunks.schema)
    assert ledger.range_mismatches(moved, chunks).count() == 1 and ledger.range_mismatches(chunks, chunks).count() == 0


def test_dependency_states(spark):
    d = dt.date
    needs = spark.createDataFrame([(e, d(2024, 2, 1)) for e in "abcdef"], "entity_type string, horizon date")
    done = spark.createDataFrame(
        [("a", d(2024, 1, 1), " AB ", 1, 1), ("b", d(2023, 12, 1), "x", 1, 1), ("c", d(2024, 1, 1), "old", 1, 1), ("d", d(2024, 3, 1), "x", 1, 1), ("e", d(2024, 1, 1), "x", 1, 1)],
        "entity_type string, dump_date date, checksum string, completed_at int, import_run_id int",
    )
    dumps = spark.createDataFrame([(i, e, d(2024, 1, 1), "ab") for i, e in enumerate("abcdf")] + [(9, "e", d(2024, 5, 1), "x")], "id int, entity_type string, dump_date date, checksum string")
    got = {r["entity_type"]: r["state"] for r in runs.dependency_states(needs, done, dumps).collect()}
    assert got == {"a": "fine", "b": "stale", "c": "reissued", "d": "newer", "e": "no provenance", "f": "missing"}


def test_entity_normalise_takes_all_rows(spark, tmp_path):
    spark.createDataFrame([(1, " Gloss "), (2, "releases"), (3, None), (4, "S")], "doc_id long, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = relational_queries.entity_normalise(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "glos"), (2, "release"), (4, "")]
