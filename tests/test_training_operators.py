"""p1-p6: brute force on small random tables, and the edge cases the docstrings define."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cratework.functions.text import trim_to_null
from cratework.operators import hierarchy, hot_keys, orphans, shred, skew, snapshots
from cratework.plans import training_queries

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# shredding

NESTED = "id int, name string, group string, urls struct<url:array<string>>, orders array<struct<no:int, items:array<struct<sku:string, tags:array<string>>>>>"


def nested(spark):
    return spark.createDataFrame(
        [
            (1, "a", "g", (["x", None, ""],), [(7, [("s", ["t", "u"]), ("r", None)]), (8, None), None]),
            (2, None, None, None, []),
            (3, "c", "h", (None,), None),
            (1, "a", "g", (["x", None, ""],), None),
        ],
        NESTED,
    )


def test_shred_levels(spark):
    t = shred.shred(nested(spark), ["id"])
    assert set(t) == {"", "urls.url", "orders", "orders.items", "orders.items.tags"}
    assert rows(t["urls.url"]) == sorted([(1, 1, "x"), (1, 2, None), (1, 3, "")] * 2, key=repr)
    assert rows(t["orders"]) == [(1, 1, 7), (1, 2, 8), (1, 3, None)]
    assert rows(t["orders.items"]) == [(1, 1, 1, "s"), (1, 1, 2, "r")]
    assert rows(t["orders.items.tags"]) == [(1, 1, 1, 1, "t"), (1, 1, 1, 2, "u")]
    assert t[""].columns == ["id", "name", "group"] and t[""].count() == 4


def test_shred_links_and_triples(spark):
    t = shred.triples(nested(spark), ["id"])
    assert (1, "orders.items", [1, 2], "sku", "r") in rows(t)
    assert shred.triples(nested(spark).limit(0), ["id"]).count() == 0
    assert shred.shred(spark.createDataFrame([(1, "x")], "id int, a string"), ["id"]).keys() == {""}


def test_shred_plan_has_no_shuffle(spark):
    plan = shred.shred(nested(spark), ["id"])["orders.items"]._jdf.queryExecution().toString()
    assert "Exchange" not in plan


# orphans


def brute_orphans(refs, targets, match):
    out = []
    for r in refs:
        key, mask = r[1:], [x is None for x in r[1:]]
        if all(mask) or (any(mask) and match == "simple"):
            continue
        if any(mask) and match == "full":
            out.append(r)
            continue
        if not any(all(m or (a == b) for a, b, m in zip(key, t, mask)) for t in targets):
            out.append(r)
    return sorted(out, key=repr)


@pytest.mark.parametrize("match", orphans.MATCHES)
def test_orphans_brute(spark, match):
    rng = random.Random(match)
    pick = lambda: rng.choice([None, 1, 2, 3, 4])
    refs = [(i, pick(), pick()) for i in range(300)] + [(900 + i % 3, 9, 9) for i in range(300)]
    targets = [(pick(), pick()) for _ in range(8)]
    r, t = spark.createDataFrame(refs, "k int, a int, b int"), spark.createDataFrame(targets, "k int, a int")
    got = rows(orphans.orphan_references(r, t, [("a", "k"), ("b", "a")], match))
    assert got == brute_orphans(refs, targets, match)
    empty = orphans.orphan_references(r, t.limit(0), [("a", "k"), ("b", "a")], match)
    assert rows(empty) == brute_orphans(refs, [], match)
    assert orphans.orphan_references(r.limit(0), t, [("a", "k"), ("b", "a")], match).count() == 0


def test_orphan_report(spark):
    df = spark.createDataFrame([("t", 1, 5), ("t", 1, 5), ("t", 1, 6), ("u", None, 7)], "tab string, p int, k int")
    assert rows(orphans.orphan_report(df, ["tab", "p"], ["k"])) == [("t", 1, 3, 2), ("u", None, 1, 1)]
    with pytest.raises(ValueError):
        orphans.orphan_references(df, df, [("k", "k")], "loose")


# snapshots


def test_snapshots(spark):
    a, b, c = D(2024, 1, 1), D(2024, 2, 1), D(2024, 4, 1)
    data = [(a, 1, "x", None), (a, 1, " x ", ""), (a, 2, "y", "p"), (b, 1, "x", " "), (b, 3, "z", None), (c, 2, "y", "p"), (c, 3, "z", "q"), (None, 9, "n", None), (c, None, "k", None), (c, 3, "z", "q")]
    df = spark.createDataFrame(data, "d date, id int, name string, profile string")
    got = rows(snapshots.snapshot_changes(df, "d", ["id"], [trim_to_null("name"), trim_to_null("profile")]))
    assert got == sorted([(b, 2, "removed"), (b, 3, "added"), (c, 1, "removed"), (c, 2, "added"), (c, 3, "changed"), (c, None, "added")], key=repr)
    all_rows = rows(snapshots.snapshot_changes(df, "d", ["id"], [trim_to_null("name"), trim_to_null("profile")], unchanged=True))
    assert (b, 1, "unchanged") in all_rows
    for part in (df.limit(0), df.filter(F.col("d") == F.lit(a))):
        assert snapshots.snapshot_changes(part, "d", ["id"], [F.col("name")]).count() == 0


def test_snapshots_any_of_many_versions(spark):
    """Whichever version changes, the least, a middle or the greatest hash, the key is changed."""
    old, data = [f"v{i}" for i in range(7)], []
    for i in range(7):
        new = [*old[:i], f"w{i}", *old[i + 1 :]]
        data += [(D(2024, 1, 1), i, v) for v in old] + [(D(2024, 2, 1), i, v) for v in reversed(new)]
    data += [(D(2024, 1, 1), 9, v) for v in old] + [(D(2024, 2, 1), 9, v) for v in [*reversed(old), "v3"]]
    df = spark.createDataFrame(data, "d date, id int, name string")
    assert rows(snapshots.snapshot_changes(df, "d", ["id"], [F.col("name")])) == [(D(2024, 2, 1), i, "changed") for i in range(7)]


def test_snapshots_one_shuffle(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1, "x"), (D(2024, 2, 1), 1, "y")], "d date, id int, name string")
    plan = snapshots.snapshot_changes(df, "d", ["id"], [F.col("name")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# heavy keys


def test_keyed_summary(spark):
    t = dt.datetime
    data = [(1, 10, t(2024, 1, 1)), (1, 10, t(2024, 1, 3)), (1, None, None), (None, 5, t(2024, 1, 2)), (2, 7, None)]
    df = spark.createDataFrame(data, "k int, m int, at timestamp")
    s = hot_keys.keyed_summary(df, "k", "m", "at")
    assert rows(s) == sorted([(1, 3, 1, t(2024, 1, 3)), (None, 1, 1, t(2024, 1, 2)), (2, 1, 1, None)], key=repr)
    assert rows(hot_keys.heavy_keys(s, df, 0.2).select("key_id")) == [(1,)]
    assert hot_keys.heavy_keys(hot_keys.keyed_summary(df.limit(0), "k", "m", "at"), df.limit(0), 0.02).count() == 0


# hierarchies


def brute_tree(edges):
    children = defaultdict(set)
    for p, c in edges:
        children[p].add(c)
    subs = {c for _, c in edges}
    found = {}
    for r in {p for p, _ in edges} - subs:
        level, depth, seen = {r}, 0, {r}
        found[r, r] = 0
        while level:
            depth += 1
            level = {c for p in level for c in children[p]} - seen
            seen |= level
            for c in level:
                found[r, c] = depth
    reach = {}
    for n in {x for e in edges for x in e}:
        seen, todo = set(), list(children[n])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += children[x]
        reach[n] = seen
    cycles = {n: min(x for x in reach[n] if n in reach[x]) for n in reach if n in reach[n]}
    return found, cycles


@pytest.mark.parametrize("seed", [0, 1])
def test_hierarchy_brute(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(30), rng.randrange(30, 60)) for _ in range(30)] + [(rng.randrange(60, 75), rng.randrange(60, 75)) for _ in range(18)]
    edges += [(30 + i, 61 + i) for i in range(3)] + [(100 + i, 101 + i) for i in range(9)] + [(105, 103), (200, 200), (100, 101)]
    df = spark.createDataFrame([*edges, (None, 5), (7, None)], "p int, c int")
    clean = hierarchy.clean_edges(df, "p", "c")
    f = hierarchy.forest(clean)
    found, cycles = brute_tree(edges)
    nodes = {r["node"]: r for r in f.nodes.collect()}
    assert sorted(r["first"] for r in nodes.values()) == list(range(len(nodes)))
    for v, r in nodes.items():
        if r["up"] is not None:
            up = nodes[r["up"]]
            assert (r["up"], v) in edges and up["depth"] == r["depth"] - 1 and up["first"] < r["first"] and r["first"] + r["size"] <= up["first"] + up["size"]
        assert len([x for x in nodes.values() if r["first"] <= x["first"] < r["first"] + r["size"]]) == r["size"]
    links = {(r["source"], r["to"]): r for r in f.links.collect()}
    assert set(links) == {(p, c) for p, c in edges if nodes[c]["up"] != p} and sorted(r["rank"] for r in links.values()) == list(range(len(links)))
    for v, r in nodes.items():
        inside = {k for k in links if r["first"] <= nodes[k[0]]["first"] < r["first"] + r["size"]}
        assert inside == {k for k, x in links.items() if r["rank"] <= x["rank"] < r["rank"] + r["leaving"]}
    classes = hierarchy.entry_classes(f)
    roots = hierarchy.roots_of(clean)
    reached = hierarchy.reach(f, roots.union(hierarchy.class_starts(classes)), hierarchy.paths(f)).cache()
    tops = {r["node"] for r in roots.collect()}
    got = {(r["start"], r["node"]): r for r in reached.collect()}
    assert {k: r["depth"] for k, r in got.items() if k[0] in tops} == found
    for (start, node), r in got.items():
        assert r["way"][0] == start and r["way"][-1] == node and len(r["way"]) == r["depth"] + 1
        assert all(e in set(edges) for e in zip(r["way"], r["way"][1:]))
    assert {r["node"]: r["least"] for r in hierarchy.cycles(f, classes, reached).collect()} == cycles


def test_hierarchy_empty_and_cycles_only(spark):
    empty = spark.createDataFrame([], "p int, c int")
    f = hierarchy.forest(hierarchy.clean_edges(empty, "p", "c"))
    classes = hierarchy.entry_classes(f)
    reached = hierarchy.reach(f, hierarchy.class_starts(classes))
    assert f.nodes.count() == 0 and f.links.count() == 0 and reached.count() == 0 and hierarchy.cycles(f, classes, reached).count() == 0
    ring = hierarchy.clean_edges(spark.createDataFrame([(1, 2), (2, 1)], "p int, c int"), "p", "c")
    f = hierarchy.forest(ring)
    classes = hierarchy.entry_classes(f)
    assert hierarchy.roots_of(ring).count() == 0
    assert rows(hierarchy.cycles(f, classes, hierarchy.reach(f, hierarchy.class_starts(classes)))) == [(1, 1), (2, 1)]


def test_ranges_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "BLOCK", 4)
    edges = [(0, i) for i in range(1, 23)] + [(i, 100) for i in range(1, 23)] + [(100, 101)]
    clean = hierarchy.clean_edges(spark.createDataFrame(edges, "p int, c int"), "p", "c")
    got = hierarchy.reach(hierarchy.forest(clean), hierarchy.roots_of(clean))
    assert {(r["node"], r["depth"]) for r in got.collect()} == {(0, 0), (100, 2), (101, 3)} | {(i, 1) for i in range(1, 23)}


# Columns and types of the queries whose rows are compared with known cases.
CONTRACT = {
    "p1_found": [("record_id", "bigint"), ("relation", "string"), ("ordinal", "int")],
    "p2_found": [("ref_table", "string"), ("period_date", "string"), ("row_id", "int"), ("target_id", "int")],
    "p3_found": [("snapshot_date", "string"), ("artist_id", "int"), ("change_kind", "string")],
    "p5_found": [("table_name", "string"), ("key_id", "int")],
    "p6_found": [("label_id", "int"), ("root_label_id", "int"), ("depth", "int")],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_of_found(spark, name):
    assert training_queries.QUERIES[name](spark, "/root/testdata/sf0.001").dtypes == CONTRACT[name]


def brute_below(edges):
    """(node, below) -> fewest links, at least one."""
    children = {}
    for p, c in edges:
        children.setdefault(p, set()).add(c)
    found = {}
    for start in children:
        level, depth = {start}, 0
        while level:
            depth += 1
            level = {c for n in level for c in children.get(n, ()) if (start, c) not in found}
            found |= {(start, c): depth for c in level}
    return found


@pytest.mark.parametrize("seed", [0, 1])
def test_descendants_of_inner_nodes(spark, seed):
    rng = random.Random(seed)
    edges = [(1, 2), (1, 3), (2, 3), (3, 4)]  # 3 hangs under 1 only, but is below 2 as well
    edges += [(10, 11), (11, 10), (11, 12), (12, 13), (13, 14), (14, 13)] + [(20, 20), (20, 21)]  # cycles without a root
    edges += [(rng.randrange(30, 50), rng.randrange(40, 70)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(21)]
    clean = hierarchy.clean_edges(spark.createDataFrame(edges, "p int, c int"), "p", "c")
    f = hierarchy.forest(clean)
    below, want = hierarchy.reach(f, f.nodes.select("node")), brute_below(edges)
    assert {(r["start"], r["node"]): r["depth"] for r in below.filter("start <> node").collect()} == {k: d for k, d in want.items() if k[0] != k[1]}
    classes = hierarchy.entry_classes(f)
    roots = hierarchy.roots_of(clean)
    reached = hierarchy.reach(f, roots.union(hierarchy.class_starts(classes)))
    starts = hierarchy.rootless_starts(f, classes, hierarchy.cycles(f, classes, reached), reached)
    assert {(10,), (20,)} <= set(rows(starts)) and (13,) not in rows(starts)
    assert {r["node"] for r in hierarchy.reach(f, roots.union(starts)).collect()} == {x for e in edges for x in e}


def test_nested_sets_query_counts_all_descendants(spark, tmp_path):
    edges = [(1, 2), (1, 3), (2, 3), (3, 4), (10, 11), (11, 10), (11, 12), (None, 5), (7, None)]
    spark.createDataFrame(edges, "parent_label_id int, sub_label_id int").write.parquet(str(tmp_path / "label_sub_label.parquet"))
    got = {(r["root_label_id"], r["label_id"]): r["descendants"] for r in training_queries.p6_nested_sets(spark, str(tmp_path)).collect()}
    assert got == {(1, 1): 3, (1, 2): 2, (1, 3): 1, (1, 4): 0, (10, 10): 2, (10, 11): 2, (10, 12): 0}
    pairs = training_queries.p6_descendants(spark, str(tmp_path)).select("label_id", "descendant_id")
    assert set(rows(pairs)) == {k for k in brute_below([e for e in edges if None not in e]) if k[0] != k[1]}


# skew helpers


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(spark, how):
    rng = random.Random(how)
    left = [(i, rng.choice([None, *[1] * 10, *range(2, 30)])) for i in range(500)]
    right = [(k, k * 10) for k in [1, 2, 3, 5, 8, 13, 21]] + [(None, -1)]
    a, b = spark.createDataFrame(left, "i int, k int"), spark.createDataFrame(right, "k int, v int")
    out = skew.salted_join(a, b, ["k"], how, share=0.05)
    want = a.join(b, "k", how).select(*out.columns)
    assert rows(out) == rows(want)
    assert skew.salted_join(a.limit(0), b, ["k"], how).count() == 0


def test_running_sums(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randrange(5)) for i in range(400)]
    df = spark.createDataFrame(data, "g string, i int, v int")
    out = skew.running_sums(df, ["g"], ["i"], "v", "before", buckets=7).collect()
    for g in ("a", "b", None):
        mine = sorted([r for r in out if r["g"] == g], key=lambda r: (r["before"], r["v"]))
        total = sum(r["v"] for r in mine)
        ends = sorted(r["before"] + r["v"] for r in mine)
        starts = sorted(r["before"] for r in mine)
        assert starts[0] == 0 and ends[-1] == total and len(mine) == sum(x[0] == g for x in data)
        assert sorted(starts + [total]) == sorted([0, *ends])
    assert skew.running_sums(df.limit(0), ["g"], ["i"], "v", "before").count() == 0


def test_hot_keys_bound(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 50 + [2] * 30 + [None] * 40 + list(range(3, 33))], "k int")
    assert rows(skew.hot_keys(df, ["k"], 0.1)) == [(1,), (2,)]


def test_clashing_column_names(spark):
    """Extra columns named like an operator's own change nothing."""
    d = D(2024, 1, 1)
    df = spark.createDataFrame([(d, 1, "x", "c", 9), (D(2024, 2, 1), 1, "y", "c", 9)], "d date, id int, name string, change_kind string, __v int")
    assert rows(snapshots.snapshot_changes(df, "d", ["id"], [F.col("name")])) == [(D(2024, 2, 1), 1, "changed")]
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "k int, key_id int, n_rows int, latest int, __n int")
    assert rows(hot_keys.keyed_summary(df, "k", "key_id", "latest")) == [(1, 1, 1, 4)]
    df = spark.createDataFrame([(1, 2, "r", 7)], "parent int, child int, root string, depth int")
    assert rows(hierarchy.forest(hierarchy.clean_edges(df, "parent", "child")).nodes.select("node", "up", "depth")) == [(1, None, 0), (2, 1, 1)]
    df = spark.createDataFrame([(1, 5, "v")], "id int, target int, k string")
    assert orphans.orphan_references(df, df, [("target", "id")]).columns == ["id", "target", "k"]
    df = spark.createDataFrame([(1, (["x"],), "g", "p")], "id int, urls struct<url:array<string>>, ordinals string, leaves string")
    assert rows(shred.shred(df, ["id"])["urls.url"]) == [(1, 1, "x")]


def test_very_long_texts(spark):
    long = "Ab " * 300_000
    df = spark.createDataFrame([(D(2024, 1, 1), 1, long), (D(2024, 2, 1), 1, long + "x")], "d date, id int, t string")
    assert rows(snapshots.snapshot_changes(df, "d", ["id"], [trim_to_null("t")])) == [(D(2024, 2, 1), 1, "changed")]
