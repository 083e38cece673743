"""Queries p1-p3, p5 and p6 over the catalogue tables, with SQL for the check by another engine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.functions.text import WHITE_SPACE, is_blank, trim_to_null
from cratework.operators import hierarchy, hot_keys, orphans, shred, snapshots
from cratework.session import table

LISTS = {"urls.url": "url", "namevariations.name": "name_variation", "aliases.name": "alias", "groups.name": "group", "members.name": "member"}
LINKS = ("aliases.name", "groups.name", "members.name")
HEAVY_SHARE = 0.02


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def _nested(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artist_xml").select("record_id", "urls", "namevariations", "aliases", "groups", "members")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    nested = _nested(spark, d)
    rows = shred.grouped_triples(nested, ["record_id"])
    text, ref = F.element_at("leaves", F.lit("value")), F.element_at("leaves", F.lit("_id"))
    names = F.create_map(*[F.lit(x) for kv in LISTS.items() for x in kv])
    kept = F.when(F.col("group").isin(*LINKS), ref.isNotNull()).otherwise(~is_blank(text))
    # no two rows are alike, as record_id is unique
    return rows.filter(kept).select("record_id", F.element_at(names, F.col("group")).alias("relation"), F.col("ordinals")[0].alias("ordinal"))


def _flat(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        flat = shred.shred(_nested(spark, d), ["record_id"])[name]
        return flat.select("record_id", F.col("ordinal_1").alias("ordinal"), *[F.col(c).alias(c.strip("_").lower()) for c in flat.columns[2:]])

    return query


def _flat_sql(path: str, linked: bool) -> str:
    fields = "e._VALUE AS value, e._id AS id" if linked else "e AS value"
    return f"""SELECT DISTINCT record_id, i::INT AS ordinal, {fields} FROM (
      SELECT record_id, unnest({path}) AS e, unnest(range(1, len({path}) + 1)) AS i FROM artist_xml WHERE len({path}) > 0)"""


def _references(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, str]]:
    """For each table the references (period, row_id, target_id) and the name of the table they point into."""
    xml = table(spark, d, "artist_xml").select("dump_date", "id", "aliases", "groups", "members")
    members = shred.grouped_triples(xml, ["dump_date", "id"]).select(
        F.concat(F.lit("artist_xml."), F.substring_index("group", ".", 1)).alias("ref_table"),
        "dump_date", F.col("id").alias("row_id"), F.element_at("leaves", F.lit("_id")).cast("int").alias("target_id"),
    )
    plain = lambda name, row, target: table(spark, d, name).select(
        F.lit(name).alias("ref_table"), "dump_date", F.col(row).alias("row_id"), F.col(target).alias("target_id")
    )
    artists = members.unionByName(plain("release_item_artist", "release_item_id", "artist_id"))
    return {"artist": (artists, "artist_snapshot"), "master": (plain("release_item", "id", "master_id"), "master")}


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    refs = _references(spark, d)
    parts = []
    for rows, target in refs.values():
        there = table(spark, d, target)
        period = "snapshot_date" if target == "artist_snapshot" else "dump_date"
        parts.append(
            orphans.orphan_references(rows, there.select(period, "id"), [("dump_date", period), ("target_id", "id")], "partial", required=["target_id", "dump_date"])
        )
    return reduce(DataFrame.unionByName, parts)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("ref_table", _day("dump_date").alias("period_date"), "row_id", "target_id").distinct()


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    report = orphans.orphan_report(_orphans(spark, d), ["ref_table", "dump_date"], ["target_id"])
    return report.select("ref_table", _day("dump_date").alias("period_date"), "orphan_rows", "missing_keys")


def p2_masks(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the last dump whose (label_id, category_notation), both of which may be null, no earlier dump has: by null mask, under each match rule."""
    rows = table(spark, d, "label_release_item").select("dump_date", "label_id", "category_notation")
    last = rows.select(F.max("dump_date")).scalar()
    refs, there = rows.filter(F.col("dump_date") == last), rows.filter(F.col("dump_date") < last)
    keys = [("label_id", "label_id"), ("category_notation", "category_notation")]
    parts = [orphans.orphan_references(refs, there, keys, m).select(F.lit(m).alias("match_rule"), *[c for c, _ in keys]) for m in orphans.MATCHES]
    masks = [F.col(c).isNull().alias(f"{c}_null") for c, _ in keys]
    return reduce(DataFrame.unionByName, parts).groupBy("match_rule", *masks).agg(F.count(F.lit(1)).alias("n_rows"))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    artists = table(spark, d, "artist_snapshot")
    return snapshots.snapshot_changes(artists, "snapshot_date", ["id"], [trim_to_null("name"), trim_to_null("profile")])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d).select(_day("snapshot_date").alias("snapshot_date"), F.col("id").alias("artist_id"), "change_kind")


def p3_summary(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).groupBy("snapshot_date", "change_kind").agg(F.count(F.lit(1)).alias("n_artists"))


SUMMARIES = {"release_item_artist": "artist_id", "label_release_item": "label_id"}


def _summary(spark: SparkSession, d: str, name: str) -> DataFrame:
    return hot_keys.keyed_summary(table(spark, d, name), SUMMARIES[name], "release_item_id", "last_modified_at")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [hot_keys.heavy_keys(_summary(spark, d, n), table(spark, d, n), HEAVY_SHARE).select(F.lit(n).alias("table_name"), "key_id") for n in SUMMARIES]
    return reduce(DataFrame.unionByName, parts)


def _p5(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return _summary(spark, d, name).select("key_id", "n_rows", "n_members", F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"))

    return query


def _links(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.settle(hierarchy.clean_edges(table(spark, d, "label_sub_label"), "parent_label_id", "sub_label_id"))


def _hierarchy(spark: SparkSession, d: str):
    """Forest, roots, what roots and cycles reach, and the labels on cycles."""
    edges = _links(spark, d)
    f = hierarchy.forest(edges)
    roots = hierarchy.settle(hierarchy.roots_of(edges))
    classes = hierarchy.entry_classes(f)
    reached = hierarchy.settle(hierarchy.reach(f, roots.union(hierarchy.class_starts(classes))))
    return f, roots, classes, reached, hierarchy.cycles(f, classes, reached)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    _, roots, _, reached, cycles = _hierarchy(spark, d)
    below = reached.join(roots.withColumnRenamed("node", "start"), "start", "left_semi")
    trees = below.select(F.col("node").alias("label_id"), F.col("start").alias("root_label_id"), "depth")
    return trees.unionByName(cycles.select(F.col("node").alias("label_id"), F.col("least").alias("root_label_id"), F.lit(-1).alias("depth")))


def _below(spark: SparkSession, d: str) -> DataFrame:
    f = hierarchy.forest(_links(spark, d))
    return hierarchy.reach(f, f.nodes.select("node")).filter("start <> node")


def p6_nested_sets(spark: SparkSession, d: str) -> DataFrame:
    """root, label, depth, path from the root, range in the forest, subtree size there and number of descendants.

    A cycle that no root reaches is represented by its smallest label as root, so that each label of a link is in some
    row. ``first`` and ``last`` are places in the forest, where a label has one parent; ``descendants`` counts the labels
    other than itself that the label reaches over any links (p6_descendants lists them).
    """
    f, roots, classes, reached, cycles = _hierarchy(spark, d)
    starts = roots.union(hierarchy.rootless_starts(f, classes, cycles, reached))
    ways = hierarchy.reach(f, starts, hierarchy.paths(f))
    counts = hierarchy.reach(f, f.nodes.select("node")).groupBy(F.col("start").alias("node")).agg((F.count(F.lit(1)) - 1).alias("descendants"))
    return ways.join(f.nodes.select("node", "size", "first"), "node").join(counts, "node").select(
        F.col("start").alias("root_label_id"), F.col("node").alias("label_id"), "depth", F.col("size").alias("subtree_size"),
        "first", (F.col("first") + F.col("size") - 1).alias("last"), F.array_join(F.col("way").cast("array<string>"), "/").alias("path"), "descendants",
    )


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Each label with each other label below it, over whatever links, and the fewest links between them."""
    return _below(spark, d).select(F.col("start").alias("label_id"), F.col("node").alias("descendant_id"), F.col("depth").alias("distance"))


def p6_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Descendants of each root, itself not counted."""
    edges = _links(spark, d)
    reached = hierarchy.reach(hierarchy.forest(edges), hierarchy.roots_of(edges))
    return reached.groupBy(F.col("start").alias("root_label_id")).agg((F.count(F.lit(1)) - 1).alias("descendants"))


QUERIES = {
    "p1_found": p1_found,
    "p1_urls": _flat("urls.url"),
    "p1_name_variations": _flat("namevariations.name"),
    "p1_aliases": _flat("aliases.name"),
    "p1_groups": _flat("groups.name"),
    "p1_members": _flat("members.name"),
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p2_masks": p2_masks,
    "p3_found": p3_found,
    "p3_summary": p3_summary,
    "p5_found": p5_found,
    "p5_artists": _p5("release_item_artist"),
    "p5_labels": _p5("label_release_item"),
    "p6_found": p6_found,
    "p6_nested_sets": p6_nested_sets,
    "p6_descendants": p6_descendants,
    "p6_sizes": p6_sizes,
}

_WS = "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE)
_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
_P1_PARTS = [
    f"SELECT record_id, '{relation}' AS relation, i::INT AS ordinal FROM (SELECT record_id, unnest({path}) AS e, unnest(range(1, len({path}) + 1)) AS i FROM artist_xml WHERE len({path}) > 0) WHERE "
    + ("e._id IS NOT NULL" if path in LINKS else f"trim(e, {_CHARS}) <> ''")
    for path, relation in LISTS.items()
]
_P2_REFS = f"""
  SELECT 'release_item' AS ref_table, dump_date, id AS row_id, master_id AS target_id, 'm' AS t FROM release_item
  UNION ALL SELECT 'release_item_artist', dump_date, release_item_id, artist_id, 'a' FROM release_item_artist
  {' '.join(f"UNION ALL SELECT 'artist_xml.{p.split('.')[0]}', dump_date, id, unnest({p})._id, 'a' FROM artist_xml" for p in LINKS)}"""
_P2 = f"""WITH refs AS ({_P2_REFS}),
  there AS (SELECT DISTINCT 'a' AS t, snapshot_date AS at, id FROM artist_snapshot UNION SELECT DISTINCT 'm', dump_date, id FROM master),
  orphan AS (SELECT * FROM refs r WHERE target_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM there x WHERE x.t = r.t AND x.at = r.dump_date AND x.id = r.target_id))"""
_P2_MASKS = """WITH l AS (SELECT max(dump_date) AS d FROM label_release_item),
  r AS (SELECT label_id AS a, category_notation AS b FROM label_release_item, l WHERE dump_date = d), t AS (SELECT DISTINCT label_id AS a, category_notation AS b FROM label_release_item, l WHERE dump_date < d),
  found AS (SELECT r.a, r.b, count(*) AS n, EXISTS (SELECT 1 FROM t WHERE (r.a IS NULL OR t.a = r.a) AND (r.b IS NULL OR t.b = r.b)) AS ok FROM r GROUP BY r.a, r.b),
  o AS (SELECT 'simple' AS m, * FROM found WHERE a IS NOT NULL AND b IS NOT NULL AND NOT ok
    UNION ALL SELECT 'partial', * FROM found WHERE (a IS NOT NULL OR b IS NOT NULL) AND NOT ok
    UNION ALL SELECT 'full', * FROM found WHERE (a IS NULL) <> (b IS NULL) OR (a IS NOT NULL AND b IS NOT NULL AND NOT ok))
  SELECT m AS match_rule, a IS NULL AS label_id_null, b IS NULL AS category_notation_null, sum(n)::BIGINT AS n_rows FROM o GROUP BY 1, 2, 3"""
_P3 = f"""WITH v AS (SELECT DISTINCT snapshot_date AS day, id, coalesce(trim(name, {_CHARS}), '') AS a, coalesce(trim(profile, {_CHARS}), '') AS b FROM artist_snapshot),
  s AS (SELECT day, lead(day) OVER (ORDER BY day) AS nxt FROM (SELECT DISTINCT day FROM v)),
  c AS (SELECT coalesce(n.day, o.nxt) AS day, coalesce(n.id, o.id) AS id,
      CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN n.a <> o.a OR n.b <> o.b THEN 'changed' END AS kind
    FROM (SELECT v.*, s.nxt FROM v JOIN s USING (day) WHERE s.nxt IS NOT NULL) o
    FULL JOIN (SELECT * FROM v WHERE day > (SELECT min(day) FROM v)) n ON n.day = o.nxt AND n.id = o.id)"""
_P5 = {
    n: f"""SELECT {k} AS key_id, count(*)::BIGINT AS n_rows, count(DISTINCT release_item_id)::BIGINT AS n_members, strftime(max(last_modified_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS latest FROM {n} GROUP BY 1"""
    for n, k in SUMMARIES.items()
}
_P6 = """WITH RECURSIVE e AS (SELECT DISTINCT parent_label_id AS p, sub_label_id AS c FROM label_sub_label WHERE parent_label_id IS NOT NULL AND sub_label_id IS NOT NULL),
  reach(a, b, depth) USING KEY (a, b) AS (
    SELECT v, v, 0 FROM (SELECT p AS v FROM e UNION SELECT c FROM e)
    UNION (SELECT DISTINCT t.a, e.c, t.depth + 1 FROM reach t JOIN e ON e.p = t.b WHERE NOT EXISTS (SELECT 1 FROM recurring.reach r WHERE r.a = t.a AND r.b = e.c))),
  tree AS (SELECT a AS root, b AS node, depth FROM reach WHERE a NOT IN (SELECT c FROM e)),
  cyclic AS (SELECT DISTINCT e.p AS a, x.b FROM e JOIN reach x ON x.a = e.c JOIN reach y ON y.a = x.b AND y.b = e.p)"""

ORACLE = {
    "p1_found": " UNION ".join(_P1_PARTS),
    "p1_urls": _flat_sql("urls.url", False),
    "p1_name_variations": _flat_sql("namevariations.name", False),
    "p1_aliases": _flat_sql("aliases.name", True),
    "p1_groups": _flat_sql("groups.name", True),
    "p1_members": _flat_sql("members.name", True),
    "p2_found": _P2 + " SELECT DISTINCT ref_table, strftime(dump_date, '%Y-%m-%d') AS period_date, row_id, target_id FROM orphan",
    "p2_report": _P2 + " SELECT ref_table, strftime(dump_date, '%Y-%m-%d') AS period_date, count(*)::BIGINT AS orphan_rows, count(DISTINCT target_id)::BIGINT AS missing_keys FROM orphan GROUP BY 1, 2",
    "p2_masks": _P2_MASKS,
    "p3_found": _P3 + " SELECT DISTINCT strftime(day, '%Y-%m-%d') AS snapshot_date, id AS artist_id, kind AS change_kind FROM c WHERE kind IS NOT NULL",
    "p3_summary": _P3 + " SELECT strftime(day, '%Y-%m-%d') AS snapshot_date, kind AS change_kind, count(DISTINCT id)::BIGINT AS n_artists FROM c WHERE kind IS NOT NULL GROUP BY 1, 2",
    "p5_found": " UNION ALL ".join(f"SELECT '{n}' AS table_name, {k} AS key_id FROM {n} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > {HEAVY_SHARE} * (SELECT count(*) FROM {n})" for n, k in SUMMARIES.items()),
    "p5_artists": _P5["release_item_artist"],
    "p5_labels": _P5["label_release_item"],
    "p6_found": _P6 + " SELECT node AS label_id, root AS root_label_id, depth FROM tree UNION ALL SELECT a, least(a, min(b)), -1 FROM cyclic GROUP BY 1",
    "p6_descendants": _P6 + " SELECT a AS label_id, b AS descendant_id, depth AS distance FROM reach WHERE a <> b",
    "p6_sizes": _P6 + " SELECT root AS root_label_id, count(*)::BIGINT - 1 AS descendants FROM tree GROUP BY 1",
}
