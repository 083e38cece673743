"""Queries for the engine's own operators over whole tables, each with the same question in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.functions import dates, hashing, numbers, text
from cratework.operators import converge, dedupe
from cratework.plans import ledger, runs, transforms
from cratework.plans.registry import CONTRACT_REVISIONS, ENTITIES, TABLES
from cratework.session import table
from cratework.sources import catalog

QUERIES: dict = {}
ORACLE: dict = {}
_TRIM = " || ".join(f"chr({ord(c)})" for c in text.WHITE_SPACE)


def _ws(c: str) -> str:
    return f"nullif(trim({c}, {_TRIM}), '')"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _last(df: DataFrame, period: str) -> Column:
    return df.select(F.max(period)).scalar()


def _count(*by: str):
    return lambda df: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


# Back-links: A12, J11, J12, M5, O1

_MASTERS = """masters AS (SELECT id, main_release_id FROM master QUALIFY row_number() OVER (PARTITION BY id ORDER BY dump_date DESC, main_release_id DESC NULLS LAST) = 1)"""
_NEWEST = """newest AS (SELECT master_id, id AS release_id FROM release_item WHERE is_master AND master_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY master_id ORDER BY last_modified_at DESC NULLS LAST, id DESC) = 1)"""


def _main() -> Column:
    return F.coalesce(F.col("is_master"), F.lit(False))


def _masters(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.newest_per_group(table(spark, d, "master"), ["id"], [F.col("dump_date")], ["main_release_id"])


@query(f"WITH {_NEWEST} SELECT * FROM newest")
def backlink_latest(spark: SparkSession, d: str) -> DataFrame:
    out = converge.latest_backlinks(table(spark, d, "release_item"), "master_id", "id", [F.col("last_modified_at")], _main())
    return out.select("master_id", F.col("id").alias("release_id"))


@query(
    f"""WITH {_MASTERS}, {_NEWEST} SELECT m.id, n.release_id AS main_release_id,
    CASE WHEN m.main_release_id IS NOT DISTINCT FROM n.release_id THEN 'unchanged' WHEN m.main_release_id IS NULL THEN 'set'
      WHEN n.release_id IS NULL THEN 'cleared' ELSE 'moved' END AS status FROM masters m LEFT JOIN newest n ON n.master_id = m.id"""
)
def backlink_reconcile(spark: SparkSession, d: str) -> DataFrame:
    return converge.reconcile_backlinks(_masters(spark, d), table(spark, d, "release_item"), "id", "main_release_id", "master_id", "id", [F.col("last_modified_at")], _main(), status=True)


@query(
    f"""WITH {_MASTERS} SELECT * FROM masters m WHERE main_release_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM release_item r
    WHERE r.id = m.main_release_id AND r.master_id = m.id AND r.is_master)"""
)
def backlink_clear(spark: SparkSession, d: str) -> DataFrame:
    return converge.stale_backlinks(_masters(spark, d), table(spark, d, "release_item"), "id", "main_release_id", "master_id", "id", _main())


# Scalar functions: F1-F22


@query(f"SELECT id, {_ws('name')} AS name, {_ws('contact_info')} AS contact_info, {_ws('profile')} AS profile FROM label")
def trim_to_null(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "label").select("id", *[text.trim_to_null(c).alias(c) for c in ("name", "contact_info", "profile")])


_UNITS = "list_transform(range(1, length({0}) + 1), lambda i: unicode(substr({0}, i, 1)))"
_JAVA = f"""SELECT {{key}}, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END::INT AS hash FROM (
  SELECT {{key}}, list_reduce(list_prepend(0::BIGINT, list_transform(flatten(list_transform({_UNITS.format('{col}')},
    lambda u: CASE WHEN u < 65536 THEN [u] ELSE [55296 + ((u - 65536) >> 10), 56320 + ((u - 65536) & 1023)] END)), lambda u: u::BIGINT)),
    lambda a, u: (a * 31 + u) & 4294967295) AS h FROM {{table}} WHERE {{col}} IS NOT NULL)"""


@query(_JAVA.format(key="id", col="name", table="label"))
def java_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "label").filter("name is not null").select("id", hashing.java_hash("name").alias("hash"))


@query(
    """SELECT p_partkey, list_reduce(list_prepend(2166136261::BIGINT, list_transform(range(1, strlen(p_name) + 1), lambda i: unicode(substr(p_name, i, 1))::BIGINT)),
    lambda a, b: xor((a * 16777619) & 4294967295, b)) AS hash FROM part"""
)
def fnv_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", hashing.fnv1_32("p_name").alias("hash"))


def _frame(c: str) -> str:
    t = _ws(c)
    return f"CASE WHEN {t} IS NULL THEN '\\x00'::BLOB ELSE '\\x01'::BLOB || unhex(printf('%08x', strlen({t}))) || encode({t}) END"


def _digest_sql(domain: hashing.IdentityDomain, relation: str, fields: list[str]) -> str:
    parts = " || ".join([f"encode('{domain.digest}')", "'\\x00'::BLOB", f"encode('{relation}')", "'\\x00'::BLOB", *map(_frame, fields)])
    return f"sha256({parts})"


def _slot_sql(domain: hashing.IdentityDomain, relation: str, digest_hex: str) -> str:
    frame = f"encode('{domain.slot}') || '\\x00'::BLOB || encode('{relation}') || '\\x00'::BLOB || unhex({digest_hex}) || '\\x00\\x00\\x00\\x00'::BLOB"
    n = f"('0x' || substr(sha256({frame}), 1, 8))::BIGINT"
    return f"(CASE WHEN {n} >= 2147483648 THEN {n} - 4294967296 ELSE {n} END)::INT"


def _label_digest() -> Column:
    return hashing.identity_digest(hashing.CATALOGUE_DOMAIN, "label_text", [F.col("name"), F.col("contact_info"), F.col("profile")])


@query(f"SELECT id, {_digest_sql(hashing.CATALOGUE_DOMAIN, 'label_text', ['name', 'contact_info', 'profile'])} AS digest FROM label")
def identity_digest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "label").select("id", F.lower(F.hex(_label_digest())).alias("digest"))


@query(
    f"""SELECT id, {_slot_sql(hashing.CATALOGUE_DOMAIN, 'label_text', 'digest')} AS slot FROM (
    SELECT id, {_digest_sql(hashing.CATALOGUE_DOMAIN, 'label_text', ['name', 'contact_info', 'profile'])} AS digest FROM label)"""
)
def compat_slot(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "label").select("id", hashing.compat_slot(hashing.CATALOGUE_DOMAIN, "label_text", _label_digest()).alias("slot"))


@query(
    f"""SELECT record_id, nullif(list_aggregate(list_transform(list_filter(list_transform(namevariations.name, lambda x: {_ws('x')}),
    lambda x: x IS NOT NULL), lambda x: '[d:' || x || ']'), 'string_agg', ','), '') AS reduced FROM artist_xml"""
)
def format_reduce(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artist_xml").select("record_id", text.reduce_descriptions("namevariations.name").alias("reduced"))


@query("SELECT id, md5(concat(coalesce(name, chr(1)), chr(9), coalesce(contact_info, chr(1)), chr(9), coalesce(profile, chr(1)), chr(9), coalesce(data_quality, chr(1)))) AS source FROM label")
def format_source(spark: SparkSession, d: str) -> DataFrame:
    """The hash source of four fields, shown by its MD5; the separator U+0000 is shown as a tab, which SQL can hold."""
    source = text.format_hash_source(*[F.col(c) for c in ("name", "contact_info", "profile", "data_quality")])
    return table(spark, d, "label").select("id", F.md5(F.regexp_replace(source, "\u0000", "\t")).alias("source"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, cast(cast(l_quantity AS INT) AS VARCHAR) AS quantity_text, cast(l_quantity AS INT) AS quantity,
    count(*)::BIGINT AS n_rows FROM lineitem GROUP BY ALL"""
)
def quantity_canonical(spark: SparkSession, d: str) -> DataFrame:
    q = numbers.quantity(F.lpad(F.col("l_quantity").cast("int").cast("string"), 14, "0"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", q.alias("q"))
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", F.col("q.quantity_text").alias("quantity_text"), F.col("q.quantity").alias("quantity"))
    return _count(*rows.columns)(rows)


_DATE = r"""WITH x AS (SELECT DISTINCT listed_release_date AS s FROM release_item WHERE listed_release_date IS NOT NULL),
  m AS (SELECT s, regexp_extract(s, '^([0-9]+)[-_. ]([0-9]+)[-_. ]([0-9]+)$', ['y', 'm', 'd']) AS p, regexp_matches(s, '^([0-9]+)[-_. ]([0-9]+)[-_. ]([0-9]+)$') AS three FROM x),
  k AS (SELECT s, CASE WHEN three THEN p.y || CASE WHEN lpad(p.m, 2, '0') = '00' THEN '' WHEN lpad(p.d, 2, '0') = '00' THEN lpad(p.m, 2, '0') ELSE lpad(p.m, 2, '0') || lpad(p.d, 2, '0') END
      ELSE regexp_replace(s, '[^0-9]', '', 'g') END AS d0 FROM m),
  g AS (SELECT s, CASE WHEN length(d0) = 5 THEN substr(d0, 1, 4) || '0' || substr(d0, 5, 1) ELSE d0 END AS d FROM k),
  c AS (SELECT *, CASE WHEN length(d) = 8 THEN try_strptime(d, '%Y%m%d') END AS a,
      CASE WHEN length(d) = 6 AND substr(d, 5, 2)::INT BETWEEN 1 AND 12 THEN 1 END AS b,
      CASE WHEN length(d) = 6 THEN try_strptime(CASE WHEN substr(d, 1, 2)::INT >= 69 THEN '19' ELSE '20' END || d, '%Y%m%d') END AS e FROM g)
  SELECT s AS listed,
    CASE WHEN a IS NOT NULL THEN year(a) WHEN b = 1 THEN substr(d, 1, 4)::INT WHEN e IS NOT NULL THEN year(e) WHEN length(d) = 4 THEN d::INT
      WHEN length(d) = 2 THEN CASE WHEN d::INT >= 69 THEN 1900 ELSE 2000 END + d::INT END::INT AS y,
    CASE WHEN a IS NOT NULL THEN month(a) WHEN b = 1 THEN substr(d, 5, 2)::INT WHEN e IS NOT NULL THEN month(e) END::INT AS m,
    CASE WHEN a IS NOT NULL THEN day(a) WHEN b = 1 THEN NULL WHEN e IS NOT NULL THEN day(e) END::INT AS dd FROM c"""


@query(_DATE)
def partial_date(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "release_item").select(F.col("listed_release_date").alias("listed")).filter("listed is not null").distinct()
    p = listed.withColumn("p", dates.parse_partial_date("listed"))
    return p.select("listed", F.col("p.year").alias("y"), F.col("p.month").alias("m"), F.col("p.day").alias("dd"))


@query(f"WITH q AS ({_DATE}) SELECT listed, strftime(make_date(y, coalesce(m, 1), coalesce(dd, 1)), '%Y-%m-%d') AS release_date, y IS NOT NULL AS has_year, m IS NOT NULL AS has_month, dd IS NOT NULL AS has_day FROM q")
def release_date_fields(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "release_item").select(F.col("listed_release_date").alias("listed")).filter("listed is not null").distinct()
    p = listed.withColumn("p", dates.parse_partial_date("listed"))
    flags = [F.col(f"p.{a}").isNotNull().alias(f"has_{a}") for a in ("year", "month", "day")]
    return p.select("listed", F.date_format(dates.release_date(F.col("p")), "yyyy-MM-dd").alias("release_date"), *flags)


@query("SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS month, count(*)::BIGINT AS n_rows FROM orders GROUP BY 1")
def month_window(spark: SparkSession, d: str) -> DataFrame:
    months = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).withColumn("first", F.trunc("day", "MM"))
    inside = months.filter(dates.in_month("day", F.col("first")))
    return _count("month")(inside.select(F.date_format("first", "yyyy-MM-dd").alias("month")))


@query("""SELECT record_id, i::INT AS ordinal, list_last(string_split(u, '/')) AS segment FROM (
    SELECT record_id, unnest(urls.url) AS u, unnest(range(1, len(urls.url) + 1)) AS i FROM artist_xml WHERE len(urls.url) > 0) WHERE u IS NOT NULL""")
def uri_segment(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "artist_xml").select("record_id", F.posexplode("urls.url").alias("i", "u")).filter("u is not null")
    return rows.select("record_id", (F.col("i") + 1).alias("ordinal"), text.last_segment("u").alias("segment"))


@query(
    """SELECT event_id, CASE WHEN n = 0 THEN 100.0 ELSE floor(least(m, n) * 100.0 / n * 100.0 + 0.5) / 100.0 END AS percent FROM (
    SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS m, 500.0 AS n FROM events)"""
)
def progress_metrics(spark: SparkSession, d: str) -> DataFrame:
    total = F.lit(500.0)
    done = numbers.clamp_progress(F.col("value"), total, ["user_id"], ["ts", "event_id"])
    rows = table(spark, d, "events").select("event_id", done.alias("done"))
    return rows.select("event_id", numbers.round_metric(numbers.percent_done(F.col("done"), total)).alias("percent"))


# Transforms from nested records: T1-T6


def _artist_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    known = table(spark, d, "artist_snapshot").select("id").distinct()
    return transforms.artist_tables(table(spark, d, "artist_xml"), {"artist": known})


@query(f"SELECT DISTINCT id, {_ws('name')} AS name, {_ws('realname')} AS real_name, {_ws('profile')} AS profile, {_ws('data_quality')} AS data_quality FROM artist_xml")
def artist_rows(spark: SparkSession, d: str) -> DataFrame:
    return _artist_tables(spark, d)["artist"].distinct()


def _text_sql(path: str, parent: str, column: str, relation: str) -> str:
    base = f"(SELECT DISTINCT id AS {parent}, {_ws('e')} AS {column} FROM (SELECT id, unnest({path}) AS e FROM artist_xml) WHERE {_ws('e')} IS NOT NULL)"
    hashes = _JAVA.format(key=f"{parent}, {column}", col=column, table=base)
    return f"SELECT {parent}, {column}, hash, {_digest_sql(hashing.CATALOGUE_DOMAIN, relation, [column])} AS digest FROM ({hashes})"


@query(_text_sql("urls.url", "artist_id", "url", "artist_url"))
def artist_url_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _artist_tables(spark, d)["artist_url"].distinct()
    return rows.select("artist_id", "url", "hash", F.lower(F.hex("identity_sha256")).alias("digest"))


@query(_text_sql("namevariations.name", "artist_id", "name_variation", "artist_name_variation"))
def artist_name_variation_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _artist_tables(spark, d)["artist_name_variation"].distinct()
    return rows.select("artist_id", "name_variation", "hash", F.lower(F.hex("identity_sha256")).alias("digest"))


def _link(name: str, path: str, column: str) -> None:
    def f(spark: SparkSession, d: str) -> DataFrame:
        return _artist_tables(spark, d)[name].distinct()

    QUERIES[f"{name}_rows"] = f
    ORACLE[f"{name}_rows"] = f"""SELECT DISTINCT id AS artist_id, r AS {column} FROM (SELECT id, unnest({path})._id AS r FROM artist_xml)
      WHERE r >= 1 AND r IN (SELECT id FROM artist_snapshot)"""


_link("artist_alias", "aliases.name", "alias_id")
_link("artist_group", "groups.name", "group_id")
_link("artist_member", "members.name", "member_id")


@query()
def slot_allocation(spark: SparkSession, d: str) -> DataFrame:
    """A8 over all name variations of an artist; colliding hashes have no SQL, the allocator is tested by brute force."""
    t = TABLES["artist_name_variation"]
    rows = transforms.canonical(_artist_tables(spark, d)[t.name], t)
    return rows.select("artist_id", "name_variation", F.col("hash").alias("slot"))


# Dedupe: A1-A7, A11, A13, A17, A19


@query("SELECT release_item_id, label_id, category_notation, min(last_modified_at)::VARCHAR AS first_seen FROM label_release_item GROUP BY 1, 2, 3")
def dedupe_exact(spark: SparkSession, d: str) -> DataFrame:
    rows = dedupe.distinct_in_order(table(spark, d, "label_release_item"), ["release_item_id", "label_id", "category_notation"], "last_modified_at")
    return rows.select("release_item_id", "label_id", "category_notation", F.date_format("last_modified_at", "yyyy-MM-dd HH:mm:ss'+00'").alias("first_seen"))


@query("SELECT id, count(*)::BIGINT AS n_rows FROM artist_snapshot GROUP BY 1 HAVING count(DISTINCT (name, realname)) > 1")
def dedupe_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.conflicts(table(spark, d, "artist_snapshot"), ["id"], ["name", "realname"])


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT (l_partkey, l_suppkey, l_quantity)) > 1")
def dedupe_conflicts_lines(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.conflicts(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"])


@query("SELECT DISTINCT dump_date::VARCHAR AS dump_date, id, title, country, master_id, status FROM release_item")
def keyed_dedupe(spark: SparkSession, d: str) -> DataFrame:
    rows = dedupe.keyed_dedupe(table(spark, d, "release_item"), ["dump_date", "id"], name="release_item", check=False)
    return rows.select(F.col("dump_date").cast("string").alias("dump_date"), "id", "title", "country", "master_id", "status")


@query(f"SELECT DISTINCT p_brand, {_digest_sql(hashing.CATALOGUE_DOMAIN, 'part', ['p_name', 'p_type'])} AS digest, p_name, p_type FROM part")
def digest_dedupe(spark: SparkSession, d: str) -> DataFrame:
    digest = F.lower(F.hex(hashing.identity_digest(hashing.CATALOGUE_DOMAIN, "part", [F.col("p_name"), F.col("p_type")])))
    rows = table(spark, d, "part").select("p_brand", digest.alias("digest"), hashing.java_hash(F.concat("p_name", "p_type")).alias("hash"), "p_name", "p_type")
    return dedupe.digest_dedupe(rows, ["p_brand"], "digest", "hash", ["p_name", "p_type"], "part").drop("hash")


@query("SELECT page_id, rev_id, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY rev_ts DESC NULLS LAST, rev_id DESC NULLS LAST, doc_id DESC) = 1")
def latest_per_group(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.newest_per_group(table(spark, d, "documents"), ["page_id"], [F.col("rev_ts"), F.col("rev_id"), F.col("doc_id")], ["rev_id", "doc_id"])


@query("SELECT o_orderkey // 5000 AS chunk_index, count(*)::BIGINT AS item_count, (o_orderkey // 5000) * 5000 AS first_item_index FROM orders GROUP BY 1")
def chunk_ledger(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.count_windows(table(spark, d, "orders"), "o_orderkey", 5000)


@query("SELECT dump_date::VARCHAR AS dump_date, count(*)::BIGINT AS rows_in, count(DISTINCT (release_item_id, coalesce(artist_id, -99)))::BIGINT AS rows_out, (count(*) - count(DISTINCT (release_item_id, coalesce(artist_id, -99))))::BIGINT AS duplicates FROM release_item_artist GROUP BY 1")
def audit_duplicates(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "release_item_artist").select(F.col("dump_date").cast("string").alias("dump_date"), "release_item_id", "artist_id")
    return dedupe.audit_duplicates(raw, raw.distinct(), ["dump_date"])


@query("SELECT doc_id, rev_id, p AS previous FROM (SELECT doc_id, rev_id, lag(rev_id) OVER (ORDER BY doc_id) AS p FROM documents) WHERE p >= rev_id")
def audit_monotonic(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "rev_id")
    return dedupe.not_increasing(rows, "doc_id", "rev_id")


@query("SELECT 'orders' AS table_name, count(*)::BIGINT AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'label', count(*) FROM label")
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.union_counts([(n, table(spark, d, n)) for n in ("orders", "lineitem", "label")])


# Joins and convergence: J1-J9, J20, M1-M4, K3, C19. Stored: all dumps before the last; incoming: the last.


@query("SELECT dump_date::VARCHAR AS dump_date, count(*)::BIGINT AS n_rows FROM release_item_artist WHERE artist_id >= 1 AND artist_id IN (SELECT id FROM artist_snapshot) GROUP BY 1")
def semi_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = converge.keep_known(table(spark, d, "release_item_artist"), "artist_id", table(spark, d, "artist_snapshot"))
    return _count("dump_date")(rows.withColumn("dump_date", F.col("dump_date").cast("string")))


@query("SELECT dump_date::VARCHAR AS dump_date, id, CASE WHEN master_id >= 1 AND master_id IN (SELECT id FROM master) THEN master_id END AS master_id, title FROM release_item")
def null_unknown_ref(spark: SparkSession, d: str) -> DataFrame:
    rows = converge.null_unknown(table(spark, d, "release_item"), "master_id", table(spark, d, "master"))
    return rows.select(F.col("dump_date").cast("string").alias("dump_date"), "id", "master_id", "title")


def _split(spark: SparkSession, d: str, name: str, columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored rows, incoming rows and touched roots of a relation of releases."""
    df = table(spark, d, name)
    last = _last(table(spark, d, "release_item"), "dump_date")
    roots = table(spark, d, "release_item").filter(F.col("dump_date") == last).select(F.col("id").alias("release_item_id"))
    return df.filter(F.col("dump_date") < last).select(*columns).distinct(), df.filter(F.col("dump_date") == last).select(*columns).distinct(), roots


def _split_sql(name: str, columns: str) -> str:
    return f"""last AS (SELECT max(dump_date) AS day FROM release_item), roots AS (SELECT DISTINCT id AS release_item_id FROM release_item, last WHERE dump_date = day),
    s AS (SELECT DISTINCT {columns} FROM {name}, last WHERE dump_date < day), i AS (SELECT DISTINCT {columns} FROM {name}, last WHERE dump_date = day)"""


def _stale(name: str, relation: str, columns: list[str], match: list[str], null_safe: list[str]) -> None:
    def f(spark: SparkSession, d: str) -> DataFrame:
        stored, incoming, roots = _split(spark, d, relation, columns)
        return converge.stale_rows(stored, incoming, roots, "release_item_id", match, null_safe)

    on = " AND ".join(f"i.{c} IS NOT DISTINCT FROM s.{c}" if c in null_safe else f"i.{c} = s.{c}" for c in match)
    QUERIES[name] = f
    ORACLE[name] = f"""WITH {_split_sql(relation, ', '.join(columns))} SELECT s.* FROM s WHERE release_item_id IN (SELECT release_item_id FROM roots)
      AND NOT EXISTS (SELECT 1 FROM i WHERE {on})"""


_stale("stale_delete_int", "release_item_artist", ["release_item_id", "artist_id"], ["release_item_id", "artist_id"], [])
_stale("stale_delete_text", "label_release_item", ["release_item_id", "category_notation"], ["release_item_id", "category_notation"], [])
_stale("stale_delete_two_int", "label_release_item", ["release_item_id", "label_id"], ["release_item_id", "label_id"], [])
_stale("stale_delete_nullable", "label_release_item", ["release_item_id", "label_id", "category_notation"], ["release_item_id", "label_id", "category_notation"], ["category_notation"])


def _with_digest(df: DataFrame) -> DataFrame:
    digest = hashing.identity_digest(hashing.RELEASE_DOMAIN, "label_release_item", [F.col("category_notation")])
    return df.withColumn("digest", F.when(F.col("category_notation").isNotNull(), F.lower(F.hex(digest))))


@query(
    f"""WITH {_split_sql('label_release_item', 'release_item_id, label_id, category_notation')},
    g AS (SELECT release_item_id, label_id, CASE WHEN category_notation IS NOT NULL THEN {_digest_sql(hashing.RELEASE_DOMAIN, 'label_release_item', ['category_notation'])} END AS digest FROM s),
    h AS (SELECT release_item_id, label_id, CASE WHEN category_notation IS NOT NULL THEN {_digest_sql(hashing.RELEASE_DOMAIN, 'label_release_item', ['category_notation'])} END AS digest FROM i)
    SELECT DISTINCT g.* FROM g WHERE release_item_id IN (SELECT release_item_id FROM roots)
      AND NOT EXISTS (SELECT 1 FROM h WHERE h.release_item_id = g.release_item_id AND h.label_id = g.label_id AND h.digest = g.digest)"""
)
def stale_delete_digest(spark: SparkSession, d: str) -> DataFrame:
    """Digests match by plain equality, so a stored row without one is always stale."""
    stored, incoming, roots = _split(spark, d, "label_release_item", ["release_item_id", "label_id", "category_notation"])
    stored, incoming = (_with_digest(x).drop("category_notation").distinct() for x in (stored, incoming))
    return converge.stale_rows(stored, incoming, roots, "release_item_id", ["release_item_id", "label_id", "digest"])


def _converge(name: str, relation: str, columns: list[str], null_safe: list[str]) -> None:
    def f(spark: SparkSession, d: str) -> DataFrame:
        stored, incoming, roots = _split(spark, d, relation, columns)
        return converge.converge_relation(stored, incoming, roots, "release_item_id", columns, null_safe, provenance=True)

    on = lambda a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" if c in null_safe else f"{a}.{c} = {b}.{c}" for c in columns)
    touched = "release_item_id IN (SELECT release_item_id FROM roots)"
    QUERIES[name] = f
    ORACLE[name] = f"""WITH {_split_sql(relation, ', '.join(columns))} SELECT *, 'untouched' AS provenance FROM s WHERE NOT coalesce({touched}, false)
      UNION ALL SELECT *, 'retained' FROM s WHERE {touched} AND EXISTS (SELECT 1 FROM i WHERE {on('i', 's')})
      UNION ALL SELECT *, 'new' FROM i WHERE NOT EXISTS (SELECT 1 FROM s WHERE {on('i', 's')})"""


_converge("converge_relation", "release_item_artist", ["release_item_id", "artist_id"], [])
_converge("converge_relation_nullable", "label_release_item", ["release_item_id", "label_id", "category_notation"], ["category_notation"])


def _artists(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    df = table(spark, d, "artist_snapshot")
    last = _last(df, "snapshot_date")
    rows = df.select("id", text.trim_to_null("name").alias("name"), text.trim_to_null("profile").alias("profile"), "snapshot_date")
    old = dedupe.newest_per_group(rows.filter(F.col("snapshot_date") < last), ["id"], [F.col("snapshot_date")], ["name", "profile", "snapshot_date"])
    new = dedupe.newest_per_group(rows.filter(F.col("snapshot_date") == last), ["id"], [F.col("snapshot_date")], ["name", "profile", "snapshot_date"])
    return old, new


@query(
    f"""WITH r AS (SELECT id, {_ws('name')} AS name, {_ws('profile')} AS profile, snapshot_date AS day FROM artist_snapshot), last AS (SELECT max(day) AS l FROM r),
    o AS (SELECT id, name, profile, day FROM r, last WHERE day < l QUALIFY row_number() OVER (PARTITION BY id ORDER BY day DESC, name DESC NULLS LAST, profile DESC NULLS LAST) = 1),
    n AS (SELECT id, name, profile, day FROM r, last WHERE day = l QUALIFY row_number() OVER (PARTITION BY id ORDER BY name DESC NULLS LAST, profile DESC NULLS LAST) = 1),
    j AS (SELECT coalesce(o.id, n.id) AS id, o.id AS oid, n.id AS nid, o.name AS oname, n.name AS nname, o.profile AS oprofile, n.profile AS nprofile, o.day AS oday, n.day AS nday FROM o FULL JOIN n ON o.id = n.id),
    k AS (SELECT *, CASE WHEN nid IS NULL THEN 'retained' WHEN oid IS NULL THEN 'inserted' WHEN oname IS NOT DISTINCT FROM nname AND oprofile IS NOT DISTINCT FROM nprofile THEN 'unchanged' ELSE 'updated' END AS status FROM j)
    SELECT id, CASE WHEN status IN ('inserted', 'updated') THEN nname ELSE oname END AS name, CASE WHEN status IN ('inserted', 'updated') THEN nprofile ELSE oprofile END AS profile,
      CASE WHEN status IN ('inserted', 'updated') THEN nday ELSE oday END::VARCHAR AS modified, status FROM k"""
)
def upsert_if_changed(spark: SparkSession, d: str) -> DataFrame:
    old, new = _artists(spark, d)
    out = converge.upsert_if_changed(old, new, "id", ["name", "profile"], "snapshot_date", status=True)
    return out.select("id", "name", "profile", F.col("snapshot_date").cast("string").alias("modified"), "status")


@query(
    f"""WITH r AS (SELECT {_ws('country')} AS name, dump_date FROM release_item), last AS (SELECT max(dump_date) AS l FROM r),
    o AS (SELECT DISTINCT name FROM r, last WHERE dump_date < l AND name IS NOT NULL), n AS (SELECT DISTINCT name FROM r, last WHERE dump_date = l AND name IS NOT NULL)
    SELECT name FROM o UNION SELECT name FROM n"""
)
def dimension_insert(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "release_item").select(text.trim_to_null("country").alias("name"), "dump_date").filter("name is not null")
    last = _last(table(spark, d, "release_item"), "dump_date")
    old, new = (df.filter(c).select("name").distinct() for c in (F.col("dump_date") < last, F.col("dump_date") == last))
    return converge.insert_or_ignore(old, new, ["name"])


@query(
    """WITH last AS (SELECT max(dump_date) AS l FROM release_item), roots AS (SELECT DISTINCT id FROM release_item, last WHERE dump_date = l)
    SELECT DISTINCT 'release_item_artist' AS table_name, release_item_id AS root FROM release_item_artist, last WHERE dump_date < l AND release_item_id IN (SELECT id FROM roots)
    UNION ALL SELECT DISTINCT 'label_release_item', release_item_id FROM label_release_item, last WHERE dump_date < l AND release_item_id IN (SELECT id FROM roots)"""
)
def existing_roots(spark: SparkSession, d: str) -> DataFrame:
    last = _last(table(spark, d, "release_item"), "dump_date")
    roots = table(spark, d, "release_item").filter(F.col("dump_date") == last).select("id")
    old = lambda n: table(spark, d, n).filter(F.col("dump_date") < last)
    return converge.existing_roots([(n, old(n), "release_item_id") for n in ("release_item_artist", "label_release_item")], roots, "id")


@query("SELECT dump_date::VARCHAR AS dump_date, release_item_id, artist_id FROM release_item_artist WHERE artist_id IS NOT NULL AND artist_id NOT IN (SELECT id FROM artist_snapshot)")
def fk_violations(spark: SparkSession, d: str) -> DataFrame:
    rows = converge.fk_violations(table(spark, d, "release_item_artist"), "artist_id", table(spark, d, "artist_snapshot"), "id")
    return rows.select(F.col("dump_date").cast("string").alias("dump_date"), "release_item_id", "artist_id")


@query(
    """SELECT c_custkey, o_orderkey, o_orderdate::DATE::VARCHAR AS day FROM customer LEFT JOIN LATERAL (
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_custkey = c_custkey AND o_orderdate < TIMESTAMP '1997-01-01' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) ON true"""
)
def lateral_latest(spark: SparkSession, d: str) -> DataFrame:
    """Newest row before a horizon for each outer row; one aggregation and a join instead of a lateral subquery."""
    before = table(spark, d, "orders").filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp"))
    newest = dedupe.newest_per_group(before, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey", "o_orderdate"])
    joined = table(spark, d, "customer").join(newest, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("""SELECT to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey})::VARCHAR AS row_text FROM nation
    UNION ALL SELECT to_json({'r_regionkey': r_regionkey, 'r_name': r_name})::VARCHAR FROM region""")
def state_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Rows as text, in text order."""
    parts = [table(spark, d, n) for n in ("nation", "region")]
    return reduce(DataFrame.union, [p.select(F.to_json(F.struct(*p.columns)).alias("row_text")) for p in parts]).orderBy("row_text")


# Catalogue parsing: S6, S7, S9, S10, S15, A18, J23, F18


@query("""SELECT doc_id, i::INT AS place, h AS href FROM (SELECT doc_id, unnest(l) AS h, unnest(range(1, len(l) + 1)) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, 'href\\s*=\\s*"([^"]*)"', 1) AS l FROM documents WHERE text IS NOT NULL) WHERE len(l) > 0)""")
def catalog_hrefs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(catalog.hrefs(F.col("text"))).alias("i", "href"))
    return rows.select("doc_id", (F.col("i") + 1).alias("place"), "href")


_KIND = {"1-URGENT": "artists", "2-HIGH": "labels", "3-MEDIUM": "masters", "4-NOT SPECIFIED": "releases"}


def _uris(spark: SparkSession, d: str) -> DataFrame:
    """A dump address made of each order; priorities stand for dump kinds, another one for an unknown kind."""
    kind = reduce(lambda c, kv: c.when(F.col("o_orderpriority") == kv[0], kv[1]), _KIND.items(), F.when(F.lit(False), "")).otherwise("images")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    uri = F.concat(F.lit("data/"), F.substr(day, F.lit(1), F.lit(4)), F.lit("/dump_"), day, F.lit("_"), kind, F.lit(".xml.gz"))
    return table(spark, d, "orders").select("o_orderkey", uri.alias("uri"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sum"))


_CASE = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KIND.items()) + " ELSE 'images' END"


@query(f"SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, {_CASE} AS kind, {_CASE} <> 'images' AS known FROM orders")
def uri_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = _uris(spark, d).withColumn("a", catalog.dump_address("uri"))
    return rows.select("o_orderkey", F.col("a.dump_date").cast("string").alias("day"), F.col("a.kind").alias("kind"), F.col("a.known").alias("known"))


@query(
    f"""SELECT o_orderdate::DATE::VARCHAR AS day, {_CASE} AS kind, sha256(arg_max(o_orderkey, o_orderkey)::VARCHAR) AS checksum
    FROM orders WHERE {_CASE} <> 'images' GROUP BY 1, 2"""
)
def checksum_lines(spark: SparkSession, d: str) -> DataFrame:
    """Manifest lines, the last of each (date, kind)."""
    line = F.concat(F.upper("sum"), F.lit(" *"), F.substring_index("uri", "/", -1))
    lines = _uris(spark, d).select(line.alias("value"), F.col("o_orderkey").alias("line_no"))
    return catalog.checksum_map(lines).select(F.col("dump_date").cast("string").alias("day"), "kind", "checksum")


@query(f"SELECT DISTINCT o_orderdate::DATE::VARCHAR AS day, rtrim({_CASE}, 's') AS entity_type FROM orders WHERE {_CASE} <> 'images'")
def catalog_listing(spark: SparkSession, d: str) -> DataFrame:
    """Download links of a listing page to dump rows."""
    page = F.concat(F.lit('<a href="?x=1&amp;download='), F.regexp_replace("uri", "/", "%2F"), F.lit('">get</a>'))
    found = catalog.listing(_uris(spark, d).select(page.alias("value"))).distinct().withColumn("checksum", F.lit("A"))
    return catalog.dump_rows(found).select(F.col("dump_date").cast("string").alias("day"), "entity_type").distinct()


# Run control over modelled runs: J13-J19, A14-A16, C6-C9, P7-P9

_K = "cast(regexp_extract(props, '[0-9]+', 0) AS INT)"
_RUN_SQL = f"""ev AS (SELECT *, {_K} AS k FROM events), run AS (SELECT event_id AS id, cast(user_id AS VARCHAR) AS manifest, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS status,
    ts AS completed_at, k % 7 = 0 AS force_requested FROM ev),
  run_dump AS (SELECT event_id AS import_run_id, CASE k % 4 WHEN 0 THEN 'artist' WHEN 1 THEN 'label' WHEN 2 THEN 'master' ELSE 'release' END AS entity_type, cast(floor(k / 10) AS BIGINT) AS dump_id,
    CASE WHEN k % 4 = 3 THEN 3 ELSE 1 END AS revision, cast(5000 AS BIGINT) AS chunk_size, user_id AS processed_items, user_id AS total_items, cast(1 AS BIGINT) AS total_chunks, ts AS completed_at FROM ev),
  chunk AS (SELECT event_id AS import_run_id, r.entity_type, cast(0 AS BIGINT) AS chunk_index, cast(0 AS BIGINT) AS first_item_index, user_id + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS item_count FROM ev JOIN run_dump r ON r.import_run_id = event_id),
  dump AS (SELECT DISTINCT entity_type, dump_id AS id, date '2024-01-01' + cast(dump_id AS INT) AS dump_date, CASE WHEN dump_id % 3 = 0 THEN 'A' ELSE 'b' END AS checksum FROM run_dump)"""
_POINTS = """, point AS (SELECT entity_type, import_run_id, r.completed_at AS applied_at, dump_id, revision FROM run_dump JOIN run r ON r.id = import_run_id WHERE status = 'success'
    QUALIFY row_number() OVER (PARTITION BY entity_type ORDER BY r.completed_at DESC, import_run_id DESC) = 1)"""


def _runs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    ev = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"))
    status = F.when(F.col("event_type").isin("error", "view"), "failed").when(F.col("event_type") == "signup", "running").otherwise("success")
    entity = F.element_at(F.array(*[F.lit(e) for e in ENTITIES]), F.col("k") % 4 + 1)
    dump = F.floor(F.col("k") / 10)
    run = ev.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("manifest"), status.alias("status"), F.col("ts").alias("completed_at"), (F.col("k") % 7 == 0).alias("force_requested"))
    run_dumps = ev.select(
        F.col("event_id").alias("import_run_id"), entity.alias("entity_type"), dump.alias("dump_id"), runs.revision_of(entity, CONTRACT_REVISIONS).alias("revision"),
        F.lit(5000).cast("long").alias("chunk_size"), F.col("user_id").alias("processed_items"), F.col("user_id").alias("total_items"), F.lit(1).cast("long").alias("total_chunks"), F.col("ts").alias("completed_at"),
    )
    chunks = ev.select(F.col("event_id").alias("import_run_id"), entity.alias("entity_type"), F.lit(0).cast("long").alias("chunk_index"), F.lit(0).cast("long").alias("first_item_index"), (F.col("user_id") + F.when(F.col("k") % 5 == 0, 1).otherwise(0)).alias("item_count"))
    dumps = run_dumps.select("entity_type", F.col("dump_id").alias("id")).distinct().select("entity_type", "id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("dump_date"), F.when(F.col("id") % 3 == 0, "A").otherwise("b").alias("checksum"))
    points = dedupe.newest_per_group(
        run_dumps.select("import_run_id", "entity_type", "dump_id", "revision").join(run.filter("status = 'success'").select(F.col("id").alias("import_run_id"), F.col("completed_at").alias("applied_at")), "import_run_id"),
        ["entity_type"], [F.col("applied_at"), F.col("import_run_id")], ["import_run_id", "applied_at", "dump_id", "revision"],
    )
    return {"runs": run, "run_dumps": run_dumps, "chunks": chunks, "dumps": dumps, "points": points}


@query(f"WITH {_RUN_SQL}{_POINTS} SELECT entity_type, import_run_id, dump_id, revision FROM point")
def run_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d)["points"].select("entity_type", "import_run_id", "dump_id", "revision")


_COMPAT = """SELECT e.entity_type, e.dump_id, e.revision AS expected_revision, coalesce(p.dump_id = e.dump_id AND p.revision = e.revision AND NOT EXISTS (
    SELECT 1 FROM run_dump fd JOIN run f ON f.id = fd.import_run_id WHERE fd.entity_type = e.entity_type AND f.status = 'failed'
      AND (f.completed_at > p.applied_at OR (f.completed_at = p.applied_at AND f.id > p.import_run_id))), false) AS compatible
    FROM (SELECT DISTINCT entity_type, dump_id, revision FROM run_dump) e LEFT JOIN point p ON p.entity_type = e.entity_type"""


def _compatibility(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    expected = m["run_dumps"].select("entity_type", "dump_id", F.col("revision").alias("expected_revision")).distinct()
    failed = m["run_dumps"].join(m["runs"].filter("status = 'failed'").select(F.col("id").alias("import_run_id"), F.col("completed_at").alias("failed_at")), "import_run_id")
    return runs.checkpoint_compatibility(expected, m["points"], failed.select("entity_type", F.col("import_run_id").alias("id"), F.col("failed_at").alias("completed_at")))


@query(f"WITH {_RUN_SQL}{_POINTS} {_COMPAT}")
def checkpoint_compat(spark: SparkSession, d: str) -> DataFrame:
    return _compatibility(spark, d)


@query(
    f"""WITH {_RUN_SQL}{_POINTS}, c AS ({_COMPAT}) SELECT count(*) FILTER (WHERE compatible) AS compatible_entities, count(*) AS selected_entities,
    coalesce(string_agg(entity_type, ',' ORDER BY entity_type) FILTER (WHERE NOT compatible), '') AS incompatible FROM c"""
)
def checkpoint_summary(spark: SparkSession, d: str) -> DataFrame:
    return runs.compatibility_summary(_compatibility(spark, d))


@query(
    f"""WITH {_RUN_SQL}{_POINTS} SELECT r.id, r.manifest FROM run r WHERE r.manifest = '7' AND r.status = 'failed' AND NOT r.force_requested
    AND (SELECT count(*) FROM run_dump x WHERE x.import_run_id = r.id) = 1
    AND NOT EXISTS (SELECT 1 FROM run_dump x WHERE x.import_run_id = r.id AND x.processed_items <> (SELECT coalesce(sum(item_count), 0) FROM chunk c WHERE c.import_run_id = x.import_run_id AND c.entity_type = x.entity_type))
    AND NOT EXISTS (SELECT 1 FROM chunk c WHERE c.import_run_id = r.id AND (c.first_item_index <> c.chunk_index * 5000 OR c.item_count > 5000))
    AND NOT EXISTS (SELECT 1 FROM run_dump x JOIN point p ON p.entity_type = x.entity_type WHERE x.import_run_id = r.id AND (p.dump_id <> x.dump_id OR p.revision <> x.revision)
      AND (p.applied_at > r.completed_at OR (p.applied_at = r.completed_at AND p.import_run_id > r.id)))"""
)
def resumable_run(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    return runs.resumable_runs(m["runs"], m["run_dumps"], m["chunks"], m["points"], CONTRACT_REVISIONS, "7", 5000, 1).select("id", "manifest")


@query(
    f"""WITH {_RUN_SQL}{_POINTS} SELECT r.id AS import_run_id FROM run r WHERE status = 'failed' AND NOT EXISTS (
    SELECT 1 FROM run_dump x LEFT JOIN point p ON p.entity_type = x.entity_type WHERE x.import_run_id = r.id AND (p.dump_id IS DISTINCT FROM x.dump_id OR p.revision IS DISTINCT FROM x.revision))"""
)
def prune_superseded(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    return runs.superseded_failures(m["runs"], m["run_dumps"], m["points"])


@query(
    f"""WITH {_RUN_SQL} SELECT id, CASE WHEN status = 'running' AND EXISTS (SELECT 1 FROM run_dump x WHERE x.import_run_id = id AND x.entity_type IN ('artist', 'label')) THEN 'failed' ELSE status END AS status FROM run"""
)
def abandoned_runs(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    return runs.mark_abandoned(m["runs"], m["run_dumps"], ["artist", "label"], F.lit("2025-01-01").cast("timestamp")).select("id", "status")


@query(
    f"""WITH {_RUN_SQL}, joined AS (SELECT x.import_run_id, x.entity_type, count(c.chunk_index) AS n_chunks, coalesce(sum(c.item_count), 0)::BIGINT AS n_items,
      count(*) FILTER (WHERE c.first_item_index = c.chunk_index * x.chunk_size AND c.item_count <= x.chunk_size AND c.item_count > 0 AND c.first_item_index + c.item_count = x.total_items) AS valid_chunks,
      any_value(x.total_items) AS total_items FROM run_dump x LEFT JOIN chunk c ON c.import_run_id = x.import_run_id AND c.entity_type = x.entity_type GROUP BY 1, 2)
    SELECT import_run_id, entity_type, n_chunks, n_items, valid_chunks, n_chunks = 1 AND n_items = total_items AND valid_chunks = n_chunks AS complete FROM joined"""
)
def coverage_check(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    return ledger.coverage(m["chunks"], m["run_dumps"]).select("import_run_id", "entity_type", "n_chunks", "n_items", "valid_chunks", "complete")


@query(
    """WITH d AS (SELECT DISTINCT o_orderkey // 100 AS chunk_index FROM orders), l AS (SELECT DISTINCT l_orderkey // 100 AS chunk_index FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)
    SELECT chunk_index FROM d WHERE chunk_index NOT IN (SELECT chunk_index FROM l)"""
)
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    chunks = dedupe.count_windows(table(spark, d, "orders"), "o_orderkey", 100).select("chunk_index")
    done = table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity > 49").select(F.floor(F.col("l_orderkey") / 100).alias("chunk_index"))
    return ledger.pending_chunks(chunks, done)


@query(f"""WITH {_RUN_SQL}{_POINTS} SELECT c.entity_type, c.dump_date::DATE::VARCHAR AS dump_date, p.d::DATE::VARCHAR AS checkpoint_date FROM dump c
    JOIN (SELECT point.entity_type, dump.dump_date AS d FROM point JOIN dump ON dump.id = dump_id AND dump.entity_type = point.entity_type) p ON p.entity_type = c.entity_type WHERE c.dump_date < p.d""")
def downgrade_check(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    dated = m["points"].join(m["dumps"].select("entity_type", F.col("id").alias("dump_id"), "dump_date"), ["entity_type", "dump_id"])
    rows = runs.downgrades(m["dumps"].select("entity_type", "dump_date"), dated)
    return rows.select("entity_type", F.col("dump_date").cast("string").alias("dump_date"), F.col("checkpoint_date").cast("string").alias("checkpoint_date"))


@query(
    f"""WITH {_RUN_SQL}{_POINTS}, need AS (SELECT DISTINCT entity_type, date '2024-01-08' AS horizon FROM run_dump),
    have AS (SELECT p.entity_type, u.dump_date, u.checksum FROM point p JOIN dump u ON u.id = p.dump_id AND u.entity_type = p.entity_type),
    want AS (SELECT u.entity_type, u.dump_date, u.checksum FROM dump u JOIN need USING (entity_type) WHERE u.dump_date < horizon QUALIFY row_number() OVER (PARTITION BY u.entity_type ORDER BY u.dump_date DESC, u.id DESC) = 1)
    SELECT need.entity_type, CASE WHEN have.dump_date IS NULL THEN 'missing' WHEN have.dump_date >= horizon THEN 'newer' WHEN want.dump_date IS NULL THEN 'no provenance' WHEN have.dump_date < want.dump_date THEN 'stale'
      WHEN have.dump_date = want.dump_date AND lower(have.checksum) <> lower(want.checksum) THEN 'reissued' ELSE 'fine' END AS state
    FROM need LEFT JOIN have USING (entity_type) LEFT JOIN want USING (entity_type)"""
)
def stale_dependency(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    needs = m["run_dumps"].select("entity_type").distinct().withColumn("horizon", F.lit("2024-01-08").cast("date"))
    done = m["points"].join(m["dumps"].select("entity_type", F.col("id").alias("dump_id"), "dump_date", "checksum"), ["entity_type", "dump_id"])
    completed = done.select("entity_type", "dump_date", "checksum", F.col("applied_at").alias("completed_at"), "import_run_id")
    return runs.dependency_states(needs, completed, m["dumps"]).select("entity_type", "state")


@query(
    f"""WITH {_RUN_SQL}{_POINTS} SELECT s.entity_type, s.dump_id, s.processed_items, s.total_items, cast(-1 AS BIGINT) AS import_run_id FROM (SELECT DISTINCT entity_type, dump_id, revision FROM run_dump) e
    JOIN point p ON p.entity_type = e.entity_type JOIN run_dump s ON s.import_run_id = p.import_run_id AND s.entity_type = p.entity_type AND s.dump_id = e.dump_id AND s.revision = e.revision"""
)
def consolidated_run(spark: SparkSession, d: str) -> DataFrame:
    m = _runs(spark, d)
    expected = m["run_dumps"].select("entity_type", "dump_id", F.col("revision").alias("expected_revision")).distinct()
    return runs.consolidated(expected, m["points"], m["run_dumps"], -1).select("entity_type", "dump_id", "processed_items", "total_items", "import_run_id")


@query(
    f"""WITH {_RUN_SQL}, src AS (SELECT * FROM run_dump WHERE import_run_id = 0) SELECT t.import_run_id, coalesce(s.processed_items, t.processed_items) AS processed_items FROM run_dump t
    LEFT JOIN src s ON t.import_run_id = 5 AND s.entity_type = t.entity_type AND s.dump_id = t.dump_id AND s.chunk_size = t.chunk_size"""
)
def copy_progress(spark: SparkSession, d: str) -> DataFrame:
    return runs.copy_progress(_runs(spark, d)["run_dumps"], 0, 5).select("import_run_id", "processed_items")


@query(f"WITH {_RUN_SQL} SELECT id, manifest, completed_at::VARCHAR AS completed_at FROM run WHERE manifest = '7' AND status = 'success' ORDER BY run.completed_at DESC, id DESC LIMIT 1")
def newest_success(spark: SparkSession, d: str) -> DataFrame:
    """O1: one row by its definition."""
    out = runs.newest_success(_runs(spark, d)["runs"], "7")
    return out.select("id", "manifest", F.date_format("completed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("completed_at"))


@query(
    f"""WITH r AS (SELECT rtrim({_CASE}, 's') AS entity_type, o_orderdate::DATE AS dump_date, o_orderkey AS pos FROM orders WHERE {_CASE} <> 'images')
    SELECT entity_type, dump_date::VARCHAR AS dump_date, pos FROM r WHERE entity_type IN ('artist', 'release') QUALIFY row_number() OVER (PARTITION BY entity_type ORDER BY dump_date DESC, pos) = 1"""
)
def refresh_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The latest dump of each wanted entity, the first of equal dates."""
    rows = _uris(spark, d).withColumn("a", catalog.dump_address("uri")).filter("a.known")
    rows = rows.select(text.entity_name("a.kind").alias("entity_type"), F.col("a.dump_date").alias("dump_date"), F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("uri"))
    best = catalog.refresh_candidates(rows, ["release", "artist"], "pos")
    return best.select("entity_type", F.col("dump_date").cast("string").alias("dump_date"), F.col("uri").alias("pos"))


@query(
    """SELECT o_orderkey AS id, o_orderdate::DATE::VARCHAR AS dump_date FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1996-04-01'
    ORDER BY o_orderdate::DATE DESC, o_orderkey DESC LIMIT 1"""
)
def latest_in_month(spark: SparkSession, d: str) -> DataFrame:
    """The newest dump of an entity inside a month."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("entity_type"), F.to_date("o_orderdate").alias("dump_date"))
    return catalog.latest_dump(rows, "1-URGENT", F.lit("1996-03-01").cast("date")).select("id", F.col("dump_date").cast("string").alias("dump_date"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, count(*)::BIGINT AS n_rows FROM lineitem WHERE l_linenumber % 2 = 0 OR l_quantity >= 10 GROUP BY ALL"""
)
def quantity_check(spark: SparkSession, d: str) -> DataFrame:
    """stored pairs of number and text that are canonical; odd lines pad their text to two digits, which isn't below 10."""
    n = F.col("l_quantity").cast("int")
    stored = F.when(F.col("l_linenumber") % 2 == 0, n.cast("string")).otherwise(F.lpad(n.cast("string"), 2, "0"))
    good = table(spark, d, "lineitem").filter(numbers.quantity_consistent(n, stored))
    return _count("l_orderkey", "l_linenumber", "l_partkey")(good)


@query("SELECT doc_id, rtrim(lower(trim(lang)), 's') AS entity FROM documents WHERE lang IS NOT NULL AND lower(trim(lang)) NOT LIKE '%ss'")
def entity_normalise(spark: SparkSession, d: str) -> DataFrame:
    """F17; the SQL leaves out values that end in ss, as its rtrim takes all s."""
    rows = table(spark, d, "documents").filter("lang is not null")
    return rows.select("doc_id", text.entity_name("lang").alias("entity"))


@query(f"SELECT DISTINCT {_ws('country')} AS name FROM release_item WHERE {_ws('country')} IS NOT NULL ORDER BY name")
def dimension_sorted(spark: SparkSession, d: str) -> DataFrame:
    """Distinct non-blank names in order."""
    names = table(spark, d, "release_item").select(text.trim_to_null("country").alias("name")).filter("name is not null")
    return names.distinct().orderBy("name")


@query("SELECT user_id, event_id, round((value - first) / greatest(seconds, 1), 6) AS per_second FROM (SELECT user_id, event_id, value, min(value) OVER (PARTITION BY user_id) AS first, date_diff('second', TIMESTAMP '2024-01-01', ts) AS seconds FROM events)")
def progress_rate(spark: SparkSession, d: str) -> DataFrame:
    """items since the start of a run a second; a run's start is a user's least value."""
    ev = table(spark, d, "events")
    start = ev.groupBy("user_id").agg(F.min("value").alias("first"))
    seconds = F.greatest(F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp")), F.lit(1))
    rows = ev.join(start, "user_id")
    return rows.select("user_id", "event_id", F.round(numbers.rate(F.col("value"), F.col("first"), seconds), 6).alias("per_second"))
