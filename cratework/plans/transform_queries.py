"""Queries for the label, master and release transforms (T7-T26) over whole tables, with SQL.

The delivered tables hold nested records of artists only. Their lists serve as those of the other kinds: what is a link
to an artist there is a sub-label, credit, company, track or video here, so that every transform sees nulls, blanks,
padding, repeats and unknown ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.functions import hashing
from cratework.plans import transforms
from cratework.plans.registry import TABLES
from cratework.plans.relational_queries import _JAVA, _digest_sql, _ws
from cratework.session import table

QUERIES: dict = {}
ORACLE: dict = {}

_LINKS = ("aliases", "groups", "members")


def _structs(path: str, **fields: str):
    """A list of structs made of another list: each field is an SQL expression of element x and place i."""
    inner = ", ".join(f"'{n}', {e}" for n, e in fields.items())
    return F.expr(f"transform({path}, (x, i) -> named_struct({inner}))")


def _tables(spark: SparkSession, d: str, entity: str) -> dict[str, DataFrame]:
    xml = table(spark, d, "artist_xml")
    ids = table(spark, d, "artist_snapshot").select("id").distinct()
    known = {"artist": ids, "label": ids, "master": table(spark, d, "master").select("id").distinct()}
    if entity == "label":
        df = xml.select("id", "name", F.col("realname").alias("contactinfo"), "profile", "data_quality", "urls", F.struct(F.col("aliases.name").alias("label")).alias("sublabels"))
    elif entity == "master":
        df = xml.select(
            F.col("id").alias("_id"), F.col("id").alias("main_release"), F.col("name").alias("title"), "data_quality", F.expr("cast(id % 3000 as smallint)").alias("year"),
            F.struct(F.col("urls.url").alias("style")).alias("styles"), F.struct(F.col("namevariations.name").alias("genre")).alias("genres"),
            F.struct(_structs("members.name", id="x._id").alias("artist")).alias("artists"),
            F.struct(_structs("aliases.name", _src="x._VALUE", title="cast(i as string)", description="cast(null as string)").alias("video")).alias("videos"),
        )
    else:
        released = F.expr("if(id % 7 = 0, null, concat(1950 + id % 70, '-', lpad(id % 13, 2, '0'), '-', lpad(id % 32, 2, '0')))")
        df = xml.select(
            F.col("id").alias("_id"), F.col("data_quality").alias("_status"), F.col("name").alias("title"), F.col("realname").alias("country"), "data_quality",
            released.alias("released"), F.col("profile").alias("notes"), F.expr("named_struct('_VALUE', id, '_is_main_release', id % 2 = 0)").alias("master_id"),
            F.struct(_structs("members.name", id="x._id").alias("artist")).alias("artists"),
            F.struct(_structs("members.name", _id="x._id", _catno="x._VALUE").alias("label")).alias("labels"),
            F.struct(_structs("aliases.name", id="x._id", role="x._VALUE").alias("artist")).alias("extraartists"),
            F.struct(_structs("groups.name", id="x._id", entity_type_name="x._VALUE").alias("company")).alias("companies"),
            F.struct(_structs("urls.url", _name="x", _qty="concat(' 0', i + 1)", _text="cast(null as string)", descriptions="named_struct('description', namevariations.name)").alias("format")).alias("formats"),
            F.struct(F.col("namevariations.name").alias("genre")).alias("genres"), F.struct(F.col("urls.url").alias("style")).alias("styles"),
            F.struct(_structs("aliases.name", position="cast(i + 1 as string)", title="x._VALUE", duration="cast(null as string)").alias("track")).alias("tracklist"),
            F.struct(_structs("groups.name", _type="'Barcode'", _description="cast(null as string)", _value="x._VALUE").alias("identifier")).alias("identifiers"),
            F.struct(_structs("members.name", _src="x._VALUE", title="x._VALUE", description="cast(null as string)").alias("video")).alias("videos"),
        )
    return transforms.BUILDERS[entity](df, known, True) if entity == "master" else transforms.BUILDERS[entity](df, known)


def _add(name: str, entity: str, sql: str, columns: list[str]) -> None:
    def f(spark: SparkSession, d: str) -> DataFrame:
        rows = _tables(spark, d, entity)[name]
        digest = rows.columns and "identity_sha256" in rows.columns
        rows = rows.withColumn("digest", F.lower(F.hex("identity_sha256"))) if digest else rows
        return rows.select(*[F.col(c).cast("string").alias(c) if c == "release_date" else F.col(c) for c in columns]).distinct()

    key = f"{entity}_{name}_rows" if name in ("genre", "style") else f"{name}_rows"
    QUERIES[key], ORACLE[key] = f, sql


def _elements(path: str) -> str:
    return f"(SELECT id, unnest({path}) AS x, unnest(range(len({path}))) AS i FROM artist_xml WHERE len({path}) > 0)"


def _hashed(name: str, entity: str, path: str, extra: dict[str, str], fields: dict[str, str], keep: str = "true", with_hash: bool = True) -> None:
    """A relation with hash and digest: scope columns from ``extra``, trimmed fields; rows without any field go."""
    t = TABLES[name]
    parent, scope = t.scope[0], ", ".join(t.scope)
    cols = ", ".join([f"id AS {parent}", *[f"{e} AS {n}" for n, e in extra.items()], *[f"{_ws(e)} AS {n}" for n, e in fields.items()]])
    some = " OR ".join(f"{n} IS NOT NULL" for n in fields)
    base = f"(SELECT DISTINCT * FROM (SELECT {cols} FROM {_elements(path)}) WHERE ({some}) AND {keep})"
    digest = _digest_sql(t.domain, name, list(t.fields))
    names = ", ".join([scope, *fields])
    if with_hash:
        source = " || ".join(f"coalesce({n}, '')" for n in t.hash_fields)
        hashes = _JAVA.format(key=names, col="src", table=f"(SELECT *, {source} AS src FROM {base})")
        _add(name, entity, f"SELECT {names}, hash, {digest} AS digest FROM ({hashes})", [*t.scope, *fields, "hash", "digest"])
    else:
        _add(name, entity, f"SELECT {names}, {digest} AS digest FROM {base}", [*t.scope, *fields, "digest"])


def _pairs(name: str, entity: str, path: str, value: str, keep: str) -> None:
    a, b = TABLES[name].key
    _add(name, entity, f"SELECT DISTINCT id AS {a}, v AS {b} FROM (SELECT id, {value} AS v FROM {_elements(path)}) WHERE {keep}", [a, b])


_KNOWN = "{0} >= 1 AND {0} IN (SELECT id FROM artist_snapshot)"
_ID = _KNOWN.format("v")

_add("label", "label", f"SELECT DISTINCT id, {_ws('name')} AS name, {_ws('realname')} AS contact_info, {_ws('profile')} AS profile, {_ws('data_quality')} AS data_quality FROM artist_xml", ["id", "name", "contact_info", "profile", "data_quality"])
_hashed("label_url", "label", "urls.url", {}, {"url": "x"})
_pairs("label_sub_label", "label", "aliases.name", "x._id", _ID)

_add("master", "master", f"SELECT DISTINCT id, {_ws('name')} AS title, {_ws('data_quality')} AS data_quality, (id % 3000)::SMALLINT AS year, id AS main_release_id FROM artist_xml", ["id", "title", "data_quality", "year", "main_release_id"])
_pairs("master_style", "master", "urls.url", _ws("x"), "v IS NOT NULL")
_pairs("master_genre", "master", "namevariations.name", _ws("x"), "v IS NOT NULL")
_pairs("master_artist", "master", "members.name", "x._id", _ID)
_hashed("master_video", "master", "aliases.name", {}, {"title": "i::VARCHAR", "description": "NULL::VARCHAR", "url": "x._VALUE"})
for _name, _path in (("genre", "namevariations.name"), ("style", "urls.url")):
    for _entity in ("master", "release"):
        _add(_name, _entity, f"SELECT DISTINCT {_ws('x')} AS name FROM {_elements(_path)} WHERE {_ws('x')} IS NOT NULL", ["name"])

_Y, _M, _D = "(1950 + id % 70)", "(id % 13)", "(id % 32)"
_DAY = f"try_strptime(printf('%04d-%02d-%02d', {_Y}, {_M}, {_D}), '%Y-%m-%d')"
_ROOT = f"""SELECT DISTINCT id, {_ws('name')} AS title, {_ws('realname')} AS country, {_ws('data_quality')} AS data_quality,
  CASE WHEN ok THEN printf('%04d-%02d-%02d', {_Y}, greatest({_M}, 1), CASE WHEN {_M} = 0 THEN 1 ELSE greatest({_D}, 1) END) END AS release_date,
  ok AS has_valid_year, ok AND {_M} > 0 AS has_valid_month, ok AND {_M} > 0 AND {_D} > 0 AS has_valid_day,
  CASE WHEN id % 7 <> 0 THEN printf('%04d-%02d-%02d', {_Y}, {_M}, {_D}) END AS listed_release_date,
  id % 2 = 0 AS is_master, CASE WHEN id >= 1 AND id IN (SELECT id FROM master) THEN id END AS master_id, {_ws('profile')} AS notes, {_ws('data_quality')} AS status
  FROM (SELECT *, id % 7 <> 0 AND ({_M} = 0 OR {_D} = 0 OR {_DAY} IS NOT NULL) AS ok FROM artist_xml)"""
_add("release_item", "release", _ROOT, ["id", *TABLES["release_item"].business])
_pairs("release_item_artist", "release", "members.name", "x._id", _ID)
_hashed("release_item_credited_artist", "release", "aliases.name", {"artist_id": "x._id"}, {"role": "x._VALUE"}, _KNOWN.format("artist_id"))
_add("label_release_item", "release", f"SELECT DISTINCT id AS release_item_id, x._id AS label_id, {_ws('x._VALUE')} AS category_notation FROM {_elements('members.name')} WHERE {_KNOWN.format('x._id')}", ["release_item_id", "label_id", "category_notation"])
_hashed("release_item_work", "release", "groups.name", {"label_id": "x._id"}, {"work": "x._VALUE"}, _KNOWN.format("label_id"))
_pairs("release_item_genre", "release", "namevariations.name", _ws("x"), "v IS NOT NULL")
_pairs("release_item_style", "release", "urls.url", _ws("x"), "v IS NOT NULL")
_hashed("release_item_track", "release", "aliases.name", {}, {"position": "(i + 1)::VARCHAR", "title": "x._VALUE", "duration": "NULL::VARCHAR"})
_hashed("release_item_identifier", "release", "groups.name", {}, {"type": "'Barcode'", "description": "NULL::VARCHAR", "value": "x._VALUE"})
_hashed("release_item_video", "release", "members.name", {}, {"title": "x._VALUE", "description": "NULL::VARCHAR", "url": "x._VALUE"})

_REDUCED = f"""nullif(list_aggregate(list_transform(list_filter(list_transform(names, lambda n: {_ws('n')}), lambda n: n IS NOT NULL), lambda n: '[d:' || n || ']'), 'string_agg', ','), '')"""
_FORMATS = f"""SELECT DISTINCT id AS release_item_id, {_ws('x')} AS name, {_REDUCED} AS description, i + 1 AS quantity, (i + 1)::VARCHAR AS quantity_text, NULL::VARCHAR AS text
  FROM (SELECT id, unnest(urls.url) AS x, unnest(range(len(urls.url))) AS i, namevariations.name AS names FROM artist_xml WHERE len(urls.url) > 0)"""
_add(
    "release_item_format", "release",
    f"""SELECT release_item_id, name, description, quantity::INT AS quantity, quantity_text, text, {_digest_sql(hashing.RELEASE_DOMAIN, 'release_item_format', ['name', 'description', 'quantity_text', 'text'])} AS digest
    FROM ({_FORMATS}) WHERE name IS NOT NULL OR description IS NOT NULL""",
    ["release_item_id", "name", "description", "quantity", "quantity_text", "text", "digest"],
)
