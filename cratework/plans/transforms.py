"""Records to typed rows: for each target table explode, project, drop the invalid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratework.functions.dates import parse_partial_date, release_date
from cratework.functions.hashing import identity_digest, java_hash
from cratework.functions.numbers import quantity
from cratework.functions.text import format_hash_source, or_empty, reduce_descriptions, trim_to_null
from cratework.operators.converge import keep_known, null_unknown
from cratework.operators.dedupe import digest_dedupe, keyed_dedupe
from cratework.operators.slots import allocate_slots
from cratework.plans.registry import TABLES, Table


def _children(df: DataFrame, parent: Column, name: str, path: str) -> DataFrame:
    return df.select(parent.alias(name), F.explode(path).alias("e"))


def with_identity(df: DataFrame, t: Table, hash_source: Column | None = None) -> DataFrame:
    """Adds legacy ``hash`` and ``identity_sha256`` of a hashed relation."""
    source = hash_source if hash_source is not None else F.concat(*[or_empty(c) for c in t.hash_fields])
    return df.withColumn("hash", java_hash(source)).withColumn("identity_sha256", identity_digest(t.domain, t.name, [F.col(c) for c in t.fields]))


def canonical(df: DataFrame, t: Table, check: bool = False) -> DataFrame:
    """Canonical rows of a table: exact repeats collapse, conflicting ones fail, colliding hashes get slots."""
    if t.fields:
        payload = [c for c in df.columns if c not in (*t.scope, "identity_sha256", "hash")]
        rows = digest_dedupe(df, t.scope, "identity_sha256", "hash", payload, t.name, check)
        slotted = allocate_slots(rows, t.scope, "hash", "identity_sha256", t.domain, t.name)
        return slotted.withColumn("hash", F.col("slot")).drop("slot")
    if t.is_dimension:
        return df.distinct()
    payload = [c for c in df.columns if c not in (*t.key, *t.insert_only, "created_at", "last_modified_at")]
    return keyed_dedupe(df, t.key, payload, name=t.name, check=check)


def _texts(df: DataFrame, parent: Column, table: str, path: str, column: str) -> DataFrame:
    t = TABLES[table]
    rows = _children(df, parent, t.scope[0], path).select(t.scope[0], trim_to_null("e").alias(column)).filter(F.col(column).isNotNull())
    return with_identity(rows, t)


def _links(df: DataFrame, parent: Column, table: str, path: str, field: str, known: DataFrame) -> DataFrame:
    a, b = TABLES[table].key
    rows = _children(df, parent, a, path).select(a, F.col(f"e.{field}").alias(b))
    return keep_known(rows, b, known)


def _names(df: DataFrame, parent: Column, table: str, path: str) -> DataFrame:
    a, b = TABLES[table].key
    return _children(df, parent, a, path).select(a, trim_to_null("e").alias(b)).filter(F.col(b).isNotNull()).distinct()


def _any(*columns: str) -> Column:
    return F.coalesce(*columns).isNotNull()


def _videos(df: DataFrame, parent: Column, table: str) -> DataFrame:
    t = TABLES[table]
    rows = _children(df, parent, t.scope[0], "videos.video").select(
        t.scope[0], trim_to_null("e._src").alias("url"), trim_to_null("e.title").alias("title"), trim_to_null("e.description").alias("description")
    )
    return with_identity(rows.filter(_any("title", "description", "url")), t)


def artist_tables(df: DataFrame, known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """T1-T6."""
    root = df.select("id", trim_to_null("name").alias("name"), trim_to_null("realname").alias("real_name"), trim_to_null("profile").alias("profile"), trim_to_null("data_quality").alias("data_quality"))
    i, artists = F.col("id"), known["artist"]
    return {
        "artist": root,
        "artist_url": _texts(df, i, "artist_url", "urls.url", "url"),
        "artist_name_variation": _texts(df, i, "artist_name_variation", "namevariations.name", "name_variation"),
        "artist_alias": _links(df, i, "artist_alias", "aliases.name", "_id", artists),
        "artist_group": _links(df, i, "artist_group", "groups.name", "_id", artists),
        "artist_member": _links(df, i, "artist_member", "members.name", "_id", artists),
    }


def label_tables(df: DataFrame, known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """T7-T9."""
    root = df.select("id", trim_to_null("name").alias("name"), trim_to_null("contactinfo").alias("contact_info"), trim_to_null("profile").alias("profile"), trim_to_null("data_quality").alias("data_quality"))
    return {
        "label": root,
        "label_url": _texts(df, F.col("id"), "label_url", "urls.url", "url"),
        "label_sub_label": _links(df, F.col("id"), "label_sub_label", "sublabels.label", "_id", known["label"]),
    }


def master_tables(df: DataFrame, known: dict[str, DataFrame], seed_main_release: bool = False) -> dict[str, DataFrame]:
    """T10-T14; main_release is taken only for the first import of releases."""
    i = F.col("_id")
    main = F.col("main_release") if seed_main_release else F.lit(None).cast("int")
    root = df.select(i.alias("id"), trim_to_null("title").alias("title"), trim_to_null("data_quality").alias("data_quality"), "year", main.alias("main_release_id"))
    return {
        "master": root,
        "master_style": _names(df, i, "master_style", "styles.style"),
        "master_genre": _names(df, i, "master_genre", "genres.genre"),
        "master_video": _videos(df, i, "master_video"),
        "master_artist": _links(df, i, "master_artist", "artists.artist", "id", known["artist"]),
        "genre": dimension(df, "genres.genre"),
        "style": dimension(df, "styles.style"),
    }


def dimension(df: DataFrame, path: str) -> DataFrame:
    """Distinct non-blank names."""
    names = df.select(F.explode(path).alias("e")).select(trim_to_null("e").alias("name"))
    return names.filter(F.col("name").isNotNull()).distinct()


def release_formats(df: DataFrame) -> DataFrame:
    """A row without name, description and text is dropped, whatever its quantity; a bad quantity fails the job."""
    t = TABLES["release_item_format"]
    rows = _children(df, F.col("_id"), "release_item_id", "formats.format").withColumn("q", quantity("e._qty"))
    message = F.concat(F.lit("release_item_format: bad quantity in release "), F.col("release_item_id").cast("string"), F.lit(": "), F.col("e._qty"))
    rows = rows.filter(F.when(F.col("q.valid"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    rows = rows.select(
        "release_item_id", trim_to_null("e._name").alias("name"), reduce_descriptions("e.descriptions.description").alias("description"),
        F.col("q.quantity").alias("quantity"), F.col("q.quantity_text").alias("quantity_text"), trim_to_null("e._text").alias("text"),
    )
    source = format_hash_source(*[F.col(c) for c in ("name", "description", "quantity_text", "text")])
    return with_identity(rows.filter(_any("name", "description", "text")), t, source)


def release_tables(df: DataFrame, known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """T15-T26."""
    i = F.col("_id")
    date = df.withColumn("d", parse_partial_date("released"))
    root = date.select(
        i.alias("id"), trim_to_null("title").alias("title"), trim_to_null("country").alias("country"), trim_to_null("data_quality").alias("data_quality"),
        release_date(F.col("d")).alias("release_date"), F.col("d.year").isNotNull().alias("has_valid_year"), F.col("d.month").isNotNull().alias("has_valid_month"),
        F.col("d.day").isNotNull().alias("has_valid_day"), trim_to_null("released").alias("listed_release_date"),
        F.col("master_id._is_main_release").alias("is_master"), F.col("master_id._VALUE").alias("master_id"), trim_to_null("notes").alias("notes"), trim_to_null("_status").alias("status"),
    )
    r = "release_item_id"

    def fields(table: str, path: str, names: dict[str, str]) -> DataFrame:
        rows = _children(df, i, r, path).select(r, *[trim_to_null(f"e.{f}").alias(n) for n, f in names.items()])
        return with_identity(rows.filter(_any(*names)), TABLES[table])

    credited = _children(df, i, r, "extraartists.artist").select(r, F.col("e.id").alias("artist_id"), trim_to_null("e.role").alias("role"))
    works = _children(df, i, r, "companies.company").select(r, F.col("e.id").alias("label_id"), trim_to_null("e.entity_type_name").alias("work"))
    labels = _children(df, i, r, "labels.label").select(r, F.col("e._id").alias("label_id"), trim_to_null("e._catno").alias("category_notation"))
    return {
        "release_item": null_unknown(root, "master_id", known["master"]),
        "release_item_artist": _links(df, i, "release_item_artist", "artists.artist", "id", known["artist"]),
        "release_item_credited_artist": with_identity(keep_known(credited.filter(F.col("role").isNotNull()), "artist_id", known["artist"]), TABLES["release_item_credited_artist"]),
        "label_release_item": keep_known(labels, "label_id", known["label"]).distinct(),
        "release_item_work": with_identity(keep_known(works.filter(F.col("work").isNotNull()), "label_id", known["label"]), TABLES["release_item_work"]),
        "release_item_format": release_formats(df),
        "release_item_genre": _names(df, i, "release_item_genre", "genres.genre"),
        "release_item_style": _names(df, i, "release_item_style", "styles.style"),
        "release_item_identifier": fields("release_item_identifier", "identifiers.identifier", {"type": "_type", "description": "_description", "value": "_value"}),
        "release_item_track": fields("release_item_track", "tracklist.track", {"position": "position", "title": "title", "duration": "duration"}),
        "release_item_video": _videos(df, i, "release_item_video"),
        "genre": dimension(df, "genres.genre"),
        "style": dimension(df, "styles.style"),
    }


BUILDERS = {"artist": artist_tables, "label": label_tables, "master": master_tables, "release": release_tables}


def observed(df: DataFrame, t: Table, at: Column) -> DataFrame:
    """One observation instant for all rows of a run: created_at for roots, last_modified_at for all."""
    stamped = df.withColumn("created_at", at) if t.is_root else df
    return stamped if t.is_dimension else stamped.withColumn("last_modified_at", at)


def known_ids(current: DataFrame | None, stored: DataFrame | None, strict: bool = False) -> DataFrame:
    """The ids that references may point to: those of the dump and, unless ``strict``, those stored before."""
    parts = [x.select("id") for x in ((current,) if strict and current is not None else (current, stored)) if x is not None]
    return reduce(DataFrame.union, parts).distinct()
