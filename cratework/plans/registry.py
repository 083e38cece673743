"""The target tables: columns, keys, scopes, hash and digest fields. Everything table-specific is here."""

from __future__ import annotations

from dataclasses import dataclass

from cratework.functions.hashing import CATALOGUE_DOMAIN, RELEASE_DOMAIN, IdentityDomain


@dataclass(frozen=True)
class Table:
    """``key``: natural key. Root tables have ``business`` columns to compare. Hashed relations have a ``scope`` in which
    slots are given out, ``fields`` in digest order and the ``domain`` of their digests."""

    name: str
    entity: str
    key: tuple[str, ...]
    business: tuple[str, ...] = ()
    scope: tuple[str, ...] = ()
    fields: tuple[str, ...] = ()
    hash_fields: tuple[str, ...] = ()
    domain: IdentityDomain | None = None
    nullable: tuple[str, ...] = ()
    insert_only: tuple[str, ...] = ()

    @property
    def is_root(self) -> bool:
        return bool(self.business)

    @property
    def is_dimension(self) -> bool:
        return self.name in ("genre", "style")

    @property
    def root(self) -> str:
        return self.key[0]

    @property
    def match(self) -> tuple[str, ...]:
        """Columns by which stored and incoming rows are the same: the key, with the digest where there is one."""
        return (*self.key, "identity_sha256") if self.fields else self.key


def _root(name: str, entity: str, *business: str, insert_only: tuple[str, ...] = ()) -> Table:
    return Table(name, entity, ("id",), business=business, insert_only=insert_only)


def _pair(name: str, entity: str, parent: str, other: str) -> Table:
    return Table(name, entity, (parent, other))


def _hashed(name: str, entity: str, scope: tuple[str, ...], fields: tuple[str, ...], hash_fields: tuple[str, ...] | None = None) -> Table:
    domain = RELEASE_DOMAIN if entity == "release" else CATALOGUE_DOMAIN
    return Table(name, entity, (*scope, "hash"), scope=scope, fields=fields, hash_fields=hash_fields or fields, domain=domain)


_VIDEO = ("title", "description", "url")

TABLES = {
    t.name: t
    for t in (
        _root("artist", "artist", "name", "real_name", "profile", "data_quality"),
        _hashed("artist_url", "artist", ("artist_id",), ("url",)),
        _hashed("artist_name_variation", "artist", ("artist_id",), ("name_variation",)),
        _pair("artist_alias", "artist", "artist_id", "alias_id"),
        _pair("artist_group", "artist", "artist_id", "group_id"),
        _pair("artist_member", "artist", "artist_id", "member_id"),
        _root("label", "label", "name", "contact_info", "profile", "data_quality"),
        _hashed("label_url", "label", ("label_id",), ("url",)),
        _pair("label_sub_label", "label", "parent_label_id", "sub_label_id"),
        _root("master", "master", "title", "data_quality", "year", insert_only=("main_release_id",)),
        _pair("master_artist", "master", "master_id", "artist_id"),
        _pair("master_genre", "master", "master_id", "genre"),
        _pair("master_style", "master", "master_id", "style"),
        _hashed("master_video", "master", ("master_id",), _VIDEO),
        _root(
            "release_item", "release", "title", "country", "data_quality", "release_date", "has_valid_year", "has_valid_month",
            "has_valid_day", "listed_release_date", "is_master", "master_id", "notes", "status",
        ),
        _pair("release_item_artist", "release", "release_item_id", "artist_id"),
        _hashed("release_item_credited_artist", "release", ("release_item_id", "artist_id"), ("role",)),
        Table("label_release_item", "release", ("release_item_id", "label_id", "category_notation"), nullable=("category_notation",)),
        _hashed("release_item_work", "release", ("release_item_id", "label_id"), ("work",)),
        _hashed("release_item_format", "release", ("release_item_id",), ("name", "description", "quantity_text", "text")),
        _pair("release_item_genre", "release", "release_item_id", "genre"),
        _pair("release_item_style", "release", "release_item_id", "style"),
        _hashed("release_item_identifier", "release", ("release_item_id",), ("type", "description", "value")),
        _hashed("release_item_track", "release", ("release_item_id",), ("position", "title", "duration")),
        _hashed("release_item_video", "release", ("release_item_id",), _VIDEO),
        Table("release_item_image", "release", ("release_item_id", "hash")),
        Table("genre", "release", ("name",)),
        Table("style", "release", ("name",)),
    )
}

ENTITIES = ("artist", "label", "master", "release")
# The entities whose stored rows an import of the key needs.
DEPENDENCIES = {"artist": (), "label": (), "master": ("artist",), "release": ("artist", "label", "master")}
# revisions of the import contract; a change of digests or rules raises one.
CONTRACT_REVISIONS = {"artist": 1, "label": 1, "master": 1, "release": 3}


def key_columns(table: str) -> tuple[str, ...]:
    """the natural key of a table."""
    return TABLES[table].key


def tables_of(entity: str) -> list[Table]:
    return [t for t in TABLES.values() if t.entity == entity]
