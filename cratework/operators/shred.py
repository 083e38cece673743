"""Deeply nested records into related flat tables.

A record is read once and turned into path-value-ordinal triples; the paths are grouped by the repeated
ancestor (the innermost array on the way) they hang under, and each group is pivoted into one table whose rows
keep the record key and their place (one ordinal per array on the way, from 1). The schema is walked on the
driver, so the plan is one projection and one generator: there is no shuffle, and a record with very many
elements streams through the generator.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Group:
    """The leaf paths below one repeated ancestor; ``steps`` are the field names, ``[]`` marks an array."""

    path: str
    steps: tuple[str, ...]
    leaves: tuple[tuple[str, tuple[str, ...], T.DataType], ...]

    @property
    def depth(self) -> int:
        return self.steps.count("[]")


def repeated_groups(schema: T.StructType, skip: Sequence[str] = ()) -> list[Group]:
    """The groups of a schema, outer ones first; leaves not under any array form the root group (path ``""``)."""
    found: dict[tuple[str, ...], list] = {(): []}

    def walk(kind: T.DataType, anchor: tuple[str, ...], inner: tuple[str, ...]) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, anchor, (*inner, f.name))
        elif isinstance(kind, T.ArrayType):
            deeper = (*anchor, *inner, "[]")
            found.setdefault(deeper, [])
            walk(kind.elementType, deeper, ())
        else:
            found[anchor].append((".".join(inner) or "value", inner, kind))

    for f in schema.fields:
        if f.name not in skip:
            walk(f.dataType, (), (f.name,))
    return [
        Group(".".join(s for s in steps if s != "[]"), steps, tuple(leaves))
        for steps, leaves in found.items()
        if leaves
    ]


def _down(c: Column, steps: Sequence[str]) -> Column:
    for s in steps:
        c = c.getField(s)
    return c


def _elements(root: str, steps: Sequence[str], leaves: Sequence) -> Column:
    """array<struct<ordinals array<int>, triples map<path, value>>> of one group of one record."""

    def level(c: Column, rest: list[str], ordinals: Column) -> Column:
        if "[]" not in rest:
            pairs = []
            for name, inner, _ in leaves:
                pairs += [F.lit(name), _down(_down(c, rest), inner).cast("string")]
            return F.array(F.struct(ordinals.alias("ordinals"), F.create_map(*pairs).alias("leaves")))
        at = rest.index("[]")
        items = _down(c, rest[:at])
        inner = F.transform(items, lambda x, i: level(x, rest[at + 1 :], F.concat(ordinals, F.array(i + 1))))
        return F.flatten(F.filter(inner, lambda x: x.isNotNull()))

    return level(F.col(f"`{root}`"), list(steps), F.array().cast("array<int>"))


def triples(df: DataFrame, key: Sequence[str], groups: Sequence[Group] | None = None) -> DataFrame:
    """key columns, group, ordinals (array of int, from 1), path, value: one row for each leaf of each element.

    Values are text. Null, missing and empty containers give no rows; a null element keeps its place and gives
    null values. Columns named like the output (``group``, ``path``...) in ``df`` do no harm unless they are keys.
    """
    rows = grouped_triples(df, key, groups)
    return rows.select(*key, "group", "ordinals", F.explode("leaves").alias("path", "value"))


def grouped_triples(df: DataFrame, key: Sequence[str], groups: Sequence[Group] | None = None) -> DataFrame:
    """As ``triples``, with the triples of one element still side by side in a map: key, group, ordinals, leaves."""
    groups = [g for g in (groups or repeated_groups(df.schema, key)) if g.steps]

    def tagged(g: Group) -> Column:
        tag = lambda x: F.struct(F.lit(g.path).alias("group"), x["ordinals"].alias("ordinals"), x["leaves"].alias("leaves"))
        return F.transform(_elements(g.steps[0], g.steps[1:], g.leaves), tag)

    lists = F.filter(F.array(*[tagged(g) for g in groups]), lambda x: x.isNotNull())
    rows = df.select(*key, F.explode(F.flatten(lists)).alias("__e"))
    return rows.select(*key, "__e.group", "__e.ordinals", "__e.leaves")


def pivot_group(rows: DataFrame, key: Sequence[str], group: Group) -> DataFrame:
    """One flat table of a group: key, ordinal_1 .. ordinal_n (outermost first), a typed column a leaf path."""
    return rows.filter(F.col("group") == group.path).select(
        *key,
        *[F.col("ordinals")[i].alias(f"ordinal_{i + 1}") for i in range(group.depth)],
        *[F.element_at("leaves", F.lit(name)).cast(kind).alias(name.replace(".", "_")) for name, _, kind in group.leaves],
    )


def shred(df: DataFrame, key: Sequence[str]) -> dict[str, DataFrame]:
    """All flat tables of nested records by the path of their repeated ancestor; ``""`` holds the record's own leaves.

    Each table is a plan of its own over the column it comes from. Child rows carry the record key and all ordinals of their parents, so every level can be joined to the one
    above it. Empty input gives empty tables of the same schemas.
    """
    groups = repeated_groups(df.schema, key)
    nested = [g for g in groups if g.steps]
    out = {}
    for g in groups:
        if not g.steps:
            out[""] = df.select(*key, *[_down(F.col(f"`{inner[0]}`"), inner[1:]).alias(name.replace(".", "_")) for name, inner, _ in g.leaves])
    for g in nested:  # each from its own column, so that the others aren't read
        out[g.path] = pivot_group(grouped_triples(df.select(*key, g.steps[0]), key, [g]), key, g)
    return out
