"""Converging stored tables to a new dump: change-only upsert, insert-or-ignore, stale-row removal, back-links.

Parquet tables have no row-level operations, so each operator returns the whole next version of a table as one
declarative plan; a version is published at once (plans/store.py).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratework.operators.dedupe import newest_per_group
from cratework.operators.skew import fresh, salted_join


def _match(left: DataFrame, right: DataFrame, columns: Sequence[str], null_safe: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & (left[c].eqNullSafe(right[c]) if c in null_safe else left[c] == right[c])
    return on


def matched(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str, null_safe: Sequence[str] = ()) -> DataFrame:
    """Semi or anti join on ``columns``; those in ``null_safe`` match null with null, the others never match on null."""
    if not null_safe:
        return left.join(right.select(*columns).distinct(), list(columns), how).select(*left.columns)
    other = right.select(*[F.col(c).alias(f"__r_{c}") for c in columns]).distinct()
    on = F.lit(True)
    for c in columns:
        on = on & (F.col(c).eqNullSafe(F.col(f"__r_{c}")) if c in null_safe else F.col(c) == F.col(f"__r_{c}"))
    return left.join(other, on, how)


def upsert_if_changed(stored: DataFrame, incoming: DataFrame, key: str, business: Sequence[str], modified: str | None = None, status: bool = False) -> DataFrame:
    """M1: insert new keys, update business columns (and ``modified``) only where one of them differs, keep all else.

    Both sides are unique by ``key``, which must not be null; the result has the columns of ``stored``. Stored
    rows without an incoming one stay. ``status`` adds 'inserted', 'updated', 'unchanged' or 'retained'. One full
    outer join, no second pass.
    """
    s = stored.select(F.col(key).alias("__sk"), F.struct(*stored.columns).alias("__s"))
    i = incoming.select(F.col(key).alias("__ik"), F.struct(*incoming.columns).alias("__i"))
    both = s.join(i, F.col("__sk") == F.col("__ik"), "full")
    old, new = F.col("__s"), F.col("__i")
    same = reduce(lambda a, b: a & b, [old[c].eqNullSafe(new[c]) for c in business], F.lit(True))
    state = F.when(new.isNull(), "retained").when(old.isNull(), "inserted").when(same, "unchanged").otherwise("updated")
    both = both.withColumn("__state", state)
    taken = [*business, *([modified] if modified else [])]
    out = []
    for c in stored.columns:
        there = new[c] if c in incoming.columns else F.lit(None)
        value = F.when(F.col("__state") == "inserted", there)
        if c in taken:
            value = value.when(F.col("__state") == "updated", there)
        out.append(value.otherwise(old[c]).alias(c))
    return both.select(*out, *([F.col("__state").alias("status")] if status else []))


def insert_or_ignore(stored: DataFrame, incoming: DataFrame, key: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """M2/K3/K4: stored rows as they are and the incoming rows whose key isn't stored (incoming unique by key)."""
    return stored.unionByName(matched(incoming, stored, key, "left_anti", null_safe), allowMissingColumns=True)


def converge_relation(
    stored: DataFrame, incoming: DataFrame, roots: DataFrame, root: str, match: Sequence[str], null_safe: Sequence[str] = (), provenance: bool = False
) -> DataFrame:
    """M3/M4/M7 with J3-J8: the next version of a child table.

    ``roots`` has the touched parents (all parents of the dump, those with an empty list included). Rows of other
    parents stay; rows of touched parents stay as stored if the dump has them (on ``match``), else they go; new
    rows come in. ``provenance`` adds 'untouched', 'retained' or 'new'. A null in a match column that isn't
    ``null_safe`` never matches, so such a stored row is replaced.
    """
    touched = roots.select(root).distinct()
    columns = stored.columns
    tag = (lambda df, what: df.withColumn("provenance", F.lit(what))) if provenance else (lambda df, what: df)
    untouched = stored.join(touched, root, "left_anti").select(*columns)
    mine = stored.join(touched, root, "left_semi").select(*columns)
    retained = matched(mine, incoming, match, "left_semi", null_safe)
    new = matched(incoming, stored, match, "left_anti", null_safe)
    missing = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in columns if c not in incoming.columns]
    new = new.select(*[c for c in columns if c in incoming.columns], *missing).select(*columns)
    return reduce(DataFrame.unionByName, [tag(untouched, "untouched"), tag(retained, "retained"), tag(new, "new")])


def stale_rows(stored: DataFrame, incoming: DataFrame, roots: DataFrame, root: str, match: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """The stored rows of touched parents that the dump no longer has."""
    mine = stored.join(roots.select(root).distinct(), root, "left_semi").select(*stored.columns)
    return matched(mine, incoming, match, "left_anti", null_safe)


def existing_roots(tables: Sequence[tuple[str, DataFrame, str]], roots: DataFrame, root: str) -> DataFrame:
    """table_name and root of the touched roots that already have rows, a row a table."""
    wanted = roots.select(F.col(root).alias("root")).distinct()
    parts = [df.select(F.col(c).alias("root")).distinct().join(wanted, "root", "left_semi").select(F.lit(n).alias("table_name"), "root") for n, df, c in tables]
    return reduce(DataFrame.unionByName, parts)


def keep_known(df: DataFrame, column: str, known: DataFrame, known_id: str = "id") -> DataFrame:
    """Rows whose id is known; null ids and ids below 1 never are. Hot ids are salted."""
    ids = known.select(F.col(known_id).alias(column)).filter(F.col(column) >= 1).distinct()
    return salted_join(df.filter(F.col(column) >= 1), ids, [column], "left_semi").select(*df.columns)


def null_unknown(df: DataFrame, column: str, known: DataFrame, known_id: str = "id") -> DataFrame:
    """The row is kept, an unknown id becomes null. Hot ids are salted; rows without an id take part in no join."""
    seen = fresh("known")
    ids = known.select(F.col(known_id).alias(column)).filter(F.col(column) >= 1).distinct().withColumn(seen, F.lit(True))
    joined = salted_join(df.filter(F.col(column) >= 1), ids, [column], "left")
    rest = df.filter(F.coalesce(F.col(column) < 1, F.lit(True)))
    none = F.lit(None).cast(df.schema[column].dataType)
    pick = lambda x, value: x.select(*[value.alias(c) if c == column else F.col(c) for c in df.columns])
    return pick(joined, F.when(F.col(seen), F.col(column))).unionAll(pick(rest, none))


def latest_backlinks(children: DataFrame, parent: str, child: str, order: Sequence[Column], eligible: Column) -> DataFrame:
    """Parent and the newest eligible child of each parent (ties by the greatest child id)."""
    rows = children.filter(eligible & F.col(parent).isNotNull())
    return newest_per_group(rows, [parent], [*order, F.col(child)], [child])


def reconcile_backlinks(
    parents: DataFrame, children: DataFrame, parent_id: str, pointer: str, parent: str, child: str, order: Sequence[Column], eligible: Column, status: bool = False
) -> DataFrame:
    """M5 with J11/J12: each parent points to its newest eligible child, or to nothing if it has none.

    Clearing and setting are one rewrite: a pointer that still qualifies but isn't the newest moves, one that
    doesn't qualify any more is cleared, because the newest child is the only value that can stay. No other
    column changes. ``status`` adds 'set', 'moved', 'cleared' or 'unchanged'.
    """
    newest = latest_backlinks(children, parent, child, order, eligible).select(F.col(parent).alias("__p"), F.col(child).alias("__c"))
    joined = parents.join(newest, F.col(parent_id) == F.col("__p"), "left")
    old, new = F.col(pointer), F.col("__c")
    state = F.when(old.eqNullSafe(new), "unchanged").when(old.isNull(), "set").when(new.isNull(), "cleared").otherwise("moved")
    return joined.select(*[new.alias(c) if c == pointer else F.col(c) for c in parents.columns], *([state.alias("status")] if status else []))


def stale_backlinks(parents: DataFrame, children: DataFrame, parent_id: str, pointer: str, parent: str, child: str, eligible: Column) -> DataFrame:
    """The parents whose pointer is to no eligible child of theirs (NOT EXISTS on three conditions)."""
    good = children.filter(eligible).select(F.col(parent).alias(parent_id), F.col(child).alias(pointer)).distinct()
    return parents.filter(F.col(pointer).isNotNull()).join(good, [parent_id, pointer], "left_anti").select(*parents.columns)


def fk_violations(children: DataFrame, column: str, parents: DataFrame, parent_id: str) -> DataFrame:
    """Child rows whose non-null reference is in no parent row."""
    ids = parents.select(F.col(parent_id).alias(column)).distinct()
    return children.filter(F.col(column).isNotNull()).join(ids, column, "left_anti").select(*children.columns)
