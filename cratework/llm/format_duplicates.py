"""Duplicates hidden by formatting differences: one record for each canonical text, with the number of its copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratework.functions.text import letters_and_digits
from cratework.operators.skew import salted_join
from cratework.session import settle


def canonical_set(c: Column) -> Column:
    """Canonical text of a list of texts: letters and digits in lower case, empty ones dropped, a sorted set.

    A null list is an empty one. Elements are joined by a blank, which no canonical element can hold.
    """
    kept = F.filter(F.transform(c, letters_and_digits), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(kept)), " "), F.lit(""))


KEY_BYTES = 16


def _key(c: Column) -> Column:
    """128 bits of SHA-256: one in 10^18 odds of any clash among 10^10 texts."""
    return F.substring(F.unhex(F.sha2(c, 256)), 1, KEY_BYTES)


def raw_key(fields: Sequence[Column]) -> Column:
    """Key of the byte-exact content of the fields (lists of texts); nulls, blanks and order all count."""
    return _key(F.to_json(F.struct(*[c.alias(f"f{i}") for i, c in enumerate(fields)])))


def raw_groups(df: DataFrame, fields: dict[str, Column], record: str) -> DataFrame:
    """raw_key, first_record, n_copies and the canonical text of each field, a row a distinct raw content.

    Rows are grouped by the raw lists themselves, with counts, combined map-side, before anything is canonicalised.
    Records without anything left in any field are no cases and are dropped.
    """
    raw = df.select(F.col(record).alias("__record"), *[c.alias(f"__f{i}") for i, c in enumerate(fields.values())])
    lists = [F.col(f"__f{i}") for i in range(len(fields))]
    return (
        raw.groupBy(*lists)
        .agg(F.min("__record").alias("first_record"), F.count(F.lit(1)).alias("n_copies"))
        .select(raw_key(lists).alias("raw_key"), "first_record", "n_copies", *[canonical_set(c).alias(n) for n, c in zip(fields, lists)])
        .filter(F.concat(*fields) != "")
    )


def survivors_of(groups: DataFrame, names: Sequence[str]) -> DataFrame:
    """Raw groups grouped again on the full canonical text: the text, first_record and copies (counts summed)."""
    return groups.groupBy(*names).agg(F.min("first_record").alias("first_record"), F.sum("n_copies").alias("copies"))


def collapse(df: DataFrame, fields: dict[str, Column], record: str) -> DataFrame:
    """Collapse records that are the same but for formatting: canonical texts, first_record (the smallest), copies.

    A null ``record`` counts as a copy but is never first. Empty input gives no rows.
    """
    return survivors_of(raw_groups(df, fields, record), list(fields))


def copies_of(df: DataFrame, fields: dict[str, Column], record: str) -> DataFrame:
    """first_record_id, copy_record_id: one row for each record that isn't the smallest of its group.

    The survivors' first records go back to the raw groups by a key of the canonical text, and from there by the raw
    key to the records; hot keys are salted both times, the raw ones by the counts that the groups have already. The
    raw groups, which three steps use, are written once. No pairs within a group are formed.
    """
    names = list(fields)
    groups = settle(raw_groups(df, fields, record))
    text_key = _key(F.concat_ws("\n", *names)).alias("text_key")
    survivors = groups.groupBy(*names).agg(F.min("first_record").alias("first_record"), F.sum("n_copies").alias("copies"), F.count(F.lit(1)).alias("n_raw"))
    # groups of a single record have no copies and stay out of both joins
    first = survivors.filter("copies > 1").select(text_key, "first_record", "n_raw")
    named = salted_join(groups.select("raw_key", text_key, "n_copies"), first.drop("n_raw"), ["text_key"], "inner", counts=first.select("text_key", "n_raw"))
    named = named.select("raw_key", "first_record", "n_copies")
    records = df.select(F.col(record).alias("copy_record_id"), raw_key(list(fields.values())).alias("raw_key"))
    joined = salted_join(records, named.drop("n_copies"), ["raw_key"], "inner", counts=groups.select("raw_key", "n_copies"))
    return joined.filter(F.col("copy_record_id") > F.col("first_record")).select(F.col("first_record").alias("first_record_id"), "copy_record_id")
