"""Queries p4 and p7-p9, with SQL where it can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.functions.text import WHITE_SPACE
from cratework.llm import format_duplicates, leakage, mixing, stuffing
from cratework.session import table


def _p4_fields() -> dict:
    return {"urls": F.col("urls.url"), "names": F.col("namevariations.name")}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "artist_xml").select("record_id", "urls", "namevariations")
    return format_duplicates.copies_of(rows, _p4_fields(), "record_id").distinct()


def p4_collapsed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "artist_xml").select("record_id", "urls", "namevariations")
    return format_duplicates.collapse(rows, _p4_fields(), "record_id").select("first_record", "copies")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    exact = F.col("longest_run") >= leakage.MIN_WORDS
    return _leaks(spark, d).filter(exact).select("doc_id", "item_id").distinct()


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """For each item that leaked (up to one edited word a passage): documents, those word for word, most words seen."""
    exact = F.when(F.col("distance") == 0, 1).otherwise(0)
    per_doc = _leaks(spark, d).groupBy("item_id", "doc_id").agg(F.max(exact).alias("exact"), F.max("item_words").alias("words"))
    return per_doc.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("exact").alias("n_exact"), F.max("words").alias("most_words")
    )


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).report.filter("falls_short").select("source")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    report = _mix(spark, d).report
    return report.select("source", "target_share", "size", "available", "n_chosen", "tokens", F.round("actual_share", 6).alias("actual_share"), "falls_short")


def p8_records(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents with how often each is taken."""
    return _mix(spark, d).records.groupBy("source", F.col("doc").alias("doc_id")).agg(F.count(F.lit(1)).alias("repeats"), F.max("n_tokens").alias("n_tokens"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.stuffed_pages(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).filter("is_spam").select("doc_id").distinct()


def p9_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d)
    return pages.select("doc_id", "n_words", "spam_words", F.round("mean_pmi", 4).alias("mean_pmi"), "is_spam")


QUERIES = {
    "p4_found": p4_found,
    "p4_collapsed": p4_collapsed,
    "p7_found": p7_found,
    "p7_items": p7_items,
    "p8_found": p8_found,
    "p8_shares": p8_shares,
    "p8_records": p8_records,
    "p9_found": p9_found,
    "p9_pages": p9_pages,
}

_P4 = """WITH k AS (SELECT record_id,
    list_sort(list_distinct(list_filter(list_transform(coalesce(urls.url, []), lambda x: regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '', 'g')), lambda x: x <> '')))::VARCHAR AS u,
    list_sort(list_distinct(list_filter(list_transform(coalesce(namevariations.name, []), lambda x: regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '', 'g')), lambda x: x <> '')))::VARCHAR AS n FROM artist_xml),
  g AS (SELECT record_id, min(record_id) OVER (PARTITION BY u, n) AS first, count(*) OVER (PARTITION BY u, n) AS copies FROM k WHERE u <> '[]' OR n <> '[]')"""
_P7 = """WITH grams AS (
    SELECT doc_id, list_slice(w, i, i + 11) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i
      FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents) WHERE len(w) >= 12)),
  items AS (
    SELECT DISTINCT item_id, list_slice(w, i, i + 11) AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i
      FROM (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_item) WHERE len(w) >= 12))
  SELECT DISTINCT doc_id, item_id FROM grams JOIN items USING (g)"""

_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
# Sizes by words, numbers and signs instead of tokens: which sources fall short is the same by any common tokenizer.
_P8 = f"""WITH d AS (SELECT lower(trim(source, {_CHARS})) AS k, coalesce(len(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}]+|\\p{{N}}+|[^\\s\\p{{L}}\\p{{N}}]')), 0) AS n FROM documents),
  s AS (SELECT k, sum(n) AS n FROM d GROUP BY k), a AS (SELECT sum(n) AS n FROM d)
  SELECT t.source FROM mix_target t CROSS JOIN a LEFT JOIN s ON s.k = lower(trim(t.source, {_CHARS})) WHERE t.max_repeats * coalesce(s.n, 0) < t.target_share * a.n"""

ORACLE = {
    "p4_found": _P4 + " SELECT first AS first_record_id, record_id AS copy_record_id FROM g WHERE record_id > first",
    "p4_collapsed": _P4 + " SELECT DISTINCT first AS first_record, copies::BIGINT AS copies FROM g",
    "p7_found": _P7,
    "p8_found": _P8,
}
