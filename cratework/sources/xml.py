"""Dump readers: one explicit schema an entity, nothing inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_REF = "struct<name:array<struct<_VALUE:string,_id:int>>>"

SCHEMAS = {
    "artist": "id int, name string, realname string, profile string, data_quality string, urls struct<url:array<string>>, "
    f"namevariations struct<name:array<string>>, aliases {_REF}, groups {_REF}, members {_REF}",
    "label": "id int, name string, contactinfo string, profile string, data_quality string, urls struct<url:array<string>>, "
    "sublabels struct<label:array<struct<_VALUE:string,_id:int>>>",
    "master": "_id int, main_release int, title string, data_quality string, year smallint, styles struct<style:array<string>>, "
    "genres struct<genre:array<string>>, artists struct<artist:array<struct<id:int>>>, "
    "videos struct<video:array<struct<_src:string,title:string,description:string>>>",
    "release": "_id int, _status string, title string, country string, data_quality string, released string, notes string, "
    "master_id struct<_VALUE:int,_is_main_release:boolean>, artists struct<artist:array<struct<id:int>>>, "
    "labels struct<label:array<struct<_id:int,_catno:string>>>, extraartists struct<artist:array<struct<id:int,role:string>>>, "
    "formats struct<format:array<struct<_name:string,_qty:string,_text:string,descriptions:struct<description:array<string>>>>>, "
    "genres struct<genre:array<string>>, styles struct<style:array<string>>, "
    "tracklist struct<track:array<struct<position:string,title:string,duration:string>>>, "
    "identifiers struct<identifier:array<struct<_type:string,_description:string,_value:string>>>, "
    "videos struct<video:array<struct<_src:string,title:string,description:string>>>, "
    "companies struct<company:array<struct<id:int,entity_type_name:string>>>",
}
LISTING_SCHEMA = "Key string, ETag string, Size bigint"


def read_records(spark: SparkSession, path: str, row_tag: str, schema: str, partitions: int | None = None) -> DataFrame:
    """The elements with local name ``row_tag`` as rows; gzip is undone by the file name.

    Malformed or truncated input fails the job rather than losing records. A gzip file is one split: ``partitions``
    spreads its records right after the scan, before anything is exploded. A missing path raises on reading.
    """
    reader = spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST").option("ignoreSurroundingSpaces", "false").option("ignoreNamespace", "true")
    df = reader.schema(schema).load(path)
    return df.repartition(partitions) if partitions else df


def read_entity(spark: SparkSession, path: str, entity: str, partitions: int | None = None) -> DataFrame:
    """The records of one of the four dump kinds."""
    return read_records(spark, path, entity, SCHEMAS[entity], partitions)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """The older XML listing of dump files: Key, ETag, Size."""
    return read_records(spark, path, "Contents", LISTING_SCHEMA)
