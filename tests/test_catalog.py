import datetime as dt
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from cratework.sources import catalog
from cratework.sources.xml import read_listing

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_index_and_listing(spark):
    index = lines(spark, '<a href="?prefix=data/2008/">a</a> <a href="?prefix=data%2F2024%2F">b</a><a href="?prefix=data/2025/x">c</a>', None)
    assert rows(catalog.latest_year(index)) == [(2024,)]
    assert rows(catalog.latest_year(index.limit(0))) == [(None,)]
    page = lines(
        spark,
        '<a href="?download=data%2F2024%2Fdump_20240101_artists.xml.gz">x</a><a href="?a=1&amp;download=data/2024/dump_20240101_CHECKSUM.txt">y</a>'
        '<a href="?download=data/2024/dump_20241301_labels.xml.gz">z</a><a href="?download=data/2024/dump_20240201_Releases.xml.gz">w</a><a href="">e</a>',
    )
    assert rows(catalog.listing(page).select("dump_date", "kind")) == [(D(2024, 1, 1), "artists"), (D(2024, 2, 1), "releases")]


def test_checksums(spark):
    a, b = "A" * 64, "b" * 64
    df = spark.createDataFrame([(1, f"{a} *dump_20240101_artists.xml.gz"), (2, f"{b} *dump_20240101_artists.xml.gz"), (3, "junk"), (4, f"{b[:9]} *dump_20240101_labels.xml.gz")], "line_no int, value string")
    sums = catalog.checksum_map(df)
    assert rows(sums) == [(D(2024, 1, 1), "artists", b)]
    found = spark.createDataFrame([("u", D(2024, 1, 1), "artists"), ("v", D(2024, 1, 1), "labels")], "uri string, dump_date date, kind string")
    with pytest.raises(ValueError, match="v"):
        catalog.with_checksums(found, sums)
    kept = catalog.with_checksums(found, sums, check=False)
    stored = catalog.dump_rows(kept.withColumn("etag", F.lit('"q"')))
    assert rows(stored.select("entity_type", "etag", "checksum")) == sorted([("artist", "q", b), ("label", "q", None)], key=repr)
    assert catalog.store_dumps(stored.limit(0), stored.union(stored)).count() == 1


def test_selection(spark):
    df = spark.createDataFrame(
        [(1, "artist", D(2024, 1, 1), "a", 1), (2, "artist", D(2024, 2, 1), "b", 2), (3, "artist", D(2024, 2, 1), "c", 3), (4, "label", D(2023, 1, 1), "d", 4)],
        "id int, entity_type string, dump_date date, uri string, pos int",
    )
    assert [tuple(r) for r in catalog.refresh_candidates(df, ["label", "artist", "master"], "pos").select("entity_type", "uri").collect()] == [("label", "d"), ("artist", "b")]
    assert catalog.latest_dump(df, "artist").first()["id"] == 3
    assert catalog.latest_dump(df, "artist", F.lit(D(2024, 1, 1))).first()["id"] == 1
    assert catalog.latest_dump(df, "artist", F.lit(D(2023, 1, 1))).first() is None


def test_listing_xml(spark, tmp_path):
    p = tmp_path / "l.xml"
    p.write_text('<R><Contents><Key>data/dump_20240101_artists.xml.gz</Key><ETag>"e"</ETag><Size>5</Size></Contents></R>')
    assert rows(read_listing(spark, str(p))) == [("data/dump_20240101_artists.xml.gz", '"e"', 5)]
    p.write_text("<R><Contents><Key>data</Key><ETag>e</ETag")
    with pytest.raises(Exception):
        read_listing(spark, str(p)).collect()


def test_files(tmp_path):
    good = b"payload"
    checksum = hashlib.sha256(good).hexdigest()
    calls = []

    def fetch(uri):
        calls.append(uri)
        return io.BytesIO(good if uri == "ok" else b"broken")

    target = str(tmp_path / "d" / "x.gz")
    assert catalog.fetch_verified(fetch, "ok", target, checksum.upper()) == target
    catalog.fetch_verified(fetch, "ok", target, checksum)
    assert calls == ["ok"]
    with pytest.raises(ValueError):
        catalog.fetch_verified(fetch, "bad", str(tmp_path / "y"), checksum)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["d"]
    catalog.copy_new(target, str(tmp_path / "z"))
    with pytest.raises(FileExistsError):
        catalog.copy_new(target, str(tmp_path / "z"))
    catalog.delete_files([str(tmp_path / "z"), str(tmp_path / "z"), str(tmp_path / "none")])
    with pytest.raises(ExceptionGroup):
        catalog.delete_files([str(tmp_path / "d")])
