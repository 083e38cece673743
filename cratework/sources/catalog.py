"""Dump catalogues: HTML listings, checksum manifests, dump addresses, and what to fetch."""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework.functions.dates import in_month
from cratework.functions.text import entity_name, last_segment, let
from cratework.operators.converge import insert_or_ignore
from cratework.operators.dedupe import newest_per_group

# The dump kinds of a catalogue, as they appear in file names.
KINDS = ("artists", "labels", "masters", "releases")
_HREF = r'href\s*=\s*"([^"]*)"'
_FILE = r"_([0-9]{8})_([A-Za-z]+)\."
_MANIFEST = r"(?i)_([0-9]{8})_checksum\.txt$"
_CHECKSUM = r"^([0-9a-fA-F]{64})[\s*]+\S*?_([0-9]{8})_([A-Za-z]+)"


def hrefs(page: Column | str) -> Column:
    """The link targets of a page, in order, ``&amp;`` resolved; a null page has none."""
    found = F.regexp_extract_all(page, F.lit(_HREF), F.lit(1))
    return F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda h: F.regexp_replace(h, "&amp;", "&"))


def query_value(href: Column, name: str) -> Column:
    """A query parameter of a link, decoded; null if it has none or isn't decodable."""
    return F.try_url_decode(F.nullif(F.regexp_extract(href, rf"[?&]{name}=([^&#]*)", 1), F.lit("")))


def latest_year(pages: DataFrame, page: str = "value") -> DataFrame:
    """The newest year of the index links ``?prefix=data/YYYY/`` (null if there is none)."""
    links = pages.select(F.explode(hrefs(page)).alias("h"))
    year = F.regexp_extract(query_value(F.col("h"), "prefix"), r"^data/([0-9]{4})/\z", 1).try_cast("int")
    return links.agg(F.max(year).alias("year"))


def dump_address(uri: Column | str) -> Column:
    """Struct (dump_date, kind in lower case, known) of a dump's address by its file name."""
    found = F.split(F.regexp_extract(last_segment(uri), _FILE, 0), r"[_.]")

    def parts(p: Column) -> Column:
        date = F.try_to_date(F.get(p, F.lit(1)), "yyyyMMdd")
        kind = F.lower(F.get(p, F.lit(2)))
        return F.struct(date.alias("dump_date"), kind.alias("kind"), F.coalesce(date.isNotNull() & kind.isin(*KINDS), F.lit(False)).alias("known"))

    return let(found, parts)


def listing(pages: DataFrame, page: str = "value") -> DataFrame:
    """Uri, dump_date, kind of the download links; unknown kinds and invalid dates are dropped."""
    links = pages.select(F.explode(hrefs(page)).alias("h")).select(query_value(F.col("h"), "download").alias("uri"))
    found = links.filter(F.col("uri").isNotNull()).withColumn("a", dump_address("uri")).filter("a.known")
    return found.select("uri", F.col("a.dump_date").alias("dump_date"), F.col("a.kind").alias("kind"))


def checksum_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Checksum (lower case), dump_date, kind of manifest lines; lines of another form are dropped."""
    parts = F.split(F.regexp_replace(line, _CHECKSUM + ".*", "$1,$2,$3"), ",")
    fields = lambda p: F.struct(
        F.when(F.length(p[0]) == 64, F.lower(p[0])).alias("checksum"), F.try_to_date(F.get(p, F.lit(1)), "yyyyMMdd").alias("dump_date"), F.lower(F.get(p, F.lit(2))).alias("kind")
    )
    rows = lines.select(F.explode(F.filter(F.array(let(parts, fields)), _is_sum)).alias("__s"), *[c for c in lines.columns if c != line])
    return rows.select("__s.checksum", "__s.dump_date", "__s.kind", *[c for c in lines.columns if c != line])


def _is_sum(s: Column) -> Column:
    return s["checksum"].isNotNull() & s["dump_date"].isNotNull() & F.coalesce(s["kind"].isin(*KINDS), F.lit(False))


def checksum_map(lines: DataFrame, line: str = "value", position: str = "line_no") -> DataFrame:
    """One checksum a (dump_date, kind), that of the last line."""
    return newest_per_group(checksum_lines(lines, line), ["dump_date", "kind"], [F.col(position)], ["checksum"])


def with_checksums(found: DataFrame, checksums: DataFrame, check: bool = True) -> DataFrame:
    """The listing with its checksums; a dump without one is an error (``check``) or has a null."""
    joined = found.join(checksums, ["dump_date", "kind"], "left")
    if check:
        missing = joined.filter(F.col("checksum").isNull()).select("uri").limit(5).collect()
        if missing:
            raise ValueError(f"no checksum for {[r[0] for r in missing]}")
    return joined


def dump_rows(found: DataFrame) -> DataFrame:
    """catalogue rows as stored: etag without quotes, singular kind, checksum in lower case."""
    etag = F.btrim(F.col("etag"), F.lit('"')) if "etag" in found.columns else F.lit(None).cast("string")
    return found.select(
        entity_name("kind").alias("entity_type"), "dump_date", F.lower("checksum").alias("checksum"), etag.alias("etag"),
        (F.col("size_bytes") if "size_bytes" in found.columns else F.lit(None)).cast("long").alias("size_bytes"), "uri",
    )


def store_dumps(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """K4/K5: insert if (dump_date, entity_type, checksum) isn't stored; rows without a checksum are skipped."""
    rows = incoming.filter(F.col("checksum").isNotNull()).dropDuplicates(["dump_date", "entity_type", "checksum"])
    return insert_or_ignore(stored, rows, ["dump_date", "entity_type", "checksum"])


def refresh_candidates(found: DataFrame, wanted: list[str], position: str) -> DataFrame:
    """The latest dump of each wanted entity, in the order wanted (first of equal dates)."""
    rows = found.filter(F.col("entity_type").isin(wanted))
    best = newest_per_group(rows, ["entity_type"], [F.col("dump_date"), -F.col(position)], ["dump_date", "uri"])
    return best.orderBy(F.array_position(F.array(*[F.lit(w) for w in wanted]), F.col("entity_type")))


def latest_dump(dumps: DataFrame, entity: str, month: Column | None = None) -> DataFrame:
    """The newest dump of an entity, of all or of one month (first day given); ties by id."""
    rows = dumps.filter(F.col("entity_type") == entity)
    if month is not None:
        rows = rows.filter(in_month("dump_date", month))
    return rows.orderBy(F.desc("dump_date"), F.desc("id")).limit(1)


# Fetching a catalogue: the driver reads pages, the plans above take them apart.


def opener(base: str) -> Callable[[str, str], object]:
    """``fetch(kind, name)`` for a catalogue: kind ``prefix`` opens a listing page, ``download`` a file.

    An address is asked by query parameter. A local copy is a folder: ``<prefix>index.html`` and the files by their paths.
    """
    from urllib.parse import quote

    if base.startswith(("http://", "https://")):
        return lambda kind, name: open_url(f"{base}?{kind}={quote(name, safe='')}")
    return lambda kind, name: open(os.path.join(base, name, "index.html") if kind == "prefix" else os.path.join(base, name), "rb")


def _page(spark: SparkSession, fetch: Callable[[str, str], object], prefix: str) -> DataFrame:
    with fetch("prefix", prefix) as f:
        return spark.createDataFrame([(f.read().decode("utf-8", "replace"),)], "value string")


def manifests(pages: DataFrame, page: str = "value") -> DataFrame:
    """uri and dump_date of the checksum manifests among the download links."""
    uris = pages.select(F.explode(hrefs(page)).alias("h")).select(query_value(F.col("h"), "download").alias("uri"))
    date = F.try_to_date(F.regexp_extract("uri", _MANIFEST, 1), "yyyyMMdd")
    return uris.select("uri", date.alias("dump_date")).filter(F.col("dump_date").isNotNull())


def fetch_catalogue(spark: SparkSession, fetch: Callable[[str, str], object], entities: Sequence[str], month: str | None = None, whole: bool = False) -> DataFrame:
    """C14: the dumps of the wanted entities (of the month yyyy-mm, else the latest of each) with their checksums.

    One listing page and one manifest a dump date are fetched: of the month's year, else of the newest year. With
    ``whole`` (C16), all dumps of the year are taken, those without a checksum left out. Dumps that aren't listed and
    checksums that are missing raise ValueError.
    """
    year = int(month[:4]) if month else latest_year(_page(spark, fetch, "data/")).first()["year"]
    if year is None:
        raise ValueError("the catalogue lists no year")
    page = _page(spark, fetch, f"data/{year}/")
    found = listing(page).select("uri", "dump_date", "kind", entity_name("kind").alias("entity_type"))
    if month:
        found = found.filter(in_month("dump_date", F.to_date(F.lit(f"{month}-01"))))
    if not whole:
        numbered = found.withColumn("position", F.monotonically_increasing_id())
        best = refresh_candidates(numbered, list(entities), "position")
        found = found.join(best.select("entity_type", "dump_date", "uri"), ["entity_type", "dump_date", "uri"], "left_semi")
        if missing := sorted(set(entities) - {r["entity_type"] for r in found.select("entity_type").collect()}):
            raise ValueError(f"the catalogue lists no dump of {', '.join(missing)} for {month or year}")
    lines = []
    wanted = manifests(page).join(found.select("dump_date").distinct(), "dump_date", "left_semi").orderBy("uri")
    for r in wanted.collect():  # a row a dump date of one year
        with fetch("download", r["uri"]) as f:
            lines += enumerate(f.read().decode("utf-8", "replace").splitlines())
    sums = checksum_map(spark.createDataFrame(lines or [(0, "")], "line_no long, value string"))
    return dump_rows(with_checksums(found, sums, check=not whole)).filter(F.col("checksum").isNotNull())


# Files: on the driver, not part of a plan.


def sha256_of(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def fetch_verified(fetch: Callable[[str], object], uri: str, path: str, checksum: str) -> str:
    """The local file of a dump: a valid one is reused, an invalid one deleted and fetched again.

    ``fetch`` opens the address for reading. What arrives is checked before it gets its name.
    """
    if os.path.exists(path):
        if sha256_of(path) == checksum.lower():
            return path
        os.unlink(path)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    fd, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    try:
        with os.fdopen(fd, "wb") as out, fetch(uri) as source:
            shutil.copyfileobj(source, out, 1 << 20)
        if sha256_of(temporary) != checksum.lower():
            raise ValueError(f"checksum mismatch for {uri}")
        os.replace(temporary, path)
    finally:
        if os.path.exists(temporary):
            os.unlink(temporary)
    return path


def open_url(uri: str, timeout: float = 60.0):
    """HTTP GET; any status but 2xx raises, nothing is tried again."""
    from urllib.request import urlopen

    response = urlopen(uri, timeout=timeout)  # noqa: S310
    if not 200 <= response.status < 300:
        raise OSError(f"{uri}: status {response.status}")
    return response


def copy_new(source: str, target: str) -> None:
    """Copy to a file that must not exist yet."""
    with open(source, "rb") as a, open(target, "xb") as b:
        shutil.copyfileobj(a, b, 1 << 20)


def delete_files(paths: list[str]) -> None:
    """Delete each file once, in order; missing ones are fine, other errors are raised together at the end."""
    errors = []
    for p in sorted(set(paths)):
        try:
            os.unlink(p)
        except FileNotFoundError:
            pass
        except OSError as x:
            errors.append(x)
    if errors:
        raise ExceptionGroup("files not deleted", errors)
