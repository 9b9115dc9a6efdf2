"""Readers of names, listings and small documents: archives, reports, bulletins, shapes, settings."""

from __future__ import annotations

import contextlib
import os
import re
import time
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

#: Month codes in archive names, report kinds that count, and the layout of a report file.
MONTHS = {"ja": 1, "fe": 2, "mr": 3, "ap": 4, "my": 5, "jn": 6, "jl": 7, "au": 8, "se": 9, "oc": 10, "no": 11, "de": 12}
SEVERE = ("T", "H", "G", "D")
REPORTS = "features array<struct<geometry:struct<coordinates:array<double>>,properties:struct<type:string,valid:string>>>"
SHAPE = "struct<type:string,coordinates:string>"
MIN_AGE_S = 20
#: How long the names of files that are gone are known.
KEEP_S = 7 * 86400


def archive_listing(names: DataFrame, since: str, until: str) -> DataFrame:
    """Volume files (key) by the time in their name, within closed bounds; side files and unreadable names go."""
    name = F.element_at(F.split("key", "/"), -1)
    at = F.try_to_timestamp(F.substring(name, 5, 15), F.lit("yyyyMMdd_HHmmss"))
    rows = names.filter(~F.col("key").endswith("_MDM")).withColumn("ts", at)
    return rows.filter(F.col("ts").between(F.lit(since).cast("timestamp"), F.lit(until).cast("timestamp")))


def storm_reports(documents: DataFrame, text: str = "text") -> DataFrame:
    """t, lat, lon and kind of the severe reports in GeoJSON documents; those without a readable time go."""
    f = documents.select(F.explode(F.from_json(text, REPORTS)["features"]).alias("f"))
    rows = f.select(F.try_to_timestamp("f.properties.valid").alias("t"), F.try_element_at("f.geometry.coordinates", F.lit(2)).alias("lat"), F.try_element_at("f.geometry.coordinates", F.lit(1)).alias("lon"), F.col("f.properties.type").alias("kind"))
    return rows.filter(F.col("kind").isin(*SEVERE) & F.col("t").isNotNull())


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if re.match(r"\w+:", folder) else (fs.LocalFileSystem(), os.path.abspath(folder))


class BulletinFiles(DataSource):
    """A streaming source of the bulletin files (path, modified in seconds) below a folder, once they are MIN_AGE_S old.

    The offset holds the names taken so far, so a younger file is left for a later batch. Names stay for KEEP_S after
    their file is gone.
    """

    @classmethod
    def name(cls) -> str:
        return "galeframe_bulletins"

    def schema(self) -> str:
        return "path string, modified double"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:  # noqa: N802
        return BulletinReader(self.options["path"], self.options["delete"] == "true")


class BulletinReader(SimpleDataSourceStreamReader):
    def __init__(self, folder: str, delete: bool) -> None:
        self.folder, self.delete = folder, delete

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        now = time.time()
        system, root = _system(self.folder)
        infos = system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        files = {f.base_name: [f.path, f.mtime.timestamp()] for f in infos if f.is_file and f.extension in ("TXT", "txt")}
        end = {n: f for n, f in start.items() if n in files or now - f[1] < KEEP_S}
        end |= {n: f for n, f in sorted(files.items()) if n not in end and now - f[1] >= MIN_AGE_S}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter([tuple(f) for n, f in end.items() if n not in start])

    def commit(self, end: dict) -> None:
        system, _ = _system(self.folder)
        for path, _ in end.values() if self.delete else ():
            with contextlib.suppress(FileNotFoundError):
                system.delete_file(path)


def bulletin_stream(spark: SparkSession, folder: str, delete: bool = False) -> DataFrame:
    """Whole bulletins (path, modified, text) as their files come of age below a folder; a name taken once isn't read again.

    A file that can't be read any more has an empty text. With `delete`, files go once the batch that took them is done.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _system(folder)
        for batch in batches:
            for path, modified in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    with system.open_input_file(path) as f:
                        text = f.read().decode(errors="ignore")
                except OSError:
                    text = ""
                yield pa.RecordBatch.from_pylist([{"path": path, "modified": modified, "text": text}])

    spark.dataSource.register(BulletinFiles)
    files = spark.readStream.format(BulletinFiles.name()).option("path", folder).option("delete", str(delete).lower()).load()
    return files.repartition("path").mapInArrow(texts, "path string, modified double, text string").withColumn("modified", F.timestamp_seconds("modified"))


def latest_graphics(files: DataFrame) -> DataFrame:
    """The newest file (path, modified) and the number of files of each product, named before the ending."""
    product = F.regexp_extract("path", r"(?i)-([A-Z0-9]+)\.(?:GIF|JPG|PNG)$", 1)
    rows = files.withColumn("product", product).filter("product <> ''")
    return rows.groupBy("product").agg(F.max_by("path", F.struct("modified", "path")).alias("path"), F.max("modified").alias("modified"), F.count("*").alias("n"))


def selected(latest: DataFrame, slugs: dict[str, str]) -> DataFrame:
    """Those products that a selection names, with their slugs."""
    names = F.create_map(*(F.lit(x) for kv in slugs.items() for x in kv))
    return latest.withColumn("slug", F.try_element_at(names, F.col("product"))).filter("slug IS NOT NULL")


def current_link(html: Column) -> Column:
    """HHMM of the product page's current issue: that of its Valid stamp if linked, else the last link's."""
    times = F.regexp_extract_all(html, F.lit(r"outlk_(\d{4})_prt\.html"), F.lit(1))
    valid = F.nullif(F.regexp_extract(html, r"Valid\s+\d{2}(\d{4})Z", 1), F.lit(""))
    return F.when(F.array_contains(times, valid), valid).otherwise(F.try_element_at(times, F.lit(-1)))


def archive_date(url: Column) -> Column:
    """struct(y, m, d) of a name dated ddMMyy with letters for the month; zeros if it isn't."""
    part = lambda g: F.regexp_extract(url, r"[cz]_(\d{2})([a-z]{2})(\d{2})\.zip$", g)
    months = F.create_map(*(F.lit(x) for kv in MONTHS.items() for x in kv))
    day = F.try_to_number(part(1), F.lit("99")).cast("int")
    return F.struct(*(F.coalesce(c, F.lit(0)).alias(n) for c, n in ((F.try_to_number(part(3), F.lit("99")).cast("int") + 2000, "y"), (F.try_element_at(months, part(2)), "m"), (day, "d"))))


def zone_code(state: Column, fips: Column, zone: Column) -> Column:
    """State and C with the last three signs of the county's number, else Z with the padded zone; null without either."""
    s, f, z = (F.trim(F.coalesce(c, F.lit(""))) for c in (state, fips, zone))
    county = F.when(F.length(f) >= 3, F.concat(s, F.lit("C"), F.right(f, F.lit(3))))
    forecast = F.when(z != "", F.concat(s, F.lit("Z"), F.when(F.length(z) < 3, F.lpad(z, 3, "0")).otherwise(z)))
    return F.when(s != "", F.coalesce(county, forecast))


def rings(shapes: DataFrame, geometry: str = "geometry") -> DataFrame:
    """ring_id and ring (points lon, lat) of each Polygon or MultiPolygon in GeoJSON text."""
    kind = F.get_json_object(geometry, "$.type")
    one = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<double>>>")
    many = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<array<double>>>>")
    found = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", F.flatten(many))
    keep = [c for c in shapes.columns if c != geometry]
    points = F.transform("r", lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat")))
    return shapes.select(*keep, F.posexplode(found).alias("ring_id", "r")).select(*keep, "ring_id", points.alias("ring"))


def meets_box(ring: Column, west: float, south: float, east: float, north: float, margin: float = 1.5) -> Column:
    """Whether a ring's bounds meet a box with a margin."""
    of = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    lo, la = (of(F.array_min, c) for c in ("lon", "lat"))
    hi, ha = (of(F.array_max, c) for c in ("lon", "lat"))
    return (hi >= west - margin) & (lo <= east + margin) & (ha >= south - margin) & (la <= north + margin)


def settings(lines: DataFrame, line: str = "value") -> DataFrame:
    """key and value of KEY=VALUE lines; the value is all behind the first sign, comments and other lines go."""
    at = F.locate("=", F.col(line))
    rows = lines.filter((at > 1) & ~F.ltrim(F.col(line)).startswith("#"))
    return rows.select(F.trim(F.substring(F.col(line), F.lit(1), at - 1)).alias("key"), F.trim(F.substring(F.col(line), at + 1, F.length(line))).alias("value"))


def expired(files: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Files (modified) older than some minutes."""
    return files.filter(F.unix_timestamp(now) - F.unix_timestamp("modified") > minutes * 60)


def of_age(files: DataFrame, now: Column, seconds: int = 45) -> DataFrame:
    """Files (modified) that nobody writes any more: at least some seconds old, and so ready to be copied."""
    return files.filter(F.unix_micros(now) - F.unix_micros(F.col("modified").cast("timestamp")) >= seconds * 1_000_000)


SIDECAR = "struct<ImageDataFunction:struct<Table:array<double>>>"


def sidecar_tables(files: DataFrame, body: str = "value") -> DataFrame:
    """path and kelvin_table of calibration sidecars (path, JSON text); nonsense, or a text without a table, has a null one."""
    return files.select("path", F.from_json(body, SIDECAR)["ImageDataFunction"]["Table"].alias("kelvin_table"))


def link_parts(url: Column) -> tuple[Column, Column, Column]:
    """How many parts a link has after the first, its host, and its last part."""
    parts = F.split(url, "/")
    return (F.size(parts) - 1).cast("bigint"), F.regexp_extract(url, r"^([a-z]+)://([^/?#]+)", 2), F.element_at(parts, -1)


def case_list(spark: SparkSession, path: str) -> DataFrame:
    """Cases (site, start, end, and a note) from JSON files that hold a list of objects; those without site or times go."""
    rows = spark.read.schema("site string, start string, end string, note string").option("multiLine", True).json(path)
    times = {c: F.try_to_timestamp(c) for c in ("start", "end")}
    return rows.withColumns(times).filter("site IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL")
