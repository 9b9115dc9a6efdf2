"""Zone shapes from zipped shapefiles: each file is one row, its records come out as rings with their zone codes."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: The number that the format gives to polygons.
POLYGON = 5
RINGS = "ugc string, ring_id int, ring array<struct<lon:double,lat:double>>"


def polygons(data: bytes) -> Iterator[list[np.ndarray]]:
    """The rings (lon, lat) of each record; other kinds of shapes have none."""
    at = 100
    while at + 12 <= len(data):
        size = 2 * int.from_bytes(data[at + 4 : at + 8], "big")
        body = data[at + 8 : at + 8 + size]
        if int.from_bytes(body[:4], "little") == POLYGON:
            parts, points = np.frombuffer(body, "<i4", 2, 36)
            starts = [*np.frombuffer(body, "<i4", parts, 44).tolist(), int(points)]
            xy = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
            yield [xy[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        else:
            yield []
        at += 8 + size


def records(data: bytes) -> Iterator[dict[str, str]]:
    """The fields of each record of the table beside the shapes, by lower-case name."""
    count, head, width = (int.from_bytes(data[a:b], "little") for a, b in ((4, 8), (8, 10), (10, 12)))
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("latin-1").lower(), data[at + 16]))
        at += 32
    for k in range(count):
        row, place = data[head + k * width : head + (k + 1) * width], 1
        out = {}
        for name, size in fields:
            out[name] = row[place : place + size].decode("latin-1").strip()
            place += size
        yield out


def zone(record: dict[str, str]) -> str | None:
    state, fips, number = (record.get(k, "") for k in ("state", "fips", "zone"))
    if not state:
        return None
    if len(fips) >= 3:
        return f"{state}C{fips[-3:]}"
    return f"{state}Z{number.zfill(3)}" if number else None


def shape_records(content: bytes) -> list[tuple[str, list[np.ndarray]]]:
    """Zone code and rings of each record of a zipped shapefile; records without a code are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = {n.lower()[-4:]: n for n in z.namelist()}
        if missing := {".shp", ".dbf"} - names.keys():
            raise ValueError(f"no {', '.join(sorted(missing))} in the archive")
        fields = list(records(z.read(names[".dbf"])))
        pairs = zip(polygons(z.read(names[".shp"])), fields, strict=False)
        return [(code, shape) for shape, record in pairs if (code := zone(record))]


#: What a file that isn't a whole zipped shapefile can raise.
BROKEN = (ValueError, IndexError, KeyError, zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, TypeError)


def zone_shapes(files: DataFrame, box: tuple[float, float, float, float] | None = None, margin: float = 1.5) -> DataFrame:
    """ugc, ring_id and ring of the zipped shapefiles in `files` (content), those that meet a box (w, s, e, n) if given.

    A file that can't be read, or a null one, has no rings (see `broken_shapes`)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for content in pdf["content"]:
                rows = []
                try:
                    found = shape_records(content)
                except BROKEN:
                    found = []
                for code, shape in found:
                    for i, ring in enumerate(shape):
                        lo, hi = ring.min(axis=0), ring.max(axis=0)
                        if box is None or (hi[0] >= box[0] - margin and lo[0] <= box[2] + margin and hi[1] >= box[1] - margin and lo[1] <= box[3] + margin):
                            rows.append((code, i, [{"lon": float(a), "lat": float(b)} for a, b in ring]))
                yield pd.DataFrame(rows, columns=["ugc", "ring_id", "ring"])

    return files.select("content").mapInPandas(run, RINGS)


def broken_shapes(files: DataFrame) -> DataFrame:
    """path and error of each of `files` (path, content) that can't be read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            bad = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    shape_records(content)
                except BROKEN as error:
                    bad.append((path, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(bad, columns=["path", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, error string")
