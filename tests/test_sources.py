import io
import json
import math
import os
import struct
import time
import zipfile
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from galeframe.operators.overlap import Cell, OverlapTracker
from galeframe.plans.extras import family_sweep
from galeframe.sources import files as S

SF = "/root/testdata/sf0.001"


def disc(cy, cx, radius):
    n = int(radius)
    return frozenset((cy + y, cx + x) for y in range(-n, n + 1) for x in range(-n, n + 1) if math.hypot(y, x) < radius)


def test_lifecycle_by_overlap():
    t, seen = OverlapTracker(), []
    for k in range(9):
        x = 80 + 3 * k
        parts = [(100, 14, 600.0)] if k < 3 else [(92, 10, 320.0), (110, 10, 300.0)] if k < 6 else [(100, 15, 700.0)]
        cells = [Cell(i, x * 1000.0, y * 1000.0, area, disc(y, x, radius)) for i, (y, radius, area) in enumerate(parts)]
        seen.append(t.update(300.0 * k, cells))
    assert {tr.lineage_id for s in seen for _, tr in s} == {1}
    kinds = [e[1] for e in t.events]
    assert kinds.count("birth") == 1 and kinds.count("split") == 1 and kinds.count("merge") == 1 and "death" not in kinds
    assert seen[8][0][1].t - seen[8][0][1].born == 2400 and len({tr.track_id for s in seen for _, tr in s}) == 2
    for k in range(3):
        t.update(3000.0 + 300 * k, [])
    assert [e[1] for e in t.events][-1] == "death" and not t.active


def test_fast_jumps_are_other_storms():
    t = OverlapTracker()
    t.update(0.0, [Cell(1, 0.0, 0.0, 9.0, disc(0, 0, 9))])
    assert t.update(300.0, [Cell(1, 20_000.0, 0.0, 9.0, disc(0, 0, 9))])[0][1].track_id == 2


def test_reports(spark):
    f = lambda kind, at: {"geometry": {"coordinates": [-87.0, 30.5]}, "properties": {"type": kind, "valid": at}}
    doc = json.dumps({"features": [f("T", "2024-01-01T00:00:00Z"), f("X", "2024-01-01T00:00:00Z"), f("H", "soon"), f("D", "2024-01-02T00:00:00Z")]})
    got = S.storm_reports(spark.createDataFrame([(doc,), (None,), ("{",)], "text string")).collect()
    assert [(r.kind, r.lat, r.lon) for r in got] == [("T", 30.5, -87.0), ("D", 30.5, -87.0)]


def test_rings_and_boxes(spark):
    square = [[0, 0], [0, 1], [1, 1], [0, 0]]
    rows = [(1, json.dumps({"type": "Polygon", "coordinates": [square]})), (2, json.dumps({"type": "MultiPolygon", "coordinates": [[square], [[[9, 9], [9, 8], [8, 8]]]]})), (3, json.dumps({"type": "Point", "coordinates": [1, 2]})), (4, None)]
    got = S.rings(spark.createDataFrame(rows, "id int, geometry string"))
    assert [(r.id, r.ring_id, len(r.ring)) for r in got.orderBy("id", "ring_id").collect()] == [(1, 0, 4), (2, 0, 4), (2, 1, 3)]
    assert got.filter(S.meets_box(F.col("ring"), 2.0, 0.0, 3.0, 1.0)).count() == 2


def test_links_settings_and_selection(spark):
    pages = {"outlk_0100_prt.html outlk_1300_prt.html Valid 011300Z": "1300", "outlk_0100_prt.html outlk_1300_prt.html Valid 012000Z": "1300", "outlk_1300_prt.html outlk_0100_prt.html": "0100", "nothing": None}
    df = spark.createDataFrame([(k,) for k in pages], "h string")
    assert {r.h: r.x for r in df.select("h", S.current_link(F.col("h")).alias("x")).collect()} == pages
    lines = spark.createDataFrame([("A=b=c",), ("# D=e",), ("nothing",), (" F = g ",), ("=h",), (None,)], "value string")
    assert {r.key: r.value for r in S.settings(lines).collect()} == {"A": "b=c", "F": "g"}
    latest = spark.createDataFrame([("RADNAT", "p"), ("X", "q")], "product string, path string")
    assert [r.slug for r in S.selected(latest, {"RADNAT": "radar"}).collect()] == ["radar"]


def test_bulletins_arrive_as_a_stream(spark, tmp_path):
    os.makedirs(tmp_path / "in/a")
    for name in ("a/ONE.TXT", "two.txt", "three.dat"):
        path = tmp_path / "in" / name
        path.write_text(f"text of {name}\nline 2")
        os.utime(path, (time.time() - 100, time.time() - 100))
    q = S.bulletin_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("bulletins_seen").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.text for r in spark.table("bulletins_seen").collect()) == ["text of a/ONE.TXT\nline 2", "text of two.txt\nline 2"]


@pytest.mark.parametrize("delete", [False, True])
def test_a_fresh_bulletin_comes_in_a_later_batch(spark, tmp_path, delete):
    (tmp_path / "in").mkdir()
    old, fresh = tmp_path / "in/OLD.TXT", tmp_path / "in/FRESH.TXT"
    old.write_text("old")
    fresh.write_text("half")
    os.utime(old, (time.time() - 100, time.time() - 100))

    def texts():
        q = S.bulletin_stream(spark, str(tmp_path / "in"), delete).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert texts() == ["old"]
    fresh.write_text("whole")
    assert texts() == ["old"]
    os.utime(fresh, (time.time() - 100, time.time() - 100))
    assert texts() == ["old", "whole"]
    assert texts() == ["old", "whole"] and old.exists() != delete


def test_wider_families_are_fewer(spark):
    n = [r.per_volume for r in family_sweep(spark, SF).orderBy("km").collect()]
    assert n == sorted(n, reverse=True)


def shapefile(rows):
    shp, dbf = b"\0" * 100, b""
    for k, (rings, state, fips, zone) in enumerate(rows):
        points = [p for r in rings for p in r]
        starts, n = [], 0
        for r in rings:
            starts.append(n)
            n += len(r)
        body = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), n) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        shp += struct.pack(">2i", k + 1, len(body) // 2) + body
        dbf += b" " + f"{state:<2}{fips:<5}{zone:<3}".encode()
    field = lambda name, size: name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([size]) + b"\0" * 15
    head = b"".join([field("STATE", 2), field("FIPS", 5), field("ZONE", 3)]) + b"\r"
    table = struct.pack("<4BI2H20x", 3, 0, 0, 0, len(rows), 32 + len(head), 11) + head + dbf
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.shp", shp)
        z.writestr("a.dbf", table)
    return out.getvalue()


def test_zone_shapes(spark):
    square = [(-87.0, 30.0), (-87.0, 31.0), (-86.0, 31.0), (-87.0, 30.0)]
    far = [(10.0, 50.0), (10.0, 51.0), (11.0, 51.0), (10.0, 50.0)]
    data = shapefile([([square, far], "FL", "12033", ""), ([far], "AL", "", "7"), ([square], "", "1", "2")])
    df = spark.createDataFrame([("a.zip", bytearray(data))], "path string, content binary")
    from galeframe.sources.shapes import zone_shapes

    got = zone_shapes(df).collect()
    assert [(r.ugc, r.ring_id, len(r.ring)) for r in got] == [("FLC033", 0, 4), ("FLC033", 1, 4), ("ALZ007", 0, 4)] and got[0].ring[1].lat == 31.0
    assert [(r.ugc, r.ring_id) for r in zone_shapes(df, (-88, 29, -85, 32)).collect()] == [("FLC033", 0)]


@dataclass(frozen=True)
class Settings:
    on: bool = False
    n: int = 3
    x: float = 1.5
    s: str = "a"


def test_settings_are_typed():
    from galeframe.sources.settings import from_environment

    assert from_environment(Settings(), "gf", {"GF_ON": "Yes", "GF_N": "7", "GF_X": "2", "OTHER": "1"}) == Settings(True, 7, 2.0, "a")


def test_documents(spark):
    from galeframe.operators import alerts, raster, tracks

    rows = [("b", "B", "e", "0002", ["FLZ001"], None), ("a", "A", "e", "0001", [], ([(-87.0, 30.0)],))]
    df = spark.createDataFrame(rows, "key string, name string, ends string, etn string, ugc array<string>, poly struct<ring:array<struct<lon:double,lat:double>>>")
    body = json.loads(alerts.document(df).first().body)
    assert body["count"] == 2 and [a["key"] for a in body["alerts"]] == ["a", "b"] and body["alerts"][0]["poly"] and body["alerts"][1]["ugc"] == ["FLZ001"]
    frames = spark.createDataFrame([("2024-01-02 00:30:00",), ("2024-01-02 00:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp").alias("frame_time"))
    assert json.loads(raster.manifest(frames, (1.0, 2.0, 3.0, 4.0)).first().body)["frames"] == ["20240102T000000Z.png", "20240102T003000Z.png"]
    lines = [r.line for r in tracks.as_text(spark.createDataFrame([(1.234, float("nan"), None)], "a double, b double, c double")).collect()]
    assert [x.split() for x in lines] == [["a", "1.23"], ["b", "n/a"], ["c", "n/a"]]
    x, y = raster.plate_pixel(F.lit(-80.0), F.lit(30.0), -90.0, 20.0, -70.0, 40.0, 200, 100)
    assert tuple(spark.range(1).select(x, y).first()) == (100.0, 50.0)
