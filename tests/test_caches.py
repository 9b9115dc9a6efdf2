"""Cached grids, chunked volumes, files of age, sidecars and public cells."""

import json
import os
import time
from datetime import UTC, datetime

import numpy as np
from pyspark.sql import functions as F

from galeframe.sources import cache, chunks
from galeframe.sources import files as S
from galeframe.sources.shared import new_folder, put_batch


def test_a_second_run_reads_no_gate(spark):
    root = new_folder(spark, "grids")
    gates = spark.createDataFrame([("a", v, float(v)) for v in (1, 1, 2, 3)] + [(None, 1, 1.0)], "site string, vol long, dbz double")
    wanted = lambda *v: spark.createDataFrame([("a", x) for x in v], "site string, vol long")
    make = lambda g: g.groupBy("site", "vol").agg(F.max("dbz").alias("top"))
    unreadable = gates.withColumn("dbz", F.raise_error(F.lit("a gate was read")).cast("double"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(cache.cached(gates, wanted(1, 2, 2, 9), root, {"h": 1}, make)) == [("a", 1, 1.0), ("a", 2, 2.0)]
    assert rows(cache.cached(unreadable, wanted(1, 2, 9), root, {"h": 1}, make)) == [("a", 1, 1.0), ("a", 2, 2.0)]
    assert rows(cache.cached(gates, wanted(2, 3), root, {"h": 1}, make)) == [("a", 2, 2.0), ("a", 3, 3.0)]
    more = lambda g: g.groupBy("site", "vol").agg((F.max("dbz") * 2).alias("top"))
    assert rows(cache.cached(gates, wanted(3), root, {"h": 2}, more)) == [("a", 3, 6.0)]
    assert len(cache.pruned(gates, root, {"h": 2})) == 1 and cache.pruned(gates, root, {"h": 2}) == []
    assert rows(cache.cached(unreadable, wanted(3), root, {"h": 2}, more)) == [("a", 3, 6.0)]
    assert rows(cache.cached(gates, wanted(), new_folder(spark, "grids"), {}, make)) == []


def test_newest_counters_of_a_circle():
    assert chunks.newest([5]) == [5] and chunks.newest([]) == []
    assert chunks.newest([4, 5, 6, 7], 3) == [5, 6, 7]
    assert chunks.newest([1, 2, 997, 998, 999], 3) == [999, 1, 2]
    assert chunks.newest([1, 500, 998, 999], 2) == [999, 1] or chunks.newest([1, 500, 998, 999], 2) == [1, 500]


def put_chunk(folder, site, counter, began, number, kind, at, size=3):
    name = datetime.fromtimestamp(began, UTC).strftime("%Y%m%d-%H%M%S")
    os.makedirs(f"{folder}/{site}/{counter}", exist_ok=True)
    path = f"{folder}/{site}/{counter}/{name}-{number:03d}-{kind}"
    with open(path, "wb") as f:
        f.write(b"x" * size)
    os.utime(path, (at, at))


def test_volumes_come_once_when_their_last_chunk_does(spark, tmp_path):
    from galeframe.plans.streams import finished

    root, where, now = str(tmp_path), new_folder(spark, "volumes"), int(time.time()) - 600
    for i, (counter, began) in enumerate(((998, now - 1500), (999, now - 1000), (1, now - 500))):  # the counter begins anew
        for n, kind in enumerate("SIE", 1):
            put_chunk(root, "KMOB", counter, began, n, kind, began + 100 + n + i)
    put_chunk(root, "KMOB", 2, now - 60, 1, "S", now)  # not complete yet
    put_chunk(root, "KEVX", 7, now - 5000, 1, "E", now)  # too old
    put_chunk(root, "KEVX", 8, now - 300, 1, "E", now)
    (tmp_path / "KEVX" / "8" / "readme").write_text("x")
    stream = chunks.complete_volume_stream(spark, "file://" + root, ["KMOB", "KEVX", "KNONE"])
    seen = lambda: sorted((r.site, r.volume_epoch, r.source_prefix, r.chunk_count, r.bytes) for r in spark.read.parquet(where).drop("batch").collect())
    finished(stream, put_batch(where), "append", where)
    first = [("KEVX", now - 300, "KEVX/8/", 1, 3), ("KMOB", now - 1500, "KMOB/998/", 3, 9), ("KMOB", now - 1000, "KMOB/999/", 3, 9), ("KMOB", now - 500, "KMOB/1/", 3, 9)]
    assert seen() == sorted(first)
    put_chunk(root, "KMOB", 2, now - 60, 3, "E", time.time())  # the late last chunk; nothing else comes again
    time.sleep(chunks.MIN_AGE_S + 1)
    finished(chunks.complete_volume_stream(spark, "file://" + root, ["KMOB", "KEVX", "KNONE"]), put_batch(where), "append", where)
    assert seen() == sorted([*first, ("KMOB", now - 60, "KMOB/2/", 2, 6)])


def test_files_of_age_and_sidecars(spark):
    files = spark.createDataFrame([("a", 100.0), ("b", 54.9), ("c", 55.0), ("d", None)], "path string, m double").withColumn("modified", F.timestamp_seconds("m"))
    assert sorted(r.path for r in S.of_age(files, F.timestamp_seconds(F.lit(100))).collect()) == ["b", "c"]
    table = [300.0 - i for i in range(256)]
    bodies = [("f1.json", json.dumps({"ImageDataFunction": {"Table": table}})), ("f2.json", "{nonsense"), ("f3.json", "{}"), ("f4.json", None)]
    got = {r.path: r.kelvin_table for r in S.sidecar_tables(spark.createDataFrame(bodies, "path string, value string")).collect()}
    assert got == {"f1.json": table, "f2.json": None, "f3.json": None, "f4.json": None}


def test_public_cells_have_geometry(spark):
    from galeframe.operators.tracks import public_cells

    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    rows = [("a", 1, None, -87.12345, 30.5, float("nan"), []), ("a", 2, 1, float("nan"), 30.5, 51.0, None), (None, 3, None, None, None, None, [[ring]])]
    df = spark.createDataFrame(rows, "site string, cell_id long, split_from long, lon double, lat double, dbz double, polygons array<array<array<struct<x:double,y:double>>>>")
    got = {r.cell_id: json.loads(r.feature) for r in public_cells(df, F.timestamp_seconds(F.lit(0))).collect()}
    assert got[1]["geometry"] == {"type": "Point", "coordinates": [-87.123, 30.5]} and got[2]["geometry"] is None
    assert got[3]["geometry"] == {"type": "MultiPolygon", "coordinates": [[[list(p) for p in ring]]]}
    assert got[2]["properties"] == {"site": "a", "cell_id": 2, "dbz": 51.0, "split_from": 1, "valid_time": "1970-01-01T00:00:00Z"} and "dbz" not in got[1]["properties"]


def test_smoothing_is_a_gaussian():
    from galeframe.operators.detect import smoothed

    cells = np.array([(y, x) for y in range(9) for x in range(9)])
    values = np.zeros(81)
    values[40] = 100.0
    w = np.exp(-0.5 * (np.arange(-2, 3) / 0.5) ** 2)
    w /= w.sum()
    got = smoothed(cells, values, 0.5).reshape(9, 9)
    assert np.allclose(got[2:7, 2:7], 100 * np.outer(w, w)) and got[0].sum() == 0
    assert smoothed(cells, values, 0.0) is values


def test_broken_shapefiles_have_no_rings(spark):
    import io
    import zipfile

    from galeframe.sources.shapes import broken_shapes, zone_shapes

    def archive(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in members.items():
                z.writestr(name.replace("_", "."), data)
        return out.getvalue()

    files = [("no zip", b"nonsense"), ("no table", archive(a_shp=b"\0" * 100)), ("cut off", archive(a_shp=b"\0" * 100, a_dbf=b"\0" * 5)), ("empty", b""), ("null", None)]
    table = spark.createDataFrame([(p, bytearray(c) if c is not None else None) for p, c in files], "path string, content binary")
    assert zone_shapes(table).count() == 0
    got = {r.path: r.error for r in broken_shapes(table).collect()}
    assert set(got) == {p for p, _ in files} and "no .dbf" in got["no table"]
