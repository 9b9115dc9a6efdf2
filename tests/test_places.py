import json
import math

from pyspark.sql import functions as F

from galeframe.operators import alerts as A
from galeframe.operators import lightning as L
from galeframe.operators import raster as R
from galeframe.operators import verification as V
from galeframe.sources import files, shared


def test_flashes_are_found_across_180_degrees_and_at_a_pole(spark):
    flashes = spark.createDataFrame([(0.0, -179.98, 1), (0.0, 170.0, 2), (89.9, 100.0, 3)], "lat double, lon double, flash_id int").withColumn("flash_time", F.lit("2024-01-01").cast("timestamp"))
    places = spark.createDataFrame([("line", 0.0, 179.97), ("pole", 89.9, -80.0), ("quiet", 40.0, 10.0), ("nowhere", None, None)], "place string, plat double, plon double")
    near = L.near_places(flashes, places, F.lit("2024-01-01 00:10:00").cast("timestamp"))
    assert {(r.place, r.flash_id) for r in near.collect()} == {("line", 1), ("pole", 3)}
    got = {r.place: (r.n10, r.n30, r.last_flash is None) for r in L.proximity(near, places).collect()}
    assert got == {"line": (1, 1, False), "pole": (0, 1, False), "quiet": (0, 0, True)}


def test_site_range_across_180_degrees(spark):
    reports = spark.createDataFrame([(1, 10.0, -179.5), (2, 10.0, 178.9), (3, 10.0, 170.0), (4, None, 1.0)], "report_id int, lat double, lon double")
    sites = spark.createDataFrame([("a", 10.0, 179.8)], "site string, slat double, slon double")
    assert {r.report_id for r in V.in_range(reports, sites).collect()} == {1, 2}


def test_mercator_axis_ends_on_the_parallels(spark):
    rows = spark.range(101).select(R.mercator_latitude(F.col("id"), 101, 24.0, 50.0).alias("lat")).collect()
    assert math.isclose(rows[0].lat, 50.0) and math.isclose(rows[-1].lat, 24.0) and all(a.lat > b.lat for a, b in zip(rows, rows[1:], strict=False))
    assert R.mercator_height(360, -180.0, -85.0511287798, 180.0, 85.0511287798) == 360


def test_segments_of_one_office(spark):
    text = "FLZ201-072000-\n/O.NEW.KMOB.FZ.F.0001.240107T0000Z-240108T0000Z/\n/O.NEW.KTAE.FL.O.0002.240107T0000Z-240108T0000Z/\n"
    rows = spark.createDataFrame([(1, text), (2, "no code"), (3, None)], "bulletin_id int, text string")
    assert sorted(r.name for r in A.segments(rows).collect()) == ["Flood Outlook", "Freeze Forecast"]
    assert [r.name for r in A.segments(rows, "KMOB").collect()] == ["Freeze Forecast"]


def test_published_files_are_replaced_at_once(spark, tmp_path):
    path = tmp_path / "alerts.json"
    for k in range(2):
        shared.publish(spark, json.dumps({"k": k}), str(path))
        assert json.loads(path.read_text()) == {"k": k}
    assert not list(tmp_path.glob("*.tmp"))


def test_case_list(spark, tmp_path):
    rows = [{"site": "KMOB", "start": "2024-01-01T00:00:00Z", "end": "2024-01-01T02:00:00Z"}, {"site": None, "start": "x", "end": "y"}]
    (tmp_path / "cases.json").write_text(json.dumps(rows))
    assert [r.site for r in files.case_list(spark, str(tmp_path)).collect()] == ["KMOB"]
