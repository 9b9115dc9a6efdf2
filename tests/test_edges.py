"""Empty tables, nulls and repeated rows through the weather operators: no crash, and the results that docstrings state."""

import math

from pyspark.sql import functions as F

from galeframe.operators import alerts as A
from galeframe.operators import detect as D
from galeframe.operators import grid as G
from galeframe.operators import lightning as L
from galeframe.operators import raster as R
from galeframe.operators import telemetry as M
from galeframe.operators import tracks as T
from galeframe.operators import verification as V

OBS = "site string, obs_id long, track_id long, family_id long, vol long, seed_x double, seed_y double, area double, dbz double, top double, split_from long"


def test_scores_of_no_tracks(spark):
    s = T.collapsed(spark.createDataFrame([], OBS), "track_id")
    for df in (s, T.steps(s), T.trends(s), T.durations(s), T.linearity(s), T.fragmentation(s), T.speed_summary(T.steps(s)), T.motion(T.steps(s)), T.lifecycle(s.withColumn("split_from", F.lit(None).cast("long"))), T.churn(T.family_rollup(spark.createDataFrame([], OBS)))):
        assert df.count() == 0


def test_scores_of_null_sites_and_tracks(spark):
    rows = [("a", 1, 1, 1, 0, 0.0, 0.0, 4.0, 50.0, 3.0, None), ("a", 2, 1, 1, 1, 3000.0, 0.0, 8.0, 52.0, 3.0, None), (None, 3, 1, 1, 0, 0.0, 0.0, 4.0, 40.0, 3.0, None), (None, 4, 1, 1, 1, 600.0, 0.0, 4.0, 41.0, 3.0, None), ("a", 5, None, None, 1, 9.0, 9.0, 1.0, 60.0, 3.0, None), ("a", 6, -1, None, 1, 9.0, 9.0, 1.0, 60.0, 3.0, None)]
    s = T.collapsed(spark.createDataFrame(rows, OBS), "track_id")
    assert sorted(((r.site or "", r.vol, r.n_cells) for r in s.collect())) == [("", 0, 1), ("", 1, 1), ("a", 0, 1), ("a", 1, 1)]
    got = {r.site: (r.n, r.mean_ms, r.p95_ms) for r in T.speed_summary(T.steps(s)).collect()}
    assert got == {"a": (1, 10.0, 10.0), None: (1, 2.0, 2.0)}
    alive = {r.site: (r.births, r.deaths) for r in T.lifecycle(s.withColumn("split_from", F.lit(None).cast("long"))).collect()}
    assert alive == {"a": (0, 0), None: (0, 0)}  # both live through the first and the last volume
    votes = T.votes(spark.createDataFrame([("a", 1, None, 1), ("a", 2, 7, 1), ("b", 1, 7, 1)], "site string, grp long, uid long, pos long"))
    assert {(r.site, r.grp): (r.uid, r.votes, r.size) for r in votes.collect()} == {("a", 1): (None, 0, 1), ("a", 2): (7, 1, 1), ("b", 1): (7, 1, 1)}
    assert {(r.site, r.grp): (r.kept, r.parent) for r in T.claims(votes).collect()} == {("a", 1): (None, None), ("a", 2): (7, None), ("b", 1): (7, None)}


def test_reports_of_another_site_or_nowhere(spark):
    objects = spark.createDataFrame([("a", 1, 0, 0.0, 0.0), ("b", 2, 0, 0.0, 0.0), ("a", 3, 0, None, 0.0), (None, 4, 0, 0.0, 0.0)], "site string, obj long, vol long, seed_x double, seed_y double")
    reports = spark.createDataFrame([("a", 7, 0, 0.0, 14_999.0), ("a", 8, 0, None, 1.0), ("c", 9, 0, 0.0, 0.0)], "site string, report_id long, vol long, x double, y double")
    pairs = V.matched(objects, reports)
    assert [tuple(p) for p in pairs.collect()] == [("a", 0, 1, 7)]
    got = {r.site: (r.objects, r.reports, r.hits, r.pod, r.far) for r in V.contingency(objects, reports, pairs).collect()}
    assert got["a"] == (2, 2, 1, 0.5, 0.5) and got["b"] == (1, 0, 0, 0.0, 1.0) and got["c"] == (0, 1, 0, 0.0, 0.0)
    assert V.contingency(objects.limit(0), reports.limit(0), pairs.limit(0)).count() == 0
    assert V.continuity(spark.createDataFrame([], "site string, family long, vol long, cell long")).count() == 0


def test_frames_without_pixels_and_with_gaps(spark):
    px = "frame long, row_no long, col_no long, level long"
    grid = spark.createDataFrame([(0, 0, 5, 5), (0, 1, 6, 6)], "row_no long, col_no long, out_row long, out_col long")
    rows = [(1, 0, 0, 9), (1, 0, 1, None), (2, 0, 1, 7), (2, 9, 9, 1)]
    got = {(r.frame, r.out_row): r.level for r in R.gathered(spark.createDataFrame(rows, px), grid).collect()}
    assert got == {(1, 5): 9, (1, 6): 0, (2, 5): 0, (2, 6): 7}
    assert R.gathered(spark.createDataFrame([], px), grid).count() == 0 and R.cloud_products(spark.createDataFrame([], px)).count() == 0
    frames = [(f, 0, 0, f % 200) for f in (0, 1, 47, 48, 96, 143, 1000)] + [(3, 0, 0, None)]
    out = {r.frame: r.cooling for r in R.cloud_products(spark.createDataFrame(frames, px)).collect()}
    step = (340.349 - 89.62) / 255
    assert out[0] is None and 3 not in out
    for before, now in ((0, 1), (1, 47), (47, 48), (48, 96), (96, 143), (143, 1000)):
        assert math.isclose(out[now], (now % 200 - before % 200) * step, abs_tol=1e-9)


def test_detection_of_nothing(spark):
    columns = "site string, vol long, iy long, ix long, colmax double, etop_km double, ebase_km double, nlev_seed long"
    assert D.detect(spark.createDataFrame([], columns)).count() == 0
    low = [("a", 1, y, x, 20.0, None, None, 0) for y in range(9) for x in range(9)]
    assert D.detect(spark.createDataFrame(low, columns)).count() == 0
    no_top = [("a", 1, y, x, 50.0, None, None, 3) for y in range(9) for x in range(9)]
    assert D.detect(spark.createDataFrame(no_top, columns)).count() == 0
    tall = [(s, 1, y, x, 50.0, 5.0, 1.0, 3) for s in ("a", None) for y in range(9) for x in range(9)]
    got = D.detect(spark.createDataFrame(tall, columns), D.LadderParams(sigma=0.0)).collect()
    assert [(r.site, r.area_km2, r.cx, r.cy) for r in sorted(got, key=lambda r: r.site or "")] == [(None, 81.0, 4.0, 4.0), ("a", 81.0, 4.0, 4.0)]
    wide = D.object_statistics(spark.createDataFrame(tall, columns).withColumn("obj", F.lit(1)), cell_km=2.0).collect()
    assert {r.area_km2 for r in wide} == {324.0}


def test_gates_without_values(spark):
    gates = spark.createDataFrame([("a", 1, 0.5, 10.0, 5000.0, None), ("a", 1, 0.5, 10.0, 5000.0, float("nan")), ("a", 1, 0.5, 10.0, 5000.0, 40.0), ("a", 1, 0.5, 10.0, 5000.0, 50.0), ("a", 1, 0.5, 10.0, None, 50.0)], "site string, vol long, el_deg double, az_deg double, range_m double, dbz double")
    grid = G.grid_volumes(gates)
    assert [(r.n_gates, r.dbz_max) for r in grid.collect()] == [(2, 50.0)]
    assert [(r.n_voxels, r.multi_pct) for r in G.bin_bias(grid).collect()] == [(1, 100.0)]
    empty = G.grid_volumes(gates.limit(0))
    assert empty.count() == G.fill_gaps(empty, "dbz_max").count() == G.bin_bias(empty).count() == 0


def test_flashes_hazards_and_lines_of_nothing(spark):
    flashes = spark.createDataFrame([], "flash_id long, flash_time timestamp, satellite string, lat double, lon double, energy double")
    places = spark.createDataFrame([("home", 30.0, -87.0), ("unknown", None, None)], "place string, plat double, plon double")
    near = L.near_places(flashes, places, F.current_timestamp())
    assert [(r.place, r.nearest_mi, r.n10) for r in L.proximity(near, places).collect()] == [("home", None, 0)]
    assert L.rates(near, F.current_timestamp()).count() == 0 and L.feed_counts(flashes, F.current_timestamp()).count() == 0
    states = spark.createDataFrame([("a", 1, 0.0, True), ("a", 2, 50.0, True), ("a", 3, 60.0, None), ("a", 4, 200.0, None), (None, 5, 0.0, False)], "k string, i long, t double, state boolean").withColumn("t", F.timestamp_seconds("t"))
    assert sorted(map(str, ((r.k, r.state, r.n) for r in L.held(states, "k", "i", "t", 60).collect()))) == ["('a', None, 2)"]
    lines = spark.createDataFrame([("s", 1, "[m] gain: -1.5 omega: 1.2.3"), ("s", 2, "gain: 9"), ("t", 1, None), ("u", 3, "[m]")], "src string, n long, line string")
    got = {r.src: (r.gain, r.omega) for r in M.scraped(lines, "src", "n", "line", "[m]", {"gain": "gain", "omega": "omega"}).collect()}
    assert got == {"s": (-1.5, None), "u": (None, None)}
    none = A.segments(spark.createDataFrame([(1, None), (2, "")], "id int, text string"))
    assert none.count() == 0 and A.active(A.alert_state(none, ["id", "pos"])).count() == 0
