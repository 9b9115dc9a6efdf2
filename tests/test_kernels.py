import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from galeframe.functions import bulletins as B
from galeframe.functions import geo
from galeframe.operators import detect as D
from galeframe.operators import envelope as E
from galeframe.operators import grid as G
from galeframe.operators import telemetry as M
from galeframe.operators.raster import albedo, kelvin, sun_elevation


def shape(test):
    return {(y, x) for y in range(200) for x in range(200) if test(y, x)}


def r(y, x, cy=100, cx=100):
    return math.hypot(y - cy, x - cx)


SHAPES = {
    "hook": (shape(lambda y, x: 12 < r(y, x) < 26 and not (x > 100 and abs(y - 100) < 12)), 0.623, 1.62),
    "bow": (shape(lambda y, x: r(y, x) < 30 and r(y, x, 88) > 22), 0.533, 1.89),
    "pair": (shape(lambda y, x: r(y, x, 100, 80) < 10 or r(y, x, 100, 125) < 10), 0.519, 1.93),
    "blob": (shape(lambda y, x: r(y, x) < 15), 0.978, 1.03),
}


@pytest.mark.parametrize("name", SHAPES)
def test_envelopes_of_known_shapes(name):
    cells, iou, excess = SHAPES[name]
    got = E.fidelity(cells, "footprint")
    assert got[0] == 1.0 and got[1] == pytest.approx(1.0)
    hull = E.fidelity(cells, "convex")
    assert hull[0] == pytest.approx(iou, abs=0.03) and hull[1] == pytest.approx(excess, abs=0.06)


def test_footprint_has_holes_and_corners():
    ring = {(y, x) for y in range(5) for x in range(5)} - {(2, 2)}
    assert sorted(map(E.ring_area, E.footprint(ring))) == [-1.0, 25.0]
    assert sorted(map(E.ring_area, E.footprint({(0, 0), (1, 1)}))) == [1.0, 1.0]
    with pytest.raises(ValueError):
        E.fidelity({(0, 0)}, "other")


def test_simplify():
    line = np.array([[0, 0], [1, 0.001], [2, 0], [2, 2], [0, 2], [0, 0]], float)
    assert E.simplified(line, 0.01).tolist() == [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    assert E.simplified(line[:2], 0.01) is None


def flood(cells):
    left, out = set(cells), []
    while left:
        stack, own = [left.pop()], set()
        while stack:
            c = stack.pop()
            own.add(c)
            for n in [(c[0] + a, c[1] + b) for a, b in D.NEXT_TO]:
                if n in left:
                    left.discard(n)
                    stack.append(n)
        out.append(frozenset(own))
    return set(out)


def test_labels_are_a_flood_fill(spark):
    rnd = random.Random(4)
    cells = {(rnd.randint(0, 20), rnd.randint(0, 20)) for _ in range(180)}
    df = spark.createDataFrame([(0, 1, y, x) for y, x in cells], "site int, vol int, iy bigint, ix bigint")
    by = {}
    for row in D.label_columns(df).collect():
        by.setdefault(row.label, set()).add((row.iy, row.ix))
    assert {frozenset(v) for v in by.values()} == flood(cells)


def test_ladder_supersedes():
    cells = np.array([(y, x) for y in range(12) for x in range(12)])
    values = np.full(144, 32.0)
    values[(cells[:, 0] < 3) & (cells[:, 1] < 8)] = 47
    values[(cells[:, 0] > 8) & (cells[:, 1] < 8)] = 41
    found = D.ladder(cells, values, D.LadderParams(n_min=20))
    assert [len(f) for f in found] == [24, 24]
    values[:] = 32
    assert [len(f) for f in D.ladder(cells, values, D.LadderParams(n_min=20))] == [144]


def test_detector_parts_and_gates(spark):
    rows = []
    for y in range(14):
        for x in range(14):
            peak = 52 - 3 * min(r(y, x, 4, 4), r(y, x, 9, 9))
            rows.append((0, 0, y, x, max(31.0, peak), 8.0, 1.0, 4))
    df = spark.createDataFrame(rows, "site int, vol int, iy bigint, ix bigint, colmax double, etop_km double, ebase_km double, nlev_seed bigint")
    got = D.detect(df, D.LadderParams(n_min=4)).collect()
    assert len(got) == 2 and sum(g.area_km2 for g in got) == 196
    thin = df.withColumn("nlev_seed", F.lit(2).cast("bigint"))
    assert D.detect(thin, D.LadderParams(n_min=4)).count() == 0
    assert D.admitted(spark.createDataFrame([(3, 3.0, 4.0), (2, 3.0, 4.0), (3, 2.9, 4.0), (3, 3.0, 3.9)], "n_levels int, etop_km double, area_km2 double")).count() == 1


def test_suppression_is_a_plain_loop(spark):
    rnd = random.Random(6)
    objs = [(0, 0, i, rnd.uniform(40, 60), 5.0, rnd.uniform(0, 30), rnd.uniform(0, 30)) for i in range(60)]
    kept = []
    for o in sorted(objs, key=lambda o: (-o[3], -o[4], o[5], o[6], o[2])):
        if all(math.hypot(o[5] - k[5], o[6] - k[6]) >= 6 for k in kept):
            kept.append(o)
    df = spark.createDataFrame(objs, "site int, vol int, obj int, max_dbz double, area_km2 double, x_km double, y_km double")
    assert sorted(x.obj for x in D.suppressed(df, 6.0).collect()) == sorted(k[2] for k in kept)


def test_gap_fill_never_leaves_the_ends(spark):
    df = spark.createDataFrame([(0, 0, 1, 1, k, float(k * k)) for k in (3, 4, 6, 8, 10, 13, 16, 21, 26)], "site int, vol int, iy int, ix int, iz bigint, v double")
    got = {x.iz: x for x in G.fill_gaps(df, "v").collect()}
    assert sorted(got) == list(range(3, 27)) and got[5].v == 26 and got[5].filled and not got[6].filled


def test_mean_is_at_most_the_maximum(spark):
    rnd = random.Random(8)
    gates = spark.createDataFrame([(0, 0, 0.5, rnd.uniform(0, 360), rnd.uniform(2e3, 1.5e5), rnd.choice([None, rnd.uniform(-10, 70)])) for _ in range(3000)], "site int, vol int, el_deg double, az_deg double, range_m double, dbz double")
    assert G.grid_volumes(gates).filter("dbz_cal > dbz_max + 1e-9").count() == 0


def test_ugc_cases(spark):
    cases = {"FLZ201>203-ALZ051-058": ["ALZ051", "ALZ058", "FLZ201", "FLZ202", "FLZ203"], "FLC005>003": [], "012-GAC001": ["GAC001"], "TXZ010-011>012-ARC001-003": ["ARC001", "ARC003", "TXZ010", "TXZ011", "TXZ012"]}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {x.t: x.u for x in df.select("t", B.expand_ugc(F.col("t")).alias("u")).collect()} == cases


BULLETIN = """FLZ201>203-
ALZ051-072000-
/O.NEW.KMOB.TO.W.0001.240101T0000Z-240101T0100Z/
LAT...LON 3000 8600 3030 8600 3030 8650 31
TIME...MOT...LOC 0041Z 200DEG 25KT 3010 8620
GAC001-072000-
/O.CAN.KMOB.SV.A.0002.000000T0000Z-000000T0000Z/
/O.CON.KTAE.FF.Y.0003.240101T0000Z-240101T0100Z/
LAT...LON 3000 8600 3030 8600
"""


def test_segments_of_a_bulletin(spark):
    from galeframe.operators.alerts import segments

    got = segments(spark.createDataFrame([(1, BULLETIN), (2, None), (3, "")], "id int, text string")).orderBy("pos").collect()
    assert [g.key for g in got] == ["KMOB.TO.W.0001", "KMOB.SV.A.0002", "KTAE.FF.Y.0003"]
    assert got[0].ugc == ["ALZ051", "FLZ201", "FLZ202", "FLZ203"] and got[1].ugc == got[2].ugc == ["GAC001"]
    assert [tuple(p) for p in got[0].poly.ring] == [(-86.0, 30.0), (-86.0, 30.3), (-86.5, 30.3)]
    assert (got[0].motion.deg, got[0].motion.kt, got[0].motion.heading) == (200, 25, 20)
    assert got[1].poly is None and got[1].end_time is None and got[0].end_time is not None


def test_polygon_and_motion_are_kept_apart(spark):
    """Follow-ups that lack only one of them, or both, keep the last of each; a removal forgets both."""
    from galeframe.operators.alerts import active, alert_state, segments

    head = "FLZ201-072000-\n/O.{}.KMOB.{}.W.0001.240101T0000Z-240101T0100Z/\n"
    polygon, other = "LAT...LON 3000 8600 3030 8600 3030 8650\n", "LAT...LON 3100 8600 3130 8600 3130 8650\n"
    motion = "TIME...MOT...LOC 0041Z 200DEG 25KT 3010 8620\n"
    texts = [head.format("NEW", "TO") + polygon + motion, head.format("CON", "TO") + other, head.format("CON", "TO"), head.format("NEW", "SV") + polygon, head.format("CON", "SV") + other + motion.replace("200", "100"), head.format("NEW", "FF") + polygon + motion, head.format("CAN", "FF"), head.format("CON", "FF"), None, ""]
    rows = segments(spark.createDataFrame(list(enumerate(texts)), "id int, text string"))
    got = {r.phen: (r.poly and r.poly.ring[0].lat, r.motion and r.motion.deg) for r in active(alert_state(rows, ["id", "pos"])).collect()}
    assert got == {"TO": (31.0, 200), "SV": (31.0, 100), "FF": (None, None)}


def test_state_of_hazards(spark):
    from galeframe.operators.alerts import active, alert_state, push_events

    rows = [("a", 1, "NEW", "p1"), ("a", 2, "CON", None), ("b", 1, "NEW", "p"), ("b", 2, "CAN", None), ("b", 3, "CON", None), ("c", 1, "CON", None), ("d", 1, "NEW", "p"), ("d", 2, "EXP", None), ("d", 3, "NEW", None)]
    df = spark.createDataFrame([(*x, "W", "TO") for x in rows], "key string, seq int, action string, poly string, sig string, phen string")
    lives = alert_state(df, ["seq"])
    assert {x.key: x.poly for x in active(lives).collect()} == {"a": "p1", "b": None, "c": None, "d": None}
    assert sorted((x.key, x.seq) for x in push_events(lives).collect()) == [("a", 1), ("b", 1), ("d", 1), ("d", 3)]


def test_geodesy(spark):
    row = spark.range(1).select(
        geo.haversine_km(F.lit(30.0), F.lit(-87.0), F.lit(31.0), F.lit(-87.0)).alias("d"),
        geo.shoelace_area(F.expr("array(0d, 4d, 4d, 0d)"), F.expr("array(0d, 0d, 3d, 3d)")).alias("a"),
        geo.in_ring(F.lit(1.0), F.lit(1.0), F.expr("array(0d, 4d, 4d, 0d)"), F.expr("array(0d, 0d, 3d, 3d)")).alias("i"),
        geo.in_ring(F.lit(5.0), F.lit(1.0), F.expr("array(0d, 4d, 4d, 0d)"), F.expr("array(0d, 0d, 3d, 3d)")).alias("o"),
        F.struct(*(c.alias(n) for c, n in zip(geo.aeqd_to_lonlat(F.lit(0.0), F.lit(111194.92664), F.lit(30.0), F.lit(-87.0)), ("lon", "lat"), strict=True))).alias("p"),
        F.struct(*(c.alias(n) for c, n in zip(geo.travelled(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(60.0)), ("lat", "lon"), strict=True))).alias("m"),
        sun_elevation(F.lit(0.0), F.lit(0.0), F.lit(81), F.lit(12.0)).alias("sun"),
        albedo(F.lit(0.5), F.lit(4.0)).alias("dark"), kelvin(F.lit(0)).alias("k0"), kelvin(F.lit(1), F.expr("transform(sequence(0, 255), i -> 300d - i)")).alias("k1"), kelvin(F.lit(0), F.expr("array(1d)")).alias("k2"),
    ).first()
    assert row.d == pytest.approx(111.195, abs=1e-3) and row.a == 12 and row.i and not row.o
    assert row.p.lat == pytest.approx(31.0, abs=1e-6) and row.p.lon == pytest.approx(-87.0)
    assert row.m.lat == pytest.approx(0, abs=1e-9) and row.m.lon == pytest.approx(55.56 / 111.19493, abs=1e-4)
    assert row.sun > 85 and row.dark is None and row.k0 == 340.349 and row.k1 == 299 and row.k2 == 340.349


def test_cooldown_is_a_plain_loop(spark):
    rnd = random.Random(9)
    rows = [(k, rnd.randint(0, 5000)) for k in (1, 2) for _ in range(80)]
    want = set()
    for k in (1, 2):
        last = None
        for t in sorted(t for u, t in rows if u == k):
            if last is None or t - last >= 300:
                want.add((k, t))
                last = t
    got = M.allowed_restarts(spark.createDataFrame(rows, "u int, t bigint"), ["u"], "t").collect()
    assert {(x.u, x.t) for x in got} == want


def test_cooldown_of_a_key_larger_than_a_batch(spark):
    rows = [(1, 7 * i % 250_000) for i in range(35_000)] + [(None, 5), (None, 5), (2, None), (3, 0), (3, 300)]
    got = M.allowed_restarts(spark.createDataFrame(rows, "u int, t bigint").repartition(5), ["u"], "t")
    assert "collect_list" not in got._jdf.queryExecution().toString()
    want, last = [(3, 0), (3, 300), (None, 5)], None
    for t in sorted({t for u, t in rows if u == 1}):
        if last is None or t - last >= 300:
            want.append((1, t))
            last = t
    assert sorted(map(str, ((x.u, x.t) for x in got.collect()))) == sorted(map(str, want))


def test_status_order(spark):
    cases = [(False, 0, None, None, "down"), (True, 10, None, 99, "ok (grace)"), (True, 500, None, 99, "disconnected"), (True, 500, 130_000, 99, "stalled"), (True, 500, 5, 31, "no-products"), (True, 500, 5, 5, "ok"), (True, 500, 5, None, "ok")]
    df = spark.createDataFrame(cases, "up boolean, age int, socket int, product int, want string")
    assert df.filter(M.receiver_status(F.col("up"), F.col("age"), F.col("socket"), F.col("product")) != F.col("want")).count() == 0


def test_watershed_gives_each_side_its_cells():
    values = {(0, x): float(v) for x, v in enumerate([5, 4, 3, 2, 3, 4, 5])}
    assert D.watershed(values, {(0, 0): 1, (0, 6): 2}) == {(0, 0): 1, (0, 1): 1, (0, 2): 1, (0, 3): 1, (0, 4): 2, (0, 5): 2, (0, 6): 2}
