"""The zone index against a ray cast over all pairs, and its plan."""

import math
import random

import pytest

from galeframe.operators import zones as Z

SCHEMA = "zone string, ring array<struct<lon:double,lat:double>>"


def star(r, x, y, size, n):
    turn = r.random()
    return [(x + size * q * math.cos(6.2831853 * (i + turn) / n), y + size * q * math.sin(6.2831853 * (i + turn) / n)) for i in range(n) for q in (r.uniform(0.4, 1.0),)]


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for shift in (-360, 0, 360):
            for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True):
                if (b > y) != (d > y) and x + shift < (c - a) * (y - b) / (d - b) + a:
                    odd = not odd
    return odd


@pytest.mark.parametrize("crowded", [64, 6])
def test_points_in_zones_equal_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(Z, "CROWDED", crowded)
    r = random.Random(4)
    zones = {}
    for k in range(25):
        x, y, size = r.choice([179.8, -179.9, 10.0, 11.0]), r.uniform(-3, 3), r.choice([0.05, 0.6, 2.5])
        zones[f"z{k}"] = [star(r, x, y, size, r.choice([3, 9, 40]))]
        if k % 3 == 0:
            zones[f"z{k}"].append(star(r, x, y, size * 0.3, 12)[::-1])  # a hole, or part of one
        if k % 4 == 0:
            zones[f"z{k}"].append(star(r, x + 7, y, size, 5))  # another part
    wrap = lambda x: (x + 180) % 360 - 180
    rows = [(k, [(wrap(x), y) for x, y in ring]) for k, rings in zones.items() for ring in rings]
    rows += [("few", [(10.0, 0.0), (11.0, 1.0)]), ("null", [(10.0, 0.0), (11.0, None), (11.0, 1.0)]), (None, [(9.0, -3.0), (12.0, -3.0), (12.0, 3.0)]), ("none", None)]
    points = [(i, r.uniform(-5, 5), wrap(r.choice([179.8, 10.5, 17.5]) + r.gauss(0, 2)), "x") for i in range(3000)]
    points += [(9000, None, 10.0, "x"), (9001, 1.0, None, "x"), (9002, 95.0, 10.0, "x"), (9003, float("nan"), 10.0, "x")]
    index = Z.zone_index(spark.createDataFrame(rows, SCHEMA))
    assert (index.filter("level = 1").count() > 0) == (crowded == 6) and index.filter("full").count() > 0
    got = {(p.id, p.zone) for p in Z.in_zones(spark.createDataFrame(points, "id long, lat double, lon double, p string"), index).collect()}
    assert got == {(i, z) for i, y, x, _ in points[:3000] for z, rings in zones.items() if inside(x, y, rings)}
    plan = Z.in_zones(spark.createDataFrame(points, "id long, lat double, lon double, p string"), index)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_no_zones_and_no_points(spark):
    none, points = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, 1.0, 1.0)], "id long, lat double, lon double")
    square = spark.createDataFrame([("a", [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])], SCHEMA)
    assert Z.in_zones(points, Z.zone_index(none)).count() == 0
    assert Z.in_zones(points.limit(0), Z.zone_index(square)).count() == 0
    assert [tuple(p) for p in Z.in_zones(points, Z.zone_index(square)).collect()] == [(1, 1.0, 1.0, "a")]
