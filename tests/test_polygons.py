"""Overlap of polygons against counted pixels and exact shapes; nesting; Delaunay triangulations and concave hulls."""

import random

import numpy as np
import pytest

from galeframe.operators import envelope as E
from galeframe.operators import polygons as P


def pixels(rings, step=0.05):
    """The share of small squares whose centre is inside, by parity."""
    g = np.arange(-1, 11, step) + step / 2 + 1e-7
    x, y = (v.ravel() for v in np.meshgrid(g, g))
    return E.inside([[*map(tuple, r), tuple(r[0])] for r in rings], x, y)


@pytest.mark.parametrize("seed", range(12))
def test_areas_equal_counted_pixels(seed):
    r = np.random.default_rng(seed)
    shape = lambda: [r.uniform(0, 10, (r.integers(3, 9), 2)) for _ in range(r.integers(1, 4))]  # noqa: E731  # rings that cross themselves and each other
    if seed % 3 == 0:
        shape = lambda: [r.integers(0, 10, (r.integers(3, 9), 2)).astype(float) for _ in range(2)]  # noqa: E731  # shared corners and sides
    a, b = shape(), shape()
    got, cell = P.areas(a, b), 0.05**2
    in_a, in_b = pixels(a), pixels(b)
    for value, hit in zip(got, (in_a, in_b, in_a & in_b), strict=True):
        assert abs(value - hit.sum() * cell) < 1.0
    assert abs(sum(P.areas([t], [])[0] for t in P.clipped(a, b)) - got[2]) < 1e-9


def test_areas_of_exact_shapes():
    square = lambda x, y, s: np.array([(x, y), (x + s, y), (x + s, y + s), (x, y + s)], dtype=float)
    hole = [square(0, 0, 10), square(2, 2, 6)]
    assert P.areas([square(0, 0, 2)], [square(1, 1, 2)]) == (4, 4, 1)
    assert P.areas([square(0, 0, 2)], [square(2, 0, 2)]) == (4, 4, 0)  # a shared side
    assert P.areas([square(0, 0, 2)], [square(2, 2, 2)]) == (4, 4, 0)  # a shared corner
    assert P.areas([square(0, 0, 2)], [square(0, 0, 2)]) == (4, 4, 4)
    assert P.areas(hole, [square(3, 3, 2)]) == (64, 4, 0) and P.areas(hole, [square(0, 0, 5)]) == (64, 25, 16)
    assert P.areas([], [square(0, 0, 1)]) == (0, 1, 0) and P.areas([square(0, 0, 1)[:2]], []) == (0, 0, 0)


def test_overlaps_of_a_table(spark):
    r = random.Random(1)
    ring = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    rows = [("a", i, [ring(r.uniform(-30, 30), r.uniform(-30, 30), r.uniform(1, 15))]) for i in range(60)] + [("a", 100, None), ("a", 101, []), ("b", 1, [ring(0.0, 0.0, 50.0)])]
    t = spark.createDataFrame(rows, "site string, id long, polygon array<array<struct<x:double,y:double>>>")
    got = {(x.site, x.a, x.b): x.shared for x in P.overlaps(t, t, ["site"], 8.0).collect()}
    span = lambda p, q, k: max(0.0, min(p[0][2][k], q[0][2][k]) - max(p[0][0][k], q[0][0][k]))
    want = {(s, i, j): a for s, i, p in rows for u, j, q in rows if s == u and p and q and (a := span(p, q, 0) * span(p, q, 1)) > 0}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    from pyspark.sql import functions as F

    moved = t.withColumn("polygon", P.translated(F.col("polygon"), F.lit(100.0), F.lit(0.0)))
    assert P.overlaps(t, moved.filter("id < 60"), ["site"], 8.0).filter("site = 'a'").count() == 0


def test_rings_nest_by_depth():
    box = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    parts = E.nested([box(3, 7), box(0, 10), box(20, 30), box(4, 6), box(1, 9)[::-1], box(22, 24), [(0, 0), (1, 1), (0, 0)]])
    assert [[r[0][0] for r in p] for p in parts] == [[0, 1], [20, 22], [3, 4]]
    ring = {(y, x) for y in range(7) for x in range(7)} - {(y, x) for y in range(1, 6) for x in range(1, 6)} | {(3, 3)}
    assert [len(p) for p in E.nested(E.footprint(ring))] == [2, 1]


def test_triangles_are_delaunay():
    r = np.random.default_rng(2)
    for n in (3, 8, 40):
        p = np.unique(r.integers(0, 12, (n, 2)), axis=0)
        t = E.delaunay(p)
        a, b, c = (p[t[:, k]].astype(float) for k in range(3))
        area = ((b - a)[:, 0] * (c - a)[:, 1] - (b - a)[:, 1] * (c - a)[:, 0]) / 2
        assert (area > 0).all()
        for i in range(len(t)):  # no point within any circle
            q = np.array([[*(v - o), ((v - o) ** 2).sum()] for o in p for v in (a[i], b[i], c[i])]).reshape(-1, 3, 3)
            assert (np.linalg.det(q) < 1e-6).all()
        pts = sorted(map(tuple, p.tolist()))
        half = lambda run: _chain(run)[:-1]
        ring = half(pts) + half(pts[::-1])
        assert abs(area.sum() - abs(E.ring_area([*ring, ring[0]]))) < 1e-9
    assert len(E.delaunay(np.array([(0, 0), (1, 1), (2, 2)]))) == 0


def _chain(run):
    out = []
    for p in run:
        while len(out) >= 2 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
            out.pop()
        out.append(p)
    return out


def test_concave_hulls_lie_between_footprint_and_convex_hull():
    g = [(y, x) for y in range(60) for x in range(60)]
    shapes = {
        "square": {(y, x) for y, x in g if 10 <= y < 20 and 10 <= x < 20},
        "hook": {(y, x) for y, x in g if 8 < np.hypot(x - 30, y - 30) < 22 and not (x > 30 and abs(y - 30) < 10)},
        "pair": {(y, x) for y, x in g if np.hypot(x - 12, y - 30) < 8 or np.hypot(x - 46, y - 30) < 8},
        "line": {(3, x) for x in range(10)}, "one": {(4, 4)}, "corner": {(0, 0), (1, 1)},
    }
    for name, cells in shapes.items():
        rings = E.concave_hull(cells)
        area = abs(sum(map(E.ring_area, rings)))
        convex = abs(E.ring_area(E.convex_hull(cells)))
        assert len(cells) - 1e-9 <= area <= convex + 1e-9, name
        xs, ys = (np.array([c[k] for c in cells], dtype=float) + d for k, d in ((1, 1e-7), (0, 3e-7)))
        assert E.inside(rings, xs, ys).all(), name
    iou = {n: [E.fidelity(c, m)[0] for m in ("footprint", "concave", "convex")] for n, c in shapes.items()}
    assert all(a >= b >= c for a, b, c in iou.values()) and iou["hook"][1] > iou["hook"][2] + 0.1
    assert abs(sum(map(E.ring_area, E.concave_hull(shapes["square"])))) == 100
    assert E.concave_hull(set()) == []
