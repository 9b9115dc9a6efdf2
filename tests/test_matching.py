"""Objects meet reports without tables of cells in the driver."""

import random

from galeframe.operators import verification as V


def test_cells_are_never_broadcast(spark):
    """Small tables by estimate, which doesn't count a report's nine cells or a ring's many; the pairs are those of all."""
    r = random.Random(3)
    objects = [("ab"[i % 2], i, i % 3, r.uniform(0, 90e3), r.uniform(0, 90e3)) for i in range(60)]
    reports = [("ab"[i % 2], i, i % 3, r.uniform(0, 90e3), r.uniform(0, 90e3)) for i in range(200)]
    rings = [(s, i, v, [x + 25e3, x, x - 25e3, x], [y, y + 25e3, y, y - 25e3]) for s, i, v, x, y in objects]
    o = spark.createDataFrame(objects, "site string, obj long, vol long, seed_x double, seed_y double")
    p = spark.createDataFrame(reports, "site string, report_id long, vol long, x double, y double")
    z = spark.createDataFrame(rings, "site string, obj long, vol long, xs array<double>, ys array<double>")
    pairs = [(a, b, abs(a[3] - b[3]), abs(a[4] - b[4])) for a in objects for b in reports if a[0] == b[0] and a[2] == b[2]]
    near = {(a[0], a[2], a[1], b[1]) for a, b, dx, dy in pairs if dx * dx + dy * dy <= 15e3**2}
    either = near | {(a[0], a[2], a[1], b[1]) for a, b, dx, dy in pairs if dx + dy < 25e3}
    for df, want in ((V.matched(o, p), near), (V.matched_or_inside(o, p, z), either)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        got = [tuple(row) for row in df.collect()]
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(got) == sorted(want)
