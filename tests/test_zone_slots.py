"""Cells of few edges meet points in a compiled join; those of more edges give the same answer in one of their own."""

import random

from galeframe.operators import zones as Z


def test_join_is_compiled_and_long_rows_count(spark, monkeypatch):
    r = random.Random(5)
    rings = [(f"z{k}", [(x, y), (x + a, y), (x + a, y + b), (x + a / 2, y + b / 3), (x, y + b)]) for k in range(12) for x, y, a, b in ((r.uniform(0, 3), r.uniform(0, 3), r.uniform(0.2, 2), r.uniform(0.2, 2)),)]
    spots = [(i, r.uniform(-1, 6), r.uniform(-1, 6)) for i in range(1500)]
    points = spark.createDataFrame(spots, "id long, lat double, lon double")

    def inside(x, y, ring):
        return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1

    want = sorted((i, z) for i, y, x in spots for z, ring in rings if inside(x, y, ring))
    index = Z.zone_index(spark.createDataFrame(rings, "zone string, ring array<struct<lon:double,lat:double>>"), 0.25).cache()
    for slots in (2, 6):
        monkeypatch.setattr(Z, "SLOTS", slots)
        assert sorted((p.id, p.zone) for p in Z.in_zones(points, index, 0.25).collect()) == want
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = Z.in_zones(points, index, 0.25)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    joins = [line for line in plan.split("\n") if "Join " in line]
    assert any("*(" in line and "SortMergeJoin" in line and "y1_0" in line for line in joins)
    assert not any("Broadcast" in line for line in joins)
