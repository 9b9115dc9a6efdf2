"""Queries whose results a narrower join or a coarser step had cut."""

import numpy as np
from pyspark.sql import functions as F

from galeframe.functions.quantiles import exact_quantiles
from galeframe.operators import grid as G
from galeframe.operators import verification as V
from galeframe.plans.registry import QUERIES, load

load()


def test_interval_pairs_all_sites(spark, tmp_path):
    keys = [(k, k * 5 + 1) for k in range(1, 60)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted((r.v, r.r) for r in QUERIES["volume_report_interval"](spark, str(tmp_path)).collect())
    assert got == sorted((v, r) for v, _ in keys for r, _ in keys if abs(7 * v - 11 * r) <= 15)


def test_interval_by_columns(spark):
    at = lambda rows, names: spark.createDataFrame(rows, f"{names[0]} long, site string, s long").select(names[0], "site", F.timestamp_seconds("s").alias(names[1]))
    v, r = at([(1, "a", 900), (2, "b", 0), (3, None, 900)], ("v", "vt")), at([(7, "a", 0), (8, "b", 1801), (9, None, 900)], ("r", "rt"))
    pairs = lambda df: sorted((x.v, x.r) for x in df.select("v", "r").collect())
    assert pairs(V.within_minutes(v, r)) == [(1, 7), (1, 9), (2, 7), (2, 9), (3, 7), (3, 9)]
    assert pairs(V.within_minutes(v, r, by=("site",))) == [(1, 7)]


def test_bias_quantiles_are_of_the_differences_themselves(spark):
    r = np.random.default_rng(3)
    rows = [(s, 0, 0, i, 0, 50.0, 1 + i % 3, 50.0 - d) for s, n in (("a", 500), (None, 41), ("c", 3)) for i, d in enumerate(r.gamma(2.0, 0.0004, n).tolist())]
    rows += [("none", 0, 0, 0, 0, 50.0, 1, 50.0), ("c", 0, 0, 9, 0, 50.0, 2, None)]
    voxels = spark.createDataFrame(rows, "site string, vol long, iz long, iy long, ix long, dbz_max double, n_gates long, dbz_cal double")
    got = {x.site: (x.n_voxels, x.median_db, x.p95_db) for x in G.bin_bias(voxels).collect()}
    for site in ("a", None, "c"):
        d = [x[5] - x[7] for x in rows if x[0] == site and x[6] > 1 and x[7] is not None]
        assert np.allclose(got[site][1:], np.quantile(d, [0.5, 0.95]), rtol=0, atol=1e-12)
    assert got["none"] == (1, None, None) and len(got) == 4


def test_exact_quantiles_of_any_step(spark):
    r = np.random.default_rng(5)
    some = {("x", 1): [*r.normal(0, 1e3, 300), *[7.25] * 200], ("x", None): [-1.0], (None, 1): [-2.0, -1.5, 1e300, float("inf")], ("y", 2): [0.0, -0.0, 1.0]}
    rows = [(*k, float(v)) for k, values in some.items() for v in values] + [("x", 1, None), ("x", 1, float("nan")), ("z", 1, None)]
    df, shares = spark.createDataFrame(rows, "a string, b long, value double"), {"least": 0.0, "q3": 0.3, "half": 0.5, "most": 1.0}
    for step in (1e-3, 1.0, 1e9):
        got = {(x.a, x.b): [x[n] for n in shares] for x in exact_quantiles(df, ["a", "b"], F.col("value"), shares, step).collect()}
        assert got.keys() == some.keys()
        for k, values in some.items():
            want = np.quantile(values, [*shares.values()]) if k != (None, 1) else [-2.0, -1.55, -1.5 + (1e300 + 1.5) * 0.5, float("inf")]
            assert np.allclose(got[k], want, rtol=1e-12, atol=0), (k, step)
