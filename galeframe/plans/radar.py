"""Queries on gates, voxels and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.operators import cores as C
from galeframe.operators import detect as D
from galeframe.operators import grid as G
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.registry import query

_R = "(4e0 / 3e0 * 6371000e0)"
LOCATED = with_views("gate") + (
    f", h AS (SELECT *, sqrt(range_m * range_m + {_R} * {_R} + 2e0 * range_m * {_R} * sin(radians(el_deg))) - {_R} AS z FROM gate)"
    f", s AS (SELECT *, {_R} * asin(range_m * cos(radians(el_deg)) / ({_R} + z)) AS s FROM h)"
    ", xy AS (SELECT *, s * sin(radians(az_deg)) AS x, s * cos(radians(az_deg)) AS y FROM s)"
    ", located AS (SELECT *, floor(z / 500e0)::BIGINT AS iz, floor((y + 150000e0) / 1000e0)::BIGINT AS iy, floor((x + 150000e0) / 1000e0)::BIGINT AS ix FROM xy WHERE abs(x) < 150000e0 AND abs(y) < 150000e0 AND z >= 0 AND z < 15000e0)"
)
VOXEL = LOCATED + ", voxel AS (SELECT site, vol, iz, iy, ix, max(dbz) AS dbz_max, count(*) AS n_gates, 10e0 * log10(avg(pow(10e0, dbz / 10e0))) AS dbz_cal FROM located GROUP BY ALL)"
LAYERS = VOXEL + (
    ", e AS (SELECT site, vol, iy, ix, iz, dbz_max AS v, lead(iz) OVER w AS iz2, lead(dbz_max) OVER w AS v2 FROM voxel WINDOW w AS (PARTITION BY site, vol, iy, ix ORDER BY iz))"
    ", g AS (SELECT *, unnest(range(iz + 1, iz2)) AS k FROM e WHERE iz2 - iz > 1)"
    ", layer AS (SELECT site, vol, iy, ix, iz, v, false AS filled FROM e UNION ALL SELECT site, vol, iy, ix, k, v + (v2 - v) * (k - iz) / (iz2 - iz), true FROM g)"
)
COLUMNS = LAYERS + ", col AS (SELECT site, vol, iy, ix, max(v) AS colmax, max(iz) FILTER (WHERE v >= 18.3e0) * 500e0 / 1000e0 AS etop_km, min(iz) FILTER (WHERE v >= 18.3e0) * 500e0 / 1000e0 AS ebase_km, count(*) FILTER (WHERE v >= 40) AS nlev_seed FROM layer GROUP BY ALL)"


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.grid_volumes(view(spark, sf_dir, "gate"))


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.column_products(G.fill_gaps(voxels(spark, sf_dir), "dbz_max"))


@query(VOXEL + " SELECT site, vol, iz, iy, ix, dbz_max, n_gates, round(dbz_cal, 6) AS dbz_cal FROM voxel")
def polar_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels(spark, sf_dir).withColumn("dbz_cal", F.round("dbz_cal", 6))


@query(LOCATED + " SELECT site, vol, count(*) AS gates FROM located GROUP BY ALL")
def gates_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.located(view(spark, sf_dir, "gate")).groupBy("site", "vol").agg(F.count("*").alias("gates"))


@query(LAYERS + " SELECT site, vol, iy, ix, iz, round(v, 6) AS v, filled FROM layer")
def grid_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.fill_gaps(voxels(spark, sf_dir), "dbz_max").select("site", "vol", "iy", "ix", "iz", F.round("v", 6).alias("v"), "filled")


@query(COLUMNS + " SELECT site, vol, iy, ix, round(colmax, 6) AS colmax, round(etop_km, 6) AS etop_km, round(ebase_km, 6) AS ebase_km, nlev_seed FROM col")
def column_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("colmax", "etop_km", "ebase_km")})


@query(VOXEL + " SELECT site, vol, iy, ix, max(dbz_max) AS colmax FROM voxel GROUP BY ALL")
def composite_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels(spark, sf_dir).groupBy("site", "vol", "iy", "ix").agg(F.max("dbz_max").alias("colmax"))


_D = "(dbz_max - dbz_cal) FILTER (WHERE n_gates > 1)"


@query(VOXEL + f" SELECT site, count(*) AS n_voxels, round(100e0 * avg(CASE WHEN n_gates > 1 THEN 1e0 ELSE 0e0 END), 6) AS multi_pct, round(avg{_D}, 6) AS mean_db, round(quantile_cont(dbz_max - dbz_cal, 0.5) FILTER (WHERE n_gates > 1), 6) AS median_db, round(quantile_cont(dbz_max - dbz_cal, 0.95) FILTER (WHERE n_gates > 1), 6) AS p95_db, round(max{_D}, 6) AS max_db, round(avg(dbz_max - dbz_cal) FILTER (WHERE n_gates > 1 AND dbz_max >= 40), 6) AS mean_db_40 FROM voxel GROUP BY site")
def bin_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("multi_pct", "mean_db", "median_db", "p95_db", "max_db", "mean_db_40")
    return G.bin_bias(voxels(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in names})


@query(COLUMNS + " SELECT site, vol, count(*) FILTER (WHERE colmax >= 40) AS seed, count(*) FILTER (WHERE colmax >= 30) AS base, count(*) FILTER (WHERE colmax >= 18.3e0) AS echo FROM col GROUP BY ALL")
def threshold_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda t, name: F.count(F.when(F.col("colmax") >= t, 1)).alias(name)
    return columns(spark, sf_dir).groupBy("site", "vol").agg(n(40, "seed"), n(30, "base"), n(18.3, "echo"))


#: Blocks of 20 by 20 columns stand for objects where labels aren't under test.
_BLOCKS = COLUMNS + ", obj AS (SELECT site, vol, (iy // 20) * 100 + ix // 20 AS obj, count(*)::DOUBLE AS area_km2, max(colmax) AS max_dbz, max(etop_km) AS etop_km, min(ebase_km) AS ebase_km, max(nlev_seed) AS n_levels, sum(greatest(colmax, 0) * ix) / sum(greatest(colmax, 0)) AS cx, sum(greatest(colmax, 0) * iy) / sum(greatest(colmax, 0)) AS cy FROM col GROUP BY ALL)"


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = columns(spark, sf_dir).withColumn("obj", F.floor(F.col("iy") / 20) * 100 + F.floor(F.col("ix") / 20))
    return D.object_statistics(c)


@query(_BLOCKS + " SELECT site, vol, obj, area_km2, round(max_dbz, 6) AS max_dbz, etop_km, ebase_km, n_levels, round(cx, 6) AS cx, round(cy, 6) AS cy, etop_km - ebase_km + 0.5e0 AS depth_km FROM obj WHERE etop_km IS NOT NULL")
def object_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("max_dbz", "cx", "cy")})


@query(_BLOCKS + " SELECT site, vol, obj FROM obj WHERE n_levels >= 3 AND etop_km >= 3 AND area_km2 >= 4")
def admission_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.admitted(blocks(spark, sf_dir)).select("site", "vol", "obj")


@query(_BLOCKS + " SELECT site, vol, obj, row_number() OVER (PARTITION BY site, vol ORDER BY round(max_dbz, 6) DESC, area_km2 DESC, cx, cy, obj) AS cell_id FROM obj WHERE etop_km IS NOT NULL")
def strength_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.numbered(blocks(spark, sf_dir).withColumn("max_dbz", F.round("max_dbz", 6)))


_OVERLAP = COLUMNS + ", p AS (SELECT site, vol, (iy // 10) * 100 + ix // 10 AS seed, (iy // 15) * 100 + ix // 15 AS base FROM col WHERE colmax >= 40), n AS (SELECT site, vol, seed, base, count(*) AS n FROM p GROUP BY ALL) SELECT site, vol, seed, base, n FROM (SELECT *, row_number() OVER (PARTITION BY site, vol, seed ORDER BY n DESC, base) AS r FROM n) WHERE r = 1"


@query(_OVERLAP)
def seed_base_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = columns(spark, sf_dir).filter("colmax >= 40")
    block = lambda k: (F.floor(F.col("iy") / k) * 100 + F.floor(F.col("ix") / k))
    return D.majority_parent(c.select("site", "vol", block(10).alias("seed"), block(15).alias("base")))


_SPREAD = COLUMNS.replace("WITH", "WITH RECURSIVE", 1) + (
    ", m AS (SELECT site, vol, iy, ix FROM col WHERE colmax >= 40)"
    ", spread AS (SELECT *, iy * 1000 + ix AS root FROM m UNION SELECT m.*, s.root FROM (SELECT site, vol, iy + dy AS iy, ix + dx AS ix, root FROM spread, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) t(dy, dx)) s JOIN m ON m.site = s.site AND m.vol = s.vol AND m.iy = s.iy AND m.ix = s.ix AND s.root < m.iy * 1000 + m.ix)"
    ", owned AS (SELECT site, vol, iy, ix, min(root) AS root FROM spread GROUP BY ALL)"
)


@query(_SPREAD + " SELECT site, vol, dense_rank() OVER (PARTITION BY site, vol ORDER BY root) AS label, count(*) AS n, min(iy) AS iy0, min(ix) AS ix0 FROM owned GROUP BY site, vol, root")
def components_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of 4-connected components of the 40 dBZ mask."""
    mask = columns(spark, sf_dir).filter("colmax >= 40").select("site", "vol", "iy", "ix")
    return D.label_columns(mask).groupBy("site", "vol", "label").agg(F.count("*").alias("n"), F.min("iy").alias("iy0"), F.min("ix").alias("ix0"))


_GREEDY = _BLOCKS.replace("WITH", "WITH RECURSIVE", 1) + (
    ", o AS (SELECT site, vol, obj, cx, cy, row_number() OVER (PARTITION BY site, vol ORDER BY max_dbz DESC, area_km2 DESC, cx, cy, obj) AS r FROM obj WHERE etop_km IS NOT NULL)"
    ", greedy AS (SELECT site, vol, r, [{'obj': obj, 'x': cx, 'y': cy}] AS kept FROM o WHERE r = 1 UNION ALL SELECT o.site, o.vol, o.r, CASE WHEN len(list_filter(kept, lambda k: sqrt((k.x - cx) ** 2 + (k.y - cy) ** 2) < 6)) > 0 THEN kept ELSE list_append(kept, {'obj': obj, 'x': cx, 'y': cy}) END FROM greedy g JOIN o ON o.site = g.site AND o.vol = g.vol AND o.r = g.r + 1)"
    ", k AS (SELECT site, vol, unnest(arg_max(kept, r)) AS k FROM greedy GROUP BY site, vol)"
)


@query(_GREEDY + " SELECT site, vol, k.obj AS obj FROM k")
def nms_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects left by greedy suppression of weaker ones within 6 km."""
    return D.suppressed(blocks(spark, sf_dir).withColumns({"x_km": F.col("cx"), "y_km": F.col("cy")}), 6.0).select("site", "vol", "obj")


#: Voxels of 8 by 8 columns and 3 layers, so that components have several.
_SEEDS = VOXEL.replace("WITH", "WITH RECURSIVE", 1) + (
    ", seed AS MATERIALIZED (SELECT site, vol, iz // 3 AS iz, iy // 8 AS iy, ix // 8 AS ix, max(dbz_max + (ix * 7 + iy * 3) % 11) AS v FROM voxel WHERE dbz_max >= 40 GROUP BY ALL)"
    ", reach AS (SELECT site, vol, iz, iy, ix, (iz * 100 + iy) * 100 + ix AS root FROM seed UNION SELECT m.site, m.vol, m.iz, m.iy, m.ix, r.root FROM (SELECT site, vol, iz + dz AS iz, iy + dy AS iy, ix + dx AS ix, root FROM reach, (VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) t(dz, dy, dx)) r JOIN seed m USING (site, vol, iz, iy, ix) WHERE r.root < (m.iz * 100 + m.iy) * 100 + m.ix)"
    ", comp AS MATERIALIZED (SELECT *, dense_rank() OVER (PARTITION BY site, vol ORDER BY root) AS label FROM (SELECT site, vol, iz, iy, ix, min(root) AS root FROM reach GROUP BY ALL) JOIN seed USING (site, vol, iz, iy, ix))"
)


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = voxels(spark, sf_dir).filter("dbz_max >= 40").withColumn("v", F.col("dbz_max") + (F.col("ix") * 7 + F.col("iy") * 3) % 11)
    coarse = v.select("site", "vol", *(F.floor(F.col(c) / k).alias(c) for c, k in (("iz", 3), ("iy", 8), ("ix", 8))), "v")
    return C.seed_components(coarse)


@query(_SEEDS + " SELECT site, vol, label AS obj, count(DISTINCT iz) AS n_levels FROM comp GROUP BY ALL")
def component_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of each component of seed voxels that touch by a face."""
    return D.component_levels(seeds(spark, sf_dir).withColumnRenamed("label", "obj"))


@query(_SEEDS + " SELECT site, vol, label, iz, iy, ix, v FROM comp p WHERE NOT EXISTS (SELECT 1 FROM comp q WHERE q.site = p.site AND q.vol = p.vol AND q.label = p.label AND q.v > p.v AND greatest(abs(q.iz - p.iz), abs(q.iy - p.iy), abs(q.ix - p.ix)) <= 2)")
def peak_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.peak_candidates(seeds(spark, sf_dir), 2)


@query()
def storm_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cores of seed voxels, parted in the saddles; tests hold them against one flood of each whole volume."""
    return C.core_statistics(C.storm_cores(seeds(spark, sf_dir), 2))


@query()
def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multi-threshold detector with its gates, over columns smoothed to blocks of 4 km so that objects have a size."""
    c = columns(spark, sf_dir).withColumns({"iy": F.floor(F.col("iy") / 4), "ix": F.floor(F.col("ix") / 4)})
    coarse = c.groupBy("site", "vol", "iy", "ix").agg(F.max("colmax").alias("colmax"), F.max("etop_km").alias("etop_km"), F.min("ebase_km").alias("ebase_km"), F.max("nlev_seed").alias("nlev_seed"))
    return D.detect(coarse, D.LadderParams(n_min=5, cell_km=4.0))
