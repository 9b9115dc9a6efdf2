"""Queries on imagery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.operators import envelope as E
from galeframe.operators import raster as R
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.radar import detections
from galeframe.plans.registry import query

_GRID = "WITH g AS (SELECT s_suppkey AS k, 23.5e0 + (s_suppkey * 37 % 265) / 10e0 AS lat, -125.5e0 + (s_suppkey * 101 % 590) / 10e0 AS lon FROM supplier)"
_E2 = f"(({R.R_EQ}e0 * {R.R_EQ}e0 - {R.R_POL}e0 * {R.R_POL}e0) / ({R.R_EQ}e0 * {R.R_EQ}e0))"
_NAV = _GRID + (
    f", a AS (SELECT *, atan(pow({R.R_POL}e0 / {R.R_EQ}e0, 2) * tan(radians(lat))) AS phi, radians(lon) - radians({R.LON0}e0) AS d FROM g)"
    f", b AS (SELECT *, {R.R_POL}e0 / sqrt(1e0 - {_E2} * cos(phi) * cos(phi)) AS rc FROM a)"
    f", c AS (SELECT *, {R.H_M}e0 - rc * cos(phi) * cos(d) AS sx, -rc * cos(phi) * sin(d) AS sy, rc * sin(phi) AS sz FROM b)"
    f", i AS (SELECT *, {R.H_M}e0 * ({R.H_M}e0 - sx) >= sy * sy + pow({R.R_EQ}e0 / {R.R_POL}e0, 2) * sz * sz AS visible, ({R.FIRST_RAD:f}e0 - atan(sz / sx)) / {R.STEP_RAD:f}e0 AS r, (asin(-sy / sqrt(sx * sx + sy * sy + sz * sz)) + {R.FIRST_RAD:f}e0) / {R.STEP_RAD:f}e0 AS q FROM c)"
)


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return s.selectExpr("s_suppkey AS k", "23.5e0 + (s_suppkey * 37 % 265) / 10e0 AS lat", "-125.5e0 + (s_suppkey * 101 % 590) / 10e0 AS lon")


@query(_NAV + f" SELECT k, least(greatest(round_even(r, 0), 0), {R.SIZE - 1})::BIGINT AS row_no, least(greatest(round_even(q, 0), 0), {R.SIZE - 1})::BIGINT AS col_no, visible FROM i")
def abi_reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    row, col, visible = R.scan_position(F.col("lat"), F.col("lon"))
    return _grid(spark, sf_dir).select("k", row.alias("row_no"), col.alias("col_no"), visible.alias("visible"))


@query("WITH t AS (SELECT ln(tan(0.7853981633974483e0 + radians(50e0) / 2e0)) AS a, ln(tan(0.7853981633974483e0 + radians(23.5e0) / 2e0)) AS b) SELECT s_suppkey AS k, round(degrees(2e0 * atan(exp(a + (s_suppkey % 1000) * (b - a) / 999e0)) - pi() / 2e0), 9) AS lat FROM supplier, t")
def mercator_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return s.select(F.col("s_suppkey").alias("k"), F.round(R.mercator_latitude(F.col("s_suppkey") % 1000, 1000, 23.5, 50.0), 9).alias("lat"))


_K = "340.349e0 + (89.62e0 - 340.349e0) * level / 255e0"


@query(with_views("pixel") + f" SELECT level, count(*) AS n, round({_K}, 9) AS kelvin FROM pixel GROUP BY level")
def count_to_kelvin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "pixel").groupBy("level").agg(F.count("*").alias("n")).withColumn("kelvin", F.round(R.kelvin(F.col("level")), 9))


def _lut(k: int) -> str:
    cases = " ".join(f"WHEN c >= {b[0]} THEN floor({a[k]} + ({b[k]} - {a[k]}) * ({a[0]} - c) / {float(a[0] - b[0])}e0)" for a, b in zip(R.ANCHORS[:-1], R.ANCHORS[1:], strict=True))
    return f"(CASE WHEN c >= -30 THEN floor(40e0 + (40e0 - greatest(least(c, 40e0), -30e0)) / 70e0 * 215e0) {cases} ELSE {R.ANCHORS[-1][k]} END)::BIGINT"


@query(with_views("pixel") + f", t AS (SELECT DISTINCT level, {_K} - 273.15e0 AS c FROM pixel) SELECT level, {_lut(1)} AS r, {_lut(2)} AS g, {_lut(3)} AS b FROM t")
def enhance_lut(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, g, b = R.enhanced(R.kelvin(F.col("level")) - 273.15e0)
    return view(spark, sf_dir, "pixel").select("level").distinct().select("level", r.alias("r"), g.alias("g"), b.alias("b"))


@query("WITH f AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN concat('frame_', o_orderkey, '.png') ELSE concat('frame_', strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey * 30 AS BIGINT)), '%Y%m%dT%H%M%SZ'), '.png') END AS path FROM orders) SELECT path FROM f WHERE path LIKE '%Z.png' ORDER BY path DESC LIMIT 18")
def frame_last18(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    stamp = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("o_orderkey") * 1800), "yyyyMMdd'T'HHmmss'Z'")
    path = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("frame_"), F.col("o_orderkey").cast("string"), F.lit(".png"))).otherwise(F.concat(F.lit("frame_"), stamp, F.lit(".png")))
    return R.last_frames(o.select(path.alias("path"))).select("path")


_PX = with_views("pixel") + ", px AS (SELECT frame, row_no, col_no, max(level) AS level FROM pixel GROUP BY ALL)"


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "pixel").groupBy("frame", "row_no", "col_no").agg(F.max("level").alias("level"))


@query(_PX + ", m AS (SELECT i // 40 AS out_row, i % 40 AS out_col, (i // 40) * 2 AS row_no, (i % 40) * 2 AS col_no FROM (SELECT unnest(range(0, 1600)) AS i)) SELECT f.frame, out_row, out_col, coalesce(level, 0)::BIGINT AS level FROM (SELECT DISTINCT frame FROM px) f CROSS JOIN m LEFT JOIN px ON px.frame = f.frame AND px.row_no = m.row_no AND px.col_no = m.col_no")
def raster_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    mapping = spark.range(1600).select(F.floor(i / 40).alias("out_row"), (i % 40).alias("out_col"), (F.floor(i / 40) * 2).alias("row_no"), (i % 40 * 2).alias("col_no"))
    return R.gathered(_pixels(spark, sf_dir), mapping)


@query(_PX + f", k AS (SELECT frame, {_K} AS k FROM px), p AS (SELECT frame, quantile_cont(k, 0.01) AS cold_k, quantile_cont(k, 0.95) AS warm_k, avg(k) AS mean_k, count(*) AS n FROM k GROUP BY frame), c AS (SELECT k.frame, 100e0 * avg(CASE WHEN k < warm_k - 8 THEN 1e0 ELSE 0e0 END) AS cloud_pct, count(*) FILTER (WHERE k - 273.15e0 <= -50) AS deep FROM k JOIN p ON p.frame = k.frame GROUP BY k.frame), w AS (SELECT p.*, c.cloud_pct, c.deep, lag(cold_k) OVER (ORDER BY p.frame) - cold_k AS cooling FROM p JOIN c USING (frame)) SELECT frame, round(cold_k, 6) AS cold_k, round(warm_k, 6) AS warm_k, round(mean_k, 6) AS mean_k, n, round(cloud_pct, 6) AS cloud_pct, deep, round(cooling, 6) AS cooling, coalesce(cooling >= 4, false) AS initiation FROM w")
def cloud_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cloud_products(_pixels(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("cold_k", "warm_k", "mean_k", "cloud_pct", "cooling")})


_BANDS = with_views("pixel") + f", b AS (SELECT frame, row_no, col_no, avg({_K}) FILTER (WHERE band = 13) AS a, avg({_K}) FILTER (WHERE band = 7) AS b, avg({_K}) FILTER (WHERE band = 10) AS c FROM (SELECT * REPLACE (frame // 3 AS frame, row_no // 8 AS row_no, col_no // 8 AS col_no) FROM pixel) GROUP BY ALL)"


@query(_BANDS + " SELECT frame, round(avg(a - b), 6) AS fog_btd, round(avg(a - c), 6) AS other FROM b GROUP BY frame")
def band_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of bands over pixels of an eighth of the size, which most bands share."""
    p = view(spark, sf_dir, "pixel").withColumns({"frame": F.floor(F.col("frame") / 3), "row_no": F.floor(F.col("row_no") / 8), "col_no": F.floor(F.col("col_no") / 8)})
    out = R.band_differences(p, {"fog_btd": (13, 7), "other": (13, 10)})
    return out.select("frame", *(F.round(c, 6).alias(c) for c in ("fog_btd", "other")))


@query()
def envelope_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well footprints and hulls fit the detected masks; tests hold the shapes' exact values."""
    found = detections(spark, sf_dir)
    parts = [E.envelope_summary(E.envelopes(found, m)).withColumn("method", F.lit(m)) for m in ("footprint", "concave", "convex")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
