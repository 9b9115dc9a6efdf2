"""Queries on tracked objects, families and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.operators import tracks as T
from galeframe.operators import verification as V
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.registry import query


def collapsed_sql(identity: str = "track_id") -> str:
    return with_views("obs") + f", c AS (SELECT site, {identity} AS id, vol, sum(greatest(area, 1e-9) * seed_x) / sum(greatest(area, 1e-9)) AS x, sum(greatest(area, 1e-9) * seed_y) / sum(greatest(area, 1e-9)) AS y, sum(area) AS area, max(dbz) AS dbz, max(top) AS top, count(*) AS n_cells FROM obs WHERE {identity} >= 0 GROUP BY ALL)"


_C = collapsed_sql()
_STEP = _C + ", s0 AS (SELECT site, id, vol, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, (vol - lag(vol) OVER w) * 300 AS dt FROM c WINDOW w AS (PARTITION BY site, id ORDER BY vol)), s AS (SELECT *, sqrt(dx * dx + dy * dy) / dt AS speed FROM s0 WHERE dt > 0)"


def samples(spark: SparkSession, sf_dir: str, identity: str = "track_id") -> DataFrame:
    return T.collapsed(view(spark, sf_dir, "obs"), identity)


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query(_C + " SELECT site, id, vol, round(x, 6) AS x, round(y, 6) AS y, round(area, 6) AS area, dbz, top, n_cells FROM c")
def track_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(samples(spark, sf_dir), "x", "y", "area")


@query(_STEP + " SELECT site, count(*) AS n, round(avg(speed), 6) AS mean_ms, round(quantile_cont(round(speed / 0.001e0)::BIGINT, 0.95) * 0.001e0, 6) AS p95_ms, count(*) FILTER (WHERE speed > 45) AS impossible FROM s GROUP BY site")
def track_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.speed_summary(T.steps(samples(spark, sf_dir))), "mean_ms", "p95_ms")


def _slope(v: str, w: str) -> str:
    t = "(vol * 5)"
    return f"((count(*) OVER {w}) * sum({t} * {v}) OVER {w} - sum({t}) OVER {w} * sum({v}) OVER {w}) / nullif(((count(*) OVER {w}) * sum({t} * {t}) OVER {w} - sum({t}) OVER {w} * sum({t}) OVER {w})::DOUBLE, 0)"


_TREND = ", ".join(f"round(CASE WHEN count(*) OVER r >= 2 THEN {_slope(v, 'r')} ELSE {_slope(v, 'b')} END, 6) AS {v}_trend" for v in ("area", "dbz", "top"))


@query(_C + f" SELECT site, id, vol, {_TREND} FROM c WINDOW r AS (PARTITION BY site, id ORDER BY vol RANGE BETWEEN 6 PRECEDING AND CURRENT ROW), b AS (PARTITION BY site, id ORDER BY vol ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)")
def track_trend30(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = T.trends(samples(spark, sf_dir)).select("site", "id", "vol", "area_trend", "dbz_trend", "top_trend")
    return rounded(out, "area_trend", "dbz_trend", "top_trend")


@query(_C + ", p AS (SELECT site, id, (max(vol) - min(vol)) * 5 AS m, count(*) AS n FROM c GROUP BY site, id) SELECT site, count(*) AS tracks, round(avg(m), 6) AS mean_min, median(m)::DOUBLE AS median_min, max(m) AS max_min, round(avg(n), 6) AS vols_mean, round(avg(CASE WHEN n >= 3 THEN 1e0 ELSE 0e0 END), 6) AS frac_ge3, round(avg(CASE WHEN n = 1 THEN 1e0 ELSE 0e0 END), 6) AS frac_singleton FROM p GROUP BY site")
def track_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.durations(samples(spark, sf_dir)), "mean_min", "vols_mean", "frac_ge3", "frac_singleton")


def _rms(v: str) -> str:
    return f"sqrt(greatest(var_pop({v}) - covar_pop(vol * 5, {v}) * covar_pop(vol * 5, {v}) / var_pop(vol * 5), 0))"


@query(_C + f", p AS (SELECT site, id, count(*) AS n, (max(vol) - min(vol)) * 5 AS m, {_rms('x / 1000e0')} AS rx, {_rms('y / 1000e0')} AS ry, {_rms('area')} AS ra, avg(area) AS ma, {_rms('dbz')} AS rd FROM c GROUP BY site, id) SELECT site, count(*) AS n_fit, round(sum(sqrt(rx * rx + ry * ry) * m) / sum(m), 6) AS pos_rms_km, round(sum(ra / ma * m) / sum(m), 6) AS area_rms_frac, round(sum(rd * m) / sum(m), 6) AS dbz_rms FROM p WHERE n >= 3 AND m > 0 GROUP BY site")
def track_linearity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.linearity(samples(spark, sf_dir)), "pos_rms_km", "area_rms_frac", "dbz_rms")


@query(_C + ", p AS (SELECT site, id, max(vol) - min(vol) AS d, min(vol) AS a, max(vol) AS b FROM c GROUP BY site, id) SELECT site, round(count(*) / greatest((max(b) - min(a)) * 5 / 60e0, 1e-6), 6) AS new_ids_per_hour, round(count(*) / greatest(sum(d) * 5 / 60e0, 1e-6), 6) AS ids_per_storm_hour FROM p GROUP BY site")
def fragmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.fragmentation(samples(spark, sf_dir)), "new_ids_per_hour", "ids_per_storm_hour")


#: Volumes at uneven times: every score by the clock, compared with SQL's own regressions.
_CT = with_views("obs") + ", o AS (SELECT *, vol * 300 + (vol * vol * 37) % 120 AS t FROM obs), c AS (SELECT site, track_id AS id, t, sum(greatest(area, 1e-9) * seed_x) / sum(greatest(area, 1e-9)) AS x, sum(greatest(area, 1e-9) * seed_y) / sum(greatest(area, 1e-9)) AS y, sum(area) AS area, max(dbz) AS dbz, max(vol) AS vol FROM o WHERE track_id >= 0 GROUP BY ALL), s0 AS (SELECT site, id, vol, t, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, t - lag(t) OVER w AS dt FROM c WINDOW w AS (PARTITION BY site, id ORDER BY t)), s AS (SELECT *, sqrt(dx * dx + dy * dy) / dt AS speed FROM s0 WHERE dt > 0)"


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("vol") * 300 + (F.col("vol") * F.col("vol") * 37) % 120
    return T.collapsed(view(spark, sf_dir, "obs").withColumn("t", at), "track_id")


@query(_CT + " SELECT site, count(*) AS n, round(avg(speed), 6) AS mean_ms, round(quantile_cont(round(speed / 0.001e0)::BIGINT, 0.95) * 0.001e0, 6) AS p95_ms, count(*) FILTER (WHERE speed > 45) AS impossible FROM s GROUP BY site")
def timed_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.speed_summary(T.steps(timed(spark, sf_dir))), "mean_ms", "p95_ms")


@query(_CT + ", m AS (SELECT *, (t - min(t) OVER (PARTITION BY site, id)) / 60e0 AS m FROM c) SELECT site, id, vol, round(1e-8 + CASE WHEN count(*) OVER r >= 2 THEN regr_slope(area, m) OVER r ELSE regr_slope(area, m) OVER b END, 5) AS area_trend, round(1e-8 + CASE WHEN count(*) OVER r >= 2 THEN regr_slope(dbz, m) OVER r ELSE regr_slope(dbz, m) OVER b END, 5) AS dbz_trend FROM m WINDOW r AS (PARTITION BY site, id ORDER BY m RANGE BETWEEN 30 PRECEDING AND CURRENT ROW), b AS (PARTITION BY site, id ORDER BY m ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)")
def timed_trend30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A little is added before rounding: many slopes end on a 5 that either engine could round its way."""
    out = T.trends(timed(spark, sf_dir), ("area", "dbz"))
    return out.select("site", "id", "vol", *(F.round(1e-8 + F.col(f"{c}_trend"), 5).alias(f"{c}_trend") for c in ("area", "dbz")))


@query(_CT + ", p AS (SELECT site, id, (max(t) - min(t)) / 60e0 AS m, min(t) AS t0, max(t) AS t1, count(*) AS n FROM c GROUP BY site, id) SELECT site, count(*) AS tracks, round(avg(m), 6) AS mean_min, round(median(m), 6) AS median_min, round(max(m), 6) AS max_min, round(count(*) / greatest((max(t1) - min(t0)) / 3600e0, 1e-6), 6) AS new_ids_per_hour, round(count(*) / greatest(sum(m) / 60e0, 1e-6), 6) AS ids_per_storm_hour FROM p GROUP BY site")
def timed_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = timed(spark, sf_dir)
    d = T.durations(s).select("site", "tracks", "mean_min", "median_min", "max_min")
    return rounded(d.join(T.fragmentation(s), "site"), "mean_min", "median_min", "max_min", "new_ids_per_hour", "ids_per_storm_hour")


@query(_CT + ", p AS (SELECT site, id, count(*) AS n, (max(t) - min(t)) / 60e0 AS m, sqrt(var_pop(x / 1000e0) * (1 - regr_r2(x, t)) + var_pop(y / 1000e0) * (1 - regr_r2(y, t))) AS r, sqrt(greatest(var_pop(area) * (1 - regr_r2(area, t)), 0)) AS ra, avg(area) AS ma FROM c GROUP BY site, id HAVING count(*) >= 3) SELECT site, count(*) AS n_fit, round(sum(r * m) / sum(m), 5) AS pos_rms_km, round(sum(ra / ma * m) / sum(m), 5) AS area_rms_frac FROM p GROUP BY site")
def timed_linearity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.linearity(timed(spark, sf_dir)).select("site", "n_fit", "pos_rms_km", "area_rms_frac"), "pos_rms_km", "area_rms_frac", places=5)


@query(_CT + " SELECT site, id, vol, round(sum(dx) OVER w / sum(dt) OVER w, 6) AS u_ms, round(sum(dy) OVER w / sum(dt) OVER w, 6) AS v_ms FROM s WHERE speed <= 45 WINDOW w AS (PARTITION BY site, id ORDER BY t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def timed_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.motion(T.steps(timed(spark, sf_dir))), "u_ms", "v_ms")


#: Lives of a few volumes, so that births and deaths happen: the last observation of each id and volume.
_LIFE = with_views("obs") + (
    ", q AS (SELECT site, track_id * 1000 + vol // 12 AS id, vol, seed_x AS x, seed_y AS y, area, split_from, row_number() OVER (PARTITION BY site, track_id, vol ORDER BY obs_id DESC) AS r FROM obs)"
    ", s0 AS (SELECT * FROM q WHERE r = 1)"
    ", s AS (SELECT *, min(vol) OVER (PARTITION BY site, id) AS born, max(vol) OVER (PARTITION BY site, id) AS died, lag(vol) OVER w AS bef, lead(vol) OVER w AS aft, sqrt(greatest(area, 0) / pi()) AS rad, min(vol) OVER (PARTITION BY site) AS v0, max(vol) OVER (PARTITION BY site) AS v1 FROM s0 WINDOW w AS (PARTITION BY site, id ORDER BY vol))"
    ", births AS (SELECT * FROM s WHERE vol = born AND vol > v0), deaths AS (SELECT * FROM s WHERE vol = died AND vol < v1)"
    ", sp AS (SELECT DISTINCT b.site, b.id, b.split_from FROM births b JOIN s p ON b.site = p.site AND p.aft = p.vol + 1 AND p.vol + 1 = b.vol AND sqrt(pow(b.x - p.x, 2) + pow(b.y - p.y, 2)) / 1000e0 <= least(20e0, b.rad + p.rad))"
    ", si AS (SELECT DISTINCT d.site, d.id FROM deaths d JOIN s p ON d.site = p.site AND p.bef = p.vol - 1 AND p.vol - 1 = d.vol AND sqrt(pow(d.x - p.x, 2) + pow(d.y - p.y, 2)) / 1000e0 <= 20)"
    " SELECT site, (SELECT count(*) FROM births b WHERE b.site = k.site) AS births, (SELECT count(*) FROM sp WHERE split_from IS NULL AND sp.site = k.site) AS orphan_births, (SELECT count(*) FROM sp WHERE split_from IS NOT NULL AND sp.site = k.site) AS recorded_splits"
    ", (SELECT count(*) FROM deaths d WHERE d.site = k.site) AS deaths, (SELECT count(*) FROM si WHERE si.site = k.site) AS silent_deaths"
    ", (SELECT CASE WHEN count(*) = 0 THEN 1e0 ELSE round(count(split_from)::DOUBLE / count(*), 9) END FROM sp WHERE sp.site = k.site) AS split_coverage FROM (SELECT DISTINCT site FROM s) k"
)


def lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "obs").withColumn("id", F.col("track_id") * 1000 + F.floor(F.col("vol") / 12))
    last = F.max_by(F.struct(F.col("seed_x").alias("x"), F.col("seed_y").alias("y"), "area", "split_from"), "obs_id").alias("s")
    return o.groupBy("site", "id", "vol").agg(last).select("site", "id", "vol", "s.*")


@query(_LIFE)
def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.lifecycle(lives(spark, sf_dir)).withColumn("split_coverage", F.round("split_coverage", 9))


@query(_STEP + " SELECT site, id, vol, round(sum(dx) OVER w / sum(dt) OVER w, 6) AS u_ms, round(sum(dy) OVER w / sum(dt) OVER w, 6) AS v_ms FROM s WHERE speed <= 45 WINDOW w AS (PARTITION BY site, id ORDER BY vol ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def motion_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.motion(T.steps(samples(spark, sf_dir))), "u_ms", "v_ms")


_FAMILY = with_views("obs") + ", f AS (SELECT site, vol, family_id, sum(area) AS area, max(dbz) AS dbz, max(top) AS top, list_sort(list(DISTINCT track_id)) AS ids FROM obs GROUP BY ALL)"


@query(_FAMILY + " SELECT site, vol, family_id, round(area, 6) AS area, dbz, top, array_to_string(ids, ',') AS track_ids FROM f")
def family_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = T.family_rollup(view(spark, sf_dir, "obs"))
    return rounded(out, "area").withColumn("track_ids", F.array_join(F.col("track_ids").cast("array<string>"), ","))


@query(_FAMILY + ", p AS (SELECT site, ids, lag(ids) OVER (PARTITION BY site, family_id ORDER BY vol) AS was FROM f) SELECT site, round(sum(len(list_filter(ids, lambda x: NOT list_contains(was, x))) + len(list_filter(was, lambda x: NOT list_contains(ids, x)))) / sum(len(list_distinct(list_concat(ids, was)))), 9) AS churn, count(*) AS n FROM p WHERE was IS NOT NULL GROUP BY site")
def family_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.churn(T.family_rollup(view(spark, sf_dir, "obs"))), "churn", places=9)


_VOTES = with_views("obs") + ", m AS (SELECT site, vol AS grp, CASE WHEN obs_id % 5 = 0 THEN NULL ELSE (track_id * 7 + vol) % 60 END AS uid, obs_id AS pos FROM obs), n AS (SELECT site, grp, uid, count(*) AS votes, min(pos) AS p FROM m WHERE uid IS NOT NULL GROUP BY ALL), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, grp ORDER BY votes DESC, p) AS r FROM n) WHERE r = 1), v AS (SELECT z.site, z.grp, z.size, b.uid, coalesce(b.votes, 0) AS votes FROM (SELECT site, grp, count(*) AS size FROM m GROUP BY site, grp) z LEFT JOIN b USING (site, grp))"


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    uid = F.when(F.col("obs_id") % 5 != 0, (F.col("track_id") * 7 + F.col("vol")) % 60)
    return view(spark, sf_dir, "obs").select("site", F.col("vol").alias("grp"), uid.alias("uid"), F.col("obs_id").alias("pos"))


@query(_VOTES + " SELECT site, grp, size, uid, votes FROM v")
def uid_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.votes(_members(spark, sf_dir))


@query(_VOTES + ", k AS (SELECT *, row_number() OVER (PARTITION BY site, uid ORDER BY votes DESC, size DESC, grp DESC) AS r FROM v) SELECT site, grp, CASE WHEN uid IS NOT NULL AND r = 1 THEN uid END AS kept, CASE WHEN uid IS NOT NULL AND r > 1 THEN uid END AS parent FROM k")
def uid_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.claims(T.votes(_members(spark, sf_dir)))


_MATCH = with_views("obs", "report") + ", r AS (SELECT * FROM report WHERE kind IN ('T', 'H', 'G', 'D')), p AS (SELECT o.site, o.vol, o.obs_id AS obj, r.report_id FROM obs o JOIN r ON o.site = r.site AND o.vol = r.vol AND sqrt(pow(o.seed_x - r.x, 2) + pow(o.seed_y - r.y, 2)) <= 15000)"


def _objects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return view(spark, sf_dir, "obs").withColumnRenamed("obs_id", "obj"), view(spark, sf_dir, "report").filter(F.col("kind").isin("T", "H", "G", "D"))


@query(_MATCH + " SELECT site, vol, obj, report_id FROM p")
def report_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.matched(*_objects(spark, sf_dir))


#: Envelopes: a diamond of 25 km about each object.
_INSIDE = with_views("obs", "report") + " SELECT o.site, o.vol, o.obs_id AS obj, r.report_id FROM obs o JOIN report r ON o.site = r.site AND o.vol = r.vol AND r.kind IN ('T', 'H', 'G', 'D') AND (sqrt(pow(o.seed_x - r.x, 2) + pow(o.seed_y - r.y, 2)) <= 15000 OR abs(o.seed_x - r.x) + abs(o.seed_y - r.y) < 25000.5)"


@query(_INSIDE)
def report_match_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, r = _objects(spark, sf_dir)
    x, y, d = F.col("seed_x"), F.col("seed_y"), F.lit(25000.5)
    rings = o.select("site", "obj", "vol", F.array(x + d, x, x - d, x).alias("xs"), F.array(y, y + d, y, y - d).alias("ys"))
    return V.matched_or_inside(o, r, rings)


@query(
    _MATCH + ", t AS (SELECT site, coalesce(objects, 0) AS objects, coalesce(reports, 0) AS reports, coalesce(detected, 0) AS detected, coalesce(hits, 0) AS hits FROM (SELECT site, count(*) AS objects FROM obs GROUP BY site) FULL JOIN (SELECT site, count(*) AS reports FROM r GROUP BY site) USING (site)"
    " LEFT JOIN (SELECT site, count(DISTINCT report_id) AS detected, count(DISTINCT obj) AS hits FROM p GROUP BY site) USING (site))"
    " SELECT *, objects - hits AS false_alarms, coalesce(round(detected / nullif(reports, 0)::DOUBLE, 9), 0) AS pod, coalesce(round((objects - hits) / nullif(objects, 0)::DOUBLE, 9), 0) AS far, coalesce(round(detected / nullif(reports + objects - hits, 0)::DOUBLE, 9), 0) AS csi FROM t"
)
def contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, r = _objects(spark, sf_dir)
    return rounded(V.contingency(o, r, V.matched(o, r)), "pod", "far", "csi", places=9)


_TIMES = "WITH v AS (SELECT o_orderkey AS v, o_orderkey % 7 AS site, TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey * 7 AS BIGINT)) AS vt FROM orders), r AS (SELECT o_orderkey AS r, o_custkey % 7 AS site, TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey * 11 AS BIGINT)) AS rt FROM orders)"


def _times(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    at = lambda k: F.timestamp_seconds(F.lit(1704067200) + F.col("o_orderkey") * (60 * k))
    return o.select(F.col("o_orderkey").alias("v"), (F.col("o_orderkey") % 7).alias("site"), at(7).alias("vt")), o.select(F.col("o_orderkey").alias("r"), (F.col("o_custkey") % 7).alias("site"), at(11).alias("rt"))


@query(_TIMES + " SELECT v, r FROM v JOIN r ON abs(epoch(vt) - epoch(rt)) <= 900")
def volume_report_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of all sites."""
    return V.within_minutes(*_times(spark, sf_dir)).select("v", "r")


_CASES = _TIMES + ", c AS (SELECT v % 25 AS case_key, vt AS vol_time FROM v), m AS (SELECT case_key, TIMESTAMP '2024-01-01' + to_minutes(CAST(case_key * 900 + 1000 AS BIGINT)) AS mid FROM (SELECT DISTINCT case_key FROM c)), n AS (SELECT c.*, row_number() OVER (PARTITION BY c.case_key ORDER BY vol_time) AS rn, count(*) OVER (PARTITION BY c.case_key) AS k, abs(epoch(vol_time) - epoch(mid)) AS gap FROM c JOIN m ON m.case_key = c.case_key), a AS (SELECT *, first_value(rn) OVER (PARTITION BY case_key ORDER BY gap, rn) AS f FROM n)"


@query(_CASES + " SELECT case_key, rn FROM a WHERE rn >= greatest(1, least(f - 6, k - 11)) AND rn < greatest(1, least(f - 6, k - 11)) + 12")
def case_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _times(spark, sf_dir)[0].select((F.col("v") % 25).alias("case_key"), F.col("vt").alias("vol_time"))
    mid = F.timestamp_seconds(F.lit(1704067200) + (F.col("case_key") * 900 + 1000) * 60)
    return V.block_about(v, v.select("case_key").distinct().withColumn("mid", mid), 12).select("case_key", F.col("rn").cast("bigint").alias("rn"))
