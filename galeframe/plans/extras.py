"""Queries on listings, names, projections and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.functions import geo
from galeframe.operators import lightning as L
from galeframe.operators import overlap as O
from galeframe.operators import raster as R
from galeframe.operators import sweep as W
from galeframe.operators import tracks as T
from galeframe.operators import verification as V
from galeframe.operators.tracker import TrackerParams, track
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.radar import detections
from galeframe.plans.registry import query
from galeframe.sources import files as S

_KEYS = "SELECT o_orderkey, concat('2024/01/', lpad(CAST(1 + o_orderkey % 28 AS VARCHAR(3)), 2, '0'), '/KMOB/', CASE WHEN o_orderkey % 9 = 0 THEN 'index' ELSE concat('KMOB202401', lpad(CAST(1 + o_orderkey % 28 AS VARCHAR(3)), 2, '0'), '_', lpad(CAST(o_orderkey % 24 AS VARCHAR(3)), 2, '0'), lpad(CAST(o_orderkey % 60 AS VARCHAR(3)), 2, '0'), '00_V06') END, CASE WHEN o_orderkey % 11 = 0 THEN '_MDM' ELSE '' END) AS key FROM "


@query(f"WITH k AS ({_KEYS} orders), t AS (SELECT o_orderkey, key, try_strptime(substr(string_split(key, '/')[-1], 5, 15), '%Y%m%d_%H%M%S') AS ts FROM k WHERE NOT ends_with(key, '_MDM')) SELECT o_orderkey, ts FROM t WHERE ts BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-09 12:00:00'")
def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", _KEYS[len("SELECT o_orderkey, ") : -len(" FROM ")])
    return S.archive_listing(names, "2024-01-05 03:00:00", "2024-01-09 12:00:00").select("o_orderkey", F.col("ts").cast("timestamp_ntz").alias("ts"))


_FILE = "concat('Z_20240101-', CASE p_partkey % 6 WHEN 0 THEN 'RADNAT' WHEN 1 THEN 'SAT01' WHEN 2 THEN 'qpf' ELSE 'OTHER' END, CASE p_partkey % 4 WHEN 0 THEN '.GIF' WHEN 1 THEN '.jpg' WHEN 2 THEN '.PNG' ELSE '.txt' END)"


@query(f"WITH f AS (SELECT {_FILE} AS path, p_partkey AS modified FROM part), g AS (SELECT path, modified, regexp_extract(path, '(?i)-([A-Z0-9]+)\\.(?:GIF|JPG|PNG)$', 1) AS product FROM f) SELECT product, max(modified) AS modified, count(*) AS n FROM g WHERE product <> '' GROUP BY product")
def newest_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(f"{_FILE} AS path", "p_partkey AS modified")
    return S.latest_graphics(f).select("product", "modified", "n")


_ZIP = "concat('/source/gis/c_', lpad(CAST(1 + s_suppkey % 28 AS VARCHAR(3)), 2, '0'), CASE s_suppkey % 4 WHEN 0 THEN 'ap' WHEN 1 THEN 'mr' WHEN 2 THEN 'se' ELSE 'xx' END, CAST(20 + s_suppkey % 7 AS VARCHAR(3)), CASE WHEN s_suppkey % 5 = 0 THEN '.txt' ELSE '.zip' END)"


@query(f"WITH z AS (SELECT s_suppkey, {_ZIP} AS url FROM supplier) SELECT s_suppkey, CASE WHEN url LIKE '%.zip' THEN 2000 + substr(url, 19, 2)::INT ELSE 0 END AS y, CASE WHEN url LIKE '%.zip' THEN CASE substr(url, 17, 2) WHEN 'ap' THEN 4 WHEN 'mr' THEN 3 WHEN 'se' THEN 9 ELSE 0 END ELSE 0 END AS m, CASE WHEN url LIKE '%.zip' THEN substr(url, 15, 2)::INT ELSE 0 END AS d FROM z")
def archive_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey", f"{_ZIP} AS url")
    return s.select("s_suppkey", S.archive_date(F.col("url")).alias("a")).select("s_suppkey", "a.*")


@query("SELECT event_id FROM events WHERE epoch(TIMESTAMP '2024-01-20') - floor(epoch(ts)) > 86400")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("modified"))
    return S.expired(e, F.lit("2024-01-20").cast("timestamp"), 1440).select("event_id")


@query("SELECT c_custkey, CASE WHEN length(trim(c_mktsegment)) = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'FL' || 'C' || right(lpad(c_custkey::VARCHAR, 5, '0'), 3) WHEN c_custkey % 3 = 1 THEN 'FL' || 'Z' || lpad((c_nationkey)::VARCHAR, 3, '0') END AS ugc FROM customer")
def ugc_from_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    fips = F.when(F.col("c_custkey") % 3 == 0, F.lpad(F.col("c_custkey").cast("string"), 5, "0"))
    zone = F.when(F.col("c_custkey") % 3 == 1, F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", S.zone_code(F.lit("FL"), fips, zone).alias("ugc"))


_XY = "WITH p AS (SELECT s_suppkey AS k, -150000e0 + (s_suppkey * 7919 % 300000) AS x, -150000e0 + (s_suppkey * 104729 % 300000) AS y FROM supplier)"


def _xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey AS k", "-150000e0 + (s_suppkey * 7919 % 300000) AS x", "-150000e0 + (s_suppkey * 104729 % 300000) AS y")


@query(_XY + ", q AS (SELECT *, sqrt(x * x + y * y) AS rho, radians(30.5e0) AS p0 FROM p), c AS (SELECT *, rho / 6371000e0 AS c FROM q) SELECT k, round(degrees(asin(cos(c) * sin(p0) + y * sin(c) * cos(p0) / rho)), 9) AS lat, round(degrees(radians(-87e0) + atan2(x * sin(c), rho * cos(p0) * cos(c) - y * sin(p0) * sin(c))), 9) AS lon FROM c")
def aeqd_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = geo.aeqd_to_lonlat(F.col("x"), F.col("y"), F.lit(30.5), F.lit(-87.0))
    return _xy(spark, sf_dir).select("k", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


@query(_XY + f" SELECT k, round(30e0 + (k % 60) * 1.852e0 * 0.5e0 * cos(radians(k * 37 % 360)) / {geo.KM_PER_DEGREE}e0, 9) AS lat, round(-87e0 + (k % 60) * 1.852e0 * 0.5e0 * sin(radians(k * 37 % 360)) / ({geo.KM_PER_DEGREE}e0 * cos(radians(30e0))), 9) AS lon FROM p")
def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = geo.travelled(F.lit(30e0), F.lit(-87e0), F.col("k") * 37 % 360, F.col("k") % 60)
    return _xy(spark, sf_dir).select("k", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


_SUN = "degrees(asin(sin(radians(lat)) * sin(tilt) + cos(radians(lat)) * cos(tilt) * cos(radians(15e0 * (h - 12e0) + lon))))"


@query(f"WITH p AS (SELECT s_suppkey AS k, 25e0 + s_suppkey % 20 AS lat, -95e0 + s_suppkey % 17 AS lon, s_suppkey % 24 AS h, radians(-23.44e0 * cos(radians(360e0 / 365e0 * (s_suppkey % 365 + 10e0)))) AS tilt FROM supplier), e AS (SELECT k, {_SUN} AS e FROM p) SELECT k, round(e, 9) AS elevation, CASE WHEN e >= 5 THEN round(0.4e0 / sin(radians(e)), 9) END AS albedo FROM e")
def sun_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_suppkey AS k", "25e0 + s_suppkey % 20 AS lat", "-95e0 + s_suppkey % 17 AS lon", "s_suppkey % 24 AS h")
    e = s.withColumn("e", R.sun_elevation(F.col("lat"), F.col("lon"), F.col("k") % 365, F.col("h")))
    return e.select("k", F.round("e", 9).alias("elevation"), F.round(R.albedo(F.lit(0.4), F.col("e")), 9).alias("albedo"))


@query(with_views("obs") + ", p AS (SELECT family_id, track_id, CASE WHEN count(*) >= 3 THEN max(area) - min(area) END AS spread, count(*) AS n FROM obs GROUP BY ALL) , f AS (SELECT family_id, avg(spread) AS m, sum(n) AS n FROM p GROUP BY family_id) SELECT round(avg(m), 6) AS pooled, sum(n)::BIGINT AS n, count(*) AS cases FROM f")
def pooled_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric of each case first, then its mean over cases; cases without it don't count."""
    spread = F.when(F.count("*") >= 3, F.max("area") - F.min("area"))
    return V.pooled(view(spark, sf_dir, "obs"), "family_id", "track_id", spread).withColumn("pooled", F.round("pooled", 6))


_STATES = "WITH s AS (SELECT user_id, event_id, ts, value > 60 AS st FROM events), c AS (SELECT *, CASE WHEN st IS DISTINCT FROM lag(st) OVER w THEN 1 ELSE 0 END AS ch FROM s WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), i AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM c), r AS (SELECT user_id, island, st, count(*) AS n, min(ts) AS began, max(ts) AS ended FROM i GROUP BY ALL)"


@query(_STATES + " SELECT user_id, st AS state, n, began FROM r WHERE epoch(ended) - epoch(began) >= 86400")
def held_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of one state that lasted a day or longer."""
    s = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "ts", (F.col("value") > 60).alias("state"))
    return L.held(s, "user_id", "event_id", "ts", 86_400)


_PLACE = "CASE WHEN obs_id % 7 = 0 THEN NULL ELSE -90e0 + (obs_id % 999) * 0.5e0 / 8 END"
_VALID = "strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(vol * 5 AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ')"


@query(with_views("obs") + f", p AS (SELECT site, obs_id AS cell_id, split_from, round({_PLACE}, 3) AS lon, round(30e0 + obs_id % 50 * 0.25e0, 3) AS lat, round(dbz * 1e0, 3) AS dbz, {_VALID} AS valid_time FROM obs) SELECT *, lon IS NOT NULL AS placed FROM p")
def public_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as they are announced; the feature's own fields are read back from its text."""
    lon = F.when(F.col("obs_id") % 7 == 0, float("nan")).otherwise(-90e0 + (F.col("obs_id") % 999) * 0.5 / 8)
    o = view(spark, sf_dir, "obs").select("site", F.col("obs_id").alias("cell_id"), "split_from", lon.alias("lon"), (30e0 + F.col("obs_id") % 50 * 0.25).alias("lat"), F.col("dbz").cast("double").alias("dbz"), "vol")
    out = T.public_cells(o, F.timestamp_seconds(F.lit(1704067200) + F.col("vol") * 300))
    read = F.from_json("feature", "geometry struct<coordinates:array<double>>, properties struct<valid_time:string>")
    return out.select("site", "cell_id", "split_from", "lon", "lat", "dbz", read["properties"]["valid_time"].alias("valid_time"), read["geometry"]["coordinates"].isNotNull().alias("placed"))


@query("SELECT user_id, (epoch(TIMESTAMP '2024-01-30') - epoch(max(ts))) > 4500 AS stale FROM events GROUP BY user_id")
def frame_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loop whose newest frame is older than 75 minutes is stale."""
    return R.stale_loops(spark.read.parquet(f"{sf_dir}/events.parquet"), "user_id", "ts", F.lit("2024-01-30 00:00:00").cast("timestamp"))


@query(with_views("obs") + " SELECT vol, track_id, coalesce(nullif(family_id, 3), -track_id) AS family FROM obs")
def cell_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells without a family are their own, under their negative number."""
    return T.own_family(view(spark, sf_dir, "obs").withColumn("family_id", F.nullif("family_id", F.lit(3)))).select("vol", "track_id", "family")


#: Components by distance, each linked to the family that most of its tracks were in before; a family has one heir.
_SWEEP = with_views("obs").replace("WITH", "WITH RECURSIVE", 1) + (
    ", d AS (SELECT * FROM (VALUES (10e0), (25e0), (50e0), (100e0)) t(km))"
    ", c AS (SELECT site, vol, track_id, arg_max(seed_x, obs_id) AS x, arg_max(seed_y, obs_id) AS y FROM obs GROUP BY ALL)"
    ", near AS MATERIALIZED (SELECT km, a.site, a.vol, a.track_id AS a, b.track_id AS b FROM c a JOIN c b ON a.site = b.site AND a.vol = b.vol AND a.track_id <> b.track_id, d WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / 1000 <= km)"
    ", reached AS (SELECT km, site, vol, track_id AS root, track_id AS node FROM c, d UNION SELECT r.km, r.site, r.vol, r.root, n.b FROM reached r JOIN near n ON n.km = r.km AND n.site = r.site AND n.vol = r.vol AND n.a = r.node AND n.b > r.root)"
    ", m AS MATERIALIZED (SELECT km, site, vol, node AS track_id, min(root) AS family FROM reached GROUP BY ALL)"
    ", p AS (SELECT *, lag(vol) OVER w AS pv, lag(family) OVER w AS pf FROM m WINDOW w AS (PARTITION BY km, site, track_id ORDER BY vol))"
    ", g AS (SELECT km, site, vol, family, pv, pf, count(*) AS votes, min(track_id) AS seen FROM p GROUP BY ALL)"
    ", size AS (SELECT km, site, vol, family, count(*) AS n FROM p GROUP BY ALL)"
    ", b AS (SELECT * FROM g WHERE pv IS NOT NULL QUALIFY row_number() OVER (PARTITION BY km, site, vol, family ORDER BY votes DESC, seen) = 1)"
    ", link AS MATERIALIZED (SELECT km, site, vol, family, pv, pf FROM b JOIN size USING (km, site, vol, family) QUALIFY row_number() OVER (PARTITION BY km, site, pv, pf ORDER BY votes DESC, n DESC, vol DESC, family DESC) = 1)"
    ", walk AS (SELECT km, site, vol, family, vol AS rv, family AS rf FROM size ANTI JOIN link USING (km, site, vol, family) UNION ALL SELECT l.km, l.site, l.vol, l.family, w.rv, w.rf FROM walk w JOIN link l ON l.km = w.km AND l.site = w.site AND l.pv = w.vol AND l.pf = w.family)"
    ", life AS (SELECT km, site, rv, rf, (max(vol) - min(vol)) * 5 AS minutes FROM walk GROUP BY ALL)"
    ", sets AS (SELECT km, site, vol, family, list(track_id) AS ids FROM m GROUP BY ALL)"
    ", churn AS (SELECT l.km, l.site, sum(len(a.ids) + len(b.ids) - 2 * len(list_intersect(a.ids, b.ids))) / sum(len(a.ids) + len(b.ids) - len(list_intersect(a.ids, b.ids))) AS churn FROM link l JOIN sets a USING (km, site, vol, family) JOIN sets b ON b.km = l.km AND b.site = l.site AND b.vol = l.pv AND b.family = l.pf GROUP BY ALL)"
    ", foot AS MATERIALIZED (SELECT DISTINCT km, site, vol, family, floor(seed_x / 20000) AS fx, floor(seed_y / 20000) AS fy FROM m JOIN obs USING (site, vol, track_id))"
    ", fn AS (SELECT km, site, vol, family, count(*) AS n FROM foot GROUP BY ALL)"
    ", fb AS (SELECT l.km, l.site, l.vol, l.family, count(*) AS k FROM link l JOIN foot a USING (km, site, vol, family) JOIN foot b ON b.km = l.km AND b.site = l.site AND b.vol = l.pv AND b.family = l.pf AND b.fx = a.fx AND b.fy = a.fy GROUP BY ALL)"
    ", iou AS (SELECT l.km, l.site, avg(coalesce(k, 0) / (a.n + b.n - coalesce(k, 0))::DOUBLE) AS overlap FROM link l JOIN fn a USING (km, site, vol, family) JOIN fn b ON b.km = l.km AND b.site = l.site AND b.vol = l.pv AND b.family = l.pf LEFT JOIN fb ON fb.km = l.km AND fb.site = l.site AND fb.vol = l.vol AND fb.family = l.family GROUP BY ALL)"
    ", per AS (SELECT km, site, count(*) / count(DISTINCT vol)::DOUBLE AS per_volume, max(n) AS most_cells FROM size GROUP BY ALL)"
)


@query(_SWEEP + " SELECT site, km, round(per_volume, 9) AS per_volume, (SELECT count(*) FROM life f WHERE f.km = per.km AND f.site = per.site) AS families, (SELECT max(minutes) FROM life f WHERE f.km = per.km AND f.site = per.site) AS longest_min, round(overlap, 9) AS overlap, round(churn, 9) AS churn, most_cells FROM per LEFT JOIN churn USING (km, site) LEFT JOIN iou USING (km, site)")
def family_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families at several joining distances: their number, lives, overlap, churn and size."""
    obs = view(spark, sf_dir, "obs")
    last = F.max_by(F.struct(F.col("seed_x").alias("x"), F.col("seed_y").alias("y")), "obs_id").alias("s")
    cells = obs.groupBy("site", "vol", "track_id").agg(last).select("site", "vol", "track_id", "s.*")
    footprints = obs.select("site", "vol", "track_id", F.struct(F.floor(F.col("seed_x") / 20000), F.floor(F.col("seed_y") / 20000)).alias("cell"))
    out = W.distance_sweep(cells, footprints, (10.0, 25.0, 50.0, 100.0))
    return out.withColumns({c: F.round(c, 9) for c in ("per_volume", "overlap", "churn")})


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detections(spark, sf_dir)
    km = lambda c: (F.col(c) * 4 - 150) * 1000  # noqa: E731  # blocks of 4 km
    return found.select("site", (F.col("vol") * 300).cast("double").alias("t"), F.col("obj").alias("cell_id"), km("cx").alias("x"), km("cy").alias("y"), F.col("area_km2").alias("area"), F.col("max_dbz").alias("dbz"), "pix_y", "pix_x")


@query()
def overlap_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected cells followed by overlap; tests hold the exact lifecycle."""
    return O.overlap_tracks(_cells(spark, sf_dir), O.OverlapParams(grid_km=4.0))


@query()
def detected_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected cells under the window tracker, with daughters known by their footprints."""
    return track(_cells(spark, sf_dir), TrackerParams(grid_km=4.0))


@query()
def track_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.overlap_tracks(_cells(spark, sf_dir), O.OverlapParams(grid_km=4.0), events=True).groupBy("site", "kind").agg(F.count("*").alias("n"))


_PAGE = "concat(coalesce(html, ''), CASE WHEN page_id % 5 <> 0 THEN concat('<p>Valid 07', lpad(CAST(page_id * 37 % 2400 AS VARCHAR(5)), 4, '0'), 'Z</p>') ELSE '' END, CASE WHEN page_id % 3 <> 0 THEN concat('<a href=\"outlk_', lpad(CAST(page_id * 37 % 2400 AS VARCHAR(5)), 4, '0'), '_prt.html\">') ELSE '' END, CASE WHEN page_id % 7 <> 0 THEN concat('<a href=\"outlk_', lpad(CAST(page_id * 11 % 2400 AS VARCHAR(5)), 4, '0'), '_prt.html\">') ELSE '' END)"


@query(f"WITH p AS (SELECT page_id, {_PAGE} AS html FROM pages), t AS (SELECT page_id, regexp_extract_all(html, 'outlk_(\\d{{4}})_prt\\.html', 1) AS times, regexp_extract(html, 'Valid\\s+\\d{{2}}(\\d{{4}})Z', 1) AS valid FROM p) SELECT page_id, CASE WHEN list_contains(times, valid) THEN valid ELSE times[-1] END AS hhmm FROM t")
def product_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current issue that each page links, null on pages without such links."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id", f"{_PAGE} AS html")
    return pages.select("page_id", S.current_link(F.col("html")).alias("hhmm"))
