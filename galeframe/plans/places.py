"""Queries on sites, zones, footprints, calibration and deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.operators import alerts as A
from galeframe.operators import raster as R
from galeframe.operators import telemetry as M
from galeframe.operators import tracks as T
from galeframe.operators import verification as V
from galeframe.operators import zones as Z
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.registry import query
from galeframe.sources.shared import kept, spread

_SITES = "(VALUES ('KMOB', 30.68e0, -88.24e0), ('PGUA', 13.45e0, 144.81e0), ('DATE', 10e0, 179.9e0)) t(site, slat, slon)"
_SPOTS = "SELECT c_custkey AS report_id, 8e0 + (c_custkey * 7919 % 25000) / 1000e0 AS lat, CASE c_custkey % 3 WHEN 0 THEN -90e0 + (c_custkey * 131 % 4000) / 1000e0 WHEN 1 THEN 143e0 + (c_custkey * 137 % 4000) / 1000e0 ELSE CASE WHEN c_custkey % 2 = 0 THEN 178e0 ELSE -180e0 END + (c_custkey * 139 % 2000) / 1000e0 END AS lon FROM "
_KM = "2 * 6371e0 * asin(sqrt(least(pow(sin(radians(slat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(slat)) * pow(sin(radians(slon - lon) / 2), 2), 1e0)))"


@query(f"WITH r AS ({_SPOTS} customer) SELECT report_id, site, round({_KM}, 6) AS site_km FROM r, (SELECT * FROM {_SITES}) WHERE {_KM} <= 140")
def site_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*_columns(_SPOTS))
    sites = spark.createDataFrame([("KMOB", 30.68, -88.24), ("PGUA", 13.45, 144.81), ("DATE", 10.0, 179.9)], "site string, slat double, slon double")
    return V.in_range(reports, sites).select("report_id", "site", F.round("site_km", 6).alias("site_km"))


def _columns(sql: str) -> list[str]:
    """The columns of a SELECT without commas inside of them."""
    return sql[len("SELECT ") : sql.rindex(" FROM ")].split(", ")


@query(with_views("obs") + ", c AS (SELECT DISTINCT site, family_id AS f, vol AS v, floor(seed_x / 20000) AS x, floor(seed_y / 20000) AS y FROM obs), n AS (SELECT site, f, v, count(*) AS n FROM c GROUP BY site, f, v), s AS (SELECT site, f, v, n, lag(v) OVER w AS b, lag(n) OVER w AS m FROM n WINDOW w AS (PARTITION BY site, f ORDER BY v)), i AS (SELECT s.site, s.f, s.v, any_value(n) AS n, any_value(m) AS m, count(q.f) AS k FROM s JOIN c p ON p.site = s.site AND p.f = s.f AND p.v = s.b LEFT JOIN c q ON q.site = s.site AND q.f = s.f AND q.v = s.v AND q.x = p.x AND q.y = p.y GROUP BY s.site, s.f, s.v), o AS (SELECT site, k / (n + m - k)::DOUBLE AS iou FROM i) SELECT site, count(*) AS n, round(avg(iou), 9) AS mean_iou, round(median(iou), 9) AS median_iou, round(avg((iou > 0.5)::INT), 9) AS over_half FROM o GROUP BY site")
def envelope_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "obs").select("site", F.col("family_id").alias("family"), "vol", F.struct(F.floor(F.col("seed_x") / 20000), F.floor(F.col("seed_y") / 20000)).alias("cell"))
    out = V.continuity(cells)
    return out.select("site", "n", *(F.round(c, 9).alias(c) for c in ("mean_iou", "median_iou", "over_half")))


@query("WITH v AS (SELECT user_id AS site, ts FROM events UNION ALL SELECT -1, TIMESTAMP '2024-01-01'), g AS (SELECT site, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY site ORDER BY ts) AS g FROM v) SELECT site, round(coalesce(median(g) / 1e6, 300), 3) AS dt_s FROM g GROUP BY site")
def volume_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("site"), F.col("ts").cast("timestamp").alias("vol_time"))
    alone = spark.createDataFrame([(-1, "2024-01-01 00:00:00")], "site long, t string").select(F.col("site").cast(v.schema["site"].dataType), F.to_timestamp("t"))
    return T.volume_gap(v.union(alone)).withColumn("dt_s", F.round("dt_s", 3))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ts WHEN event_id % 3 = 1 THEN ts - INTERVAL 1 MINUTE ELSE TIMESTAMP '2024-02-01' END AS t FROM events")
def volume_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = lambda k: F.col("event_id") % 3 == k
    t = T.volume_time(F.when(part(0), F.col("ts")), F.when(part(0) | part(1), F.col("ts") - F.expr("INTERVAL 1 MINUTE")), F.lit("2024-02-01").cast("timestamp_ntz"))
    return e.select("event_id", t.cast("timestamp_ntz").alias("t"))


@query(with_views("obs") + " SELECT track_id, family_id, count(*) AS n FROM obs GROUP BY ALL")
def track_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "obs").withColumnsRenamed({"track_id": "cell_uid", "family_id": "family_uid"})
    return T.as_tracks(cells).groupBy("track_id", "family_id").agg(F.count("*").alias("n"))


_TEXT = "CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN 'ESTAB 0 0' ELSE concat('cubic rto:204 lastsnd:12 lastrcv:', CAST(event_id * 37 % 900000 AS VARCHAR(12)), ' lastack:3') END"


@query(f"SELECT event_id, CASE WHEN event_id % 5 >= 2 THEN (event_id * 37 % 900000)::BIGINT END AS age_ms FROM events")
def socket_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", f"{_TEXT} AS text")
    return e.select("event_id", M.socket_age(F.col("text")).alias("age_ms"))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS delivery FROM events")
def delivery_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("user_id").alias("unit_id"), F.struct("ts", "event_id").alias("at"))
    return M.deliveries(e).select("event_id", F.col("delivery").cast("bigint").alias("delivery"))


@query(with_views("pixel") + ", f AS (SELECT frame, CASE WHEN frame % 5 = 0 THEN 5000 ELSE 5424 END AS h, CASE WHEN frame % 7 = 0 THEN NULL ELSE 5424 END AS w FROM pixel GROUP BY frame) SELECT frame FROM f WHERE h = 5424 AND w = 5424")
def frame_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = view(spark, sf_dir, "pixel").select("frame").distinct()
    sizes = frames.select("frame", F.when(F.col("frame") % 5 == 0, 5000).otherwise(5424).alias("height"), F.when(F.col("frame") % 7 != 0, 5424).alias("width"))
    return R.whole_frames(sizes).select("frame")


@query(with_views("pixel") + " SELECT frame, level, count(*) AS n, round(CASE WHEN frame % 4 = 0 THEN 330e0 - 0.9e0 * level - frame ELSE 340.349e0 + (89.62e0 - 340.349e0) * level / 255e0 END, 9) AS kelvin FROM pixel GROUP BY frame, level")
def frame_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth frame has a table; another fourth has one that doesn't fall throughout, which doesn't count."""
    pixels = view(spark, sf_dir, "pixel").groupBy("frame", "level").agg(F.count("*").alias("n"))
    pixels = pixels.withColumn("path", F.concat(F.lit("/frames/f"), F.col("frame").cast("string"), F.lit(".png")))
    falling = "transform(sequence(0, 255), i -> 330D - 0.9D * i - frame)"
    tables = spark.range(120).selectExpr("id AS frame").filter("frame % 4 < 2").selectExpr("concat('/tables/f', frame, '.json') AS path", f"CASE WHEN frame % 4 = 0 THEN {falling} ELSE transform(sequence(0, 255), i -> 200D) END AS kelvin_table")
    return R.calibrated(pixels, tables).select("frame", "level", "n", F.round("kelvin", 9).alias("kelvin"))


_HOMES = [("home", ["FLZ203", "ALZ060"]), ("cabin", ["GAC007", "GAC007", "ALZ071"]), ("nowhere", ["TXZ001"])]
_CODES = "list_concat(list_transform(range(201, 207), lambda x: 'FLZ' || lpad(x::VARCHAR, 3, '0')), ['ALZ051', 'ALZ0' || (52 + bulletin_id % 30)::VARCHAR, 'GAC00' || (1 + bulletin_id % 9)::VARCHAR])"


@query(with_views("bulletin") + f", h AS (SELECT * FROM (VALUES ('home', ['FLZ203', 'ALZ060']), ('cabin', ['GAC007', 'GAC007', 'ALZ071']), ('nowhere', ['TXZ001'])) t(place, ugc)) SELECT bulletin_id, place FROM bulletin, h WHERE list_has_any({_CODES}, ugc)")
def zone_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    hazards = A.segments(view(spark, sf_dir, "bulletin")).select(F.col("bulletin_id").alias("key"), "ugc")
    return A.touching(hazards, spark.createDataFrame(_HOMES, "place string, ugc array<string>")).select(F.col("key").alias("bulletin_id"), "place")


@query("SELECT event_id, strftime(ts - INTERVAL 6 HOUR, '%a %I:%M %p') AS expires FROM events")
def local_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All times are in winter."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("end_time"))
    return A.local_expiry(e, "America/Chicago").select("event_id", "expires")


#: Zones about suppliers, some across 180 degrees, some with a hole: offsets of their rings by size.
_OUTER = [(-1.0, -1.0), (0.2, -0.7), (1.0, -1.0), (0.7, 0.1), (1.0, 1.0), (-0.1, 0.6), (-1.0, 1.0), (-0.6, -0.2)]
_HOLE = [(-0.3, -0.3), (-0.3, 0.3), (0.3, 0.3), (0.3, -0.3)]
_ZONE = "s_suppkey AS zone, CASE WHEN s_suppkey % 5 = 0 THEN 179.5e0 + (s_suppkey % 7) / 10e0 ELSE -95e0 + (s_suppkey * 7919 % 17000) / 1000e0 END AS x0, 25e0 + (s_suppkey * 104729 % 13000) / 1000e0 AS y0, 0.2e0 + (s_suppkey % 9) * 0.15e0 AS r"
_POINT = "event_id, CASE WHEN event_id % 4 = 0 THEN 178e0 + (event_id * 31 % 4000) / 1000e0 ELSE -95e0 + (event_id * 104729 % 17000) / 1000e0 END AS x, 25e0 + (event_id * 7919 % 13000) / 1000e0 AS lat"
_SIDES = ", ".join(f"({a}e0, {b}e0, {c}e0, {d}e0, {hole})" for ring, hole in ((_OUTER, 0), (_HOLE, 1)) for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True))


@query(f"WITH z AS (SELECT {_ZONE} FROM supplier), e AS (SELECT zone, x0 + ax * r AS x1, y0 + ay * r AS y1, x0 + bx * r AS x2, y0 + by_ * r AS y2 FROM z, (VALUES {_SIDES}) t(ax, ay, bx, by_, hole) WHERE hole = 0 OR zone % 3 = 0), p AS (SELECT {_POINT} FROM events) SELECT event_id, zone FROM p, e WHERE (y1 > lat) <> (y2 > lat) AND x < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY event_id, zone HAVING count(*) % 2 = 1")
def point_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones of each event's place; all longitudes are given between -180 and 180 degrees."""
    z = spread(spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(*_split(_ZONE)))  # a few bytes are many cells
    wrap = lambda x: x - 360e0 * F.floor((x + 180e0) / 360e0)
    ring = lambda offsets: F.array(*(F.struct(wrap(F.col("x0") + F.lit(a) * F.col("r")).alias("lon"), (F.col("y0") + F.lit(b) * F.col("r")).alias("lat")) for a, b in offsets))
    rings = z.select("zone", ring(_OUTER).alias("ring")).union(z.filter("zone % 3 = 0").select("zone", ring(_HOLE)))
    points = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*_split(_POINT)).select("event_id", wrap(F.col("x")).alias("lon"), "lat")
    cell = 0.25  # points are many and zones overlap: in most pairs the cell is a full one and needs no test
    return Z.in_zones(points, kept(Z.zone_index(rings, cell), "zones"), cell).select("event_id", "zone")


def _split(columns: str) -> list[str]:
    return [c.strip() for c in columns.replace(", CASE", ";CASE").replace("END AS x0, ", "END AS x0;").replace("END AS x, ", "END AS x;").replace(" AS y0, ", " AS y0;").split(";")]
