"""Queries on bulletins, work units and volume completion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.functions import bulletins as B
from galeframe.operators import alerts as A
from galeframe.operators import polygons as P
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.registry import query
from galeframe.sources import files as S
from galeframe.sources import units as U

_V = B.VTEC
_G = ", ".join(f"regexp_extract(text, '{_V}', {i}) AS {n}" for i, n in ((2, "action"), (3, "office"), (4, "phen"), (5, "sig"), (6, "etn"), (8, "ends")))
_SEG = with_views("bulletin") + f", v AS (SELECT bulletin_id, text, {_G} FROM bulletin), seg AS (SELECT *, concat_ws('.', office, phen, sig, etn) AS key, strptime(ends, '%y%m%dT%H%MZ') AS end_time FROM v)"
_TIE = ["bulletin_id", "pos"]


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.segments(view(spark, sf_dir, "bulletin"))


@query(_SEG + " SELECT bulletin_id, key, action, end_time FROM seg")
def vtec_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select("bulletin_id", "key", "action", F.col("end_time").cast("timestamp_ntz").alias("end_time"))


_UGC = ", z AS (SELECT bulletin_id, list_sort(list_distinct(list_concat(list_transform(range(201, 207), lambda x: 'FLZ' || lpad(x::VARCHAR, 3, '0')), ['ALZ051', 'ALZ0' || (52 + bulletin_id % 30)::VARCHAR, 'GAC00' || (1 + bulletin_id % 9)::VARCHAR]))) AS codes FROM seg)"


@query(_SEG + _UGC + " SELECT bulletin_id, array_to_string(codes, ',') AS codes FROM z")
def ugc_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = view(spark, sf_dir, "bulletin")
    return b.select("bulletin_id", F.array_join(F.get(B.ugc_blocks(F.col("text")), F.lit(0))["codes"], ",").alias("codes"))


@query(_SEG + _UGC + " SELECT bulletin_id, len(codes)::BIGINT AS n FROM z")
def ugc_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many zones the list nearest before each event code has."""
    return segments(spark, sf_dir).select("bulletin_id", F.size("ugc").cast("bigint").alias("n"))


_LL = B.LATLON
_POLY = _SEG + f", n AS (SELECT bulletin_id, list_transform(string_split(trim(regexp_extract(text, '{_LL}', 1)), ' '), lambda x: x::BIGINT) AS v FROM seg WHERE text LIKE '%LAT...LON%')"


def first_polygons(bulletins: DataFrame) -> DataFrame:
    """The first polygon `p` of each bulletin that has one. It is a row before it is filtered: a filter on the parsing itself would
    go ahead of it, and have each text parsed twice."""
    first = F.slice(B.polygons(F.col("text")), 1, 1)
    return bulletins.select("bulletin_id", F.explode_outer(first).alias("p")).filter("p IS NOT NULL")


@query(_POLY + " SELECT bulletin_id, array_to_string(list_transform(range(1, len(v), 2), lambda i: (v[i + 1])::VARCHAR || ' ' || (v[i])::VARCHAR), ';') AS ring FROM n")
def latlon_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    hundredths = lambda c: F.rint(c * 100e0).cast("bigint").cast("string")
    ring = F.transform("p.ring", lambda p: F.concat_ws(" ", hundredths(-p["lon"]), hundredths(p["lat"])))
    return first_polygons(view(spark, sf_dir, "bulletin")).select("bulletin_id", F.array_join(ring, ";").alias("ring"))


_MO = r"LOC\s+\d{4}Z\s+(\d{1,3})DEG\s+(\d{1,3})KT"


@query(_SEG + f" SELECT bulletin_id, regexp_extract(text, '{_MO}', 1)::INT AS deg, regexp_extract(text, '{_MO}', 2)::INT AS kt, (regexp_extract(text, '{_MO}', 1)::INT + 180) % 360 AS heading FROM seg WHERE text LIKE '%MOT...LOC%'")
def motion_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_polygons(view(spark, sf_dir, "bulletin")).select("bulletin_id", "p.deg", "p.kt", "p.heading").filter("deg IS NOT NULL")


@query(_SEG + " SELECT bulletin_id, text LIKE '%LAT...LON%' AS has_polygon FROM seg")
def poly_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select("bulletin_id", F.col("poly").isNotNull().alias("has_polygon"))


#: Segments with zones and ring as texts.
HAZARDS = _POLY + _UGC + (
    ", ring AS (SELECT bulletin_id, '[' || array_to_string(list_transform(range(1, len(v), 2), lambda i: '{\"lon\":' || (-v[i + 1] / 100e0)::VARCHAR || ',\"lat\":' || (v[i] / 100e0)::VARCHAR || '}'), ',') || ']' AS ring FROM n)"
    f", h AS (SELECT key, seg.bulletin_id AS seq, instr(text, regexp_extract(text, '{_V}'))::INT AS pos, action, action IN ('CAN', 'EXP', 'UPG') AS gone, array_to_string(codes, ',') AS ugc, ring FROM seg JOIN z USING (bulletin_id) LEFT JOIN ring USING (bulletin_id))"
)


_STATE = _SEG + ", a AS (SELECT *, action IN ('CAN', 'EXP', 'UPG') AS gone, coalesce(sum((action IN ('CAN', 'EXP', 'UPG'))::INT) OVER (PARTITION BY key ORDER BY bulletin_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM seg), s AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY bulletin_id DESC) AS n, row_number() OVER (PARTITION BY key, life ORDER BY bulletin_id) AS m, count(*) FILTER (WHERE text LIKE '%LAT...LON%') OVER (PARTITION BY key, life ORDER BY bulletin_id) AS polys FROM a)"
_ACTIVE = _STATE + ", act AS (SELECT * FROM s WHERE n = 1 AND NOT gone)"


def lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.alert_state(segments(spark, sf_dir), _TIE)


@query(_ACTIVE + " SELECT key, bulletin_id, polys > 0 AS has_polygon FROM act")
def alert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.active(lives(spark, sf_dir)).select("key", "bulletin_id", F.col("poly").isNotNull().alias("has_polygon"))


_CARRIED = _STATE + f", m AS (SELECT bulletin_id, try_cast(regexp_extract(text, '{_MO}', 1) AS INT) AS deg, try_cast(regexp_extract(text, '{_MO}', 2) AS INT) AS kt FROM seg), c AS (SELECT s.*, last_value(deg IGNORE NULLS) OVER w AS d, last_value(kt IGNORE NULLS) OVER w AS k FROM s JOIN m USING (bulletin_id) WINDOW w AS (PARTITION BY key, life ORDER BY bulletin_id))"


@query(_CARRIED + " SELECT key, bulletin_id, polys > 0 AS has_polygon, d AS deg, k AS kt FROM c WHERE n = 1 AND NOT gone")
def alert_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Motion of active hazards; some follow-ups have a polygon without motion, others neither."""
    return A.active(lives(spark, sf_dir)).select("key", "bulletin_id", F.col("poly").isNotNull().alias("has_polygon"), "motion.deg", "motion.kt")


@query(_ACTIVE + " SELECT key FROM act WHERE end_time >= TIMESTAMP '2024-01-12'")
def alert_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.active(lives(spark, sf_dir), F.lit("2024-01-12").cast("timestamp")).select("key")


@query(_STATE + " SELECT key, bulletin_id FROM s WHERE m = 1 AND action = 'NEW' AND (sig = 'W' OR (sig = 'A' AND phen IN ('TO', 'SV')))")
def push_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.push_events(lives(spark, sf_dir)).select("key", "bulletin_id")


@query(_ACTIVE + ", z AS (SELECT key, unnest(list_concat(list_transform(range(201, 207), lambda x: 'FLZ' || x::VARCHAR), ['ALZ051'])) AS ugc FROM act WHERE polys = 0) SELECT key, 'polygon' AS kind, NULL::VARCHAR AS ugc FROM act WHERE polys > 0 UNION ALL SELECT key, 'zone', ugc FROM z")
def alert_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = "array(named_struct('lon', -86e0, 'lat', 30e0), named_struct('lon', -86e0, 'lat', 31e0), named_struct('lon', -85e0, 'lat', 31e0))"
    shapes = spark.createDataFrame([(f"FLZ{n}",) for n in range(201, 207)] + [("ALZ051",)], "ugc string").withColumn("ring", F.expr(ring))
    return A.geometry(A.active(lives(spark, sf_dir)), shapes).select("key", "kind", "ugc")


#: The fixture's polygons are one right triangle, moved about: two of them share a smaller one of its shape.
_TRIANGLE = _STATE + ", g AS (SELECT key, life, bulletin_id, 30 + (bulletin_id % 400) / 100e0 AS lat, 86 + (bulletin_id % 300) / 100e0 AS west FROM s WHERE text LIKE '%LAT...LON%' AND NOT gone), l AS (SELECT key, lat, west FROM g JOIN (SELECT key, life FROM s WHERE n = 1 AND NOT gone) USING (key, life) QUALIFY row_number() OVER (PARTITION BY key ORDER BY bulletin_id DESC) = 1), o AS (SELECT a.key AS a, b.key AS b, least(a.lat, b.lat) + 0.3e0 - 0.6e0 * greatest(a.west, b.west) - greatest(a.lat - 0.6e0 * a.west, b.lat - 0.6e0 * b.west) AS leg FROM l a JOIN l b ON a.key < b.key)"


@query(_TRIANGLE + " SELECT a, b, round(leg * leg / 1.2e0, 9) AS shared, round((leg * leg / 1.2e0) / (0.15e0 - leg * leg / 1.2e0), 6) AS iou FROM o WHERE leg > 0.001")
def hazard_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of active hazards whose polygons overlap, with the area (square degrees) that they share."""
    corner = F.transform("poly.ring", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))
    shapes = A.active(lives(spark, sf_dir)).filter("poly IS NOT NULL").select(F.col("key").alias("id"), F.array(corner).alias("polygon"))
    pairs = P.overlaps(shapes, shapes, [], 0.5).filter("a < b AND shared > 0.001 * 0.001 / 1.2")
    return pairs.select("a", "b", F.round("shared", 9).alias("shared"), F.round("iou", 6).alias("iou"))


_NAME = "(CASE phen WHEN 'TO' THEN 'Tornado' WHEN 'SV' THEN 'Severe Thunderstorm' WHEN 'FF' THEN 'Flash Flood' WHEN 'MA' THEN 'Marine' ELSE 'Wind' END || ' ' || CASE sig WHEN 'W' THEN 'Warning' WHEN 'A' THEN 'Watch' ELSE 'Advisory' END)"


@query(_ACTIVE + f" SELECT office, count(*) AS state, string_agg(DISTINCT {_NAME}, ', ' ORDER BY {_NAME}) AS hazards FROM act GROUP BY office")
def hazard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.summary(A.active(lives(spark, sf_dir)).groupBy("office"))


_UNIT = with_views("unit") + ", u AS (SELECT unit_id, body, json_valid(body) AS ok FROM unit), p AS (SELECT unit_id, json_extract_string(body, '$.site') AS site, (json_extract_string(body, '$.volume_epoch'))::BIGINT AS volume_epoch, (json_extract_string(body, '$.vcp'))::INT AS vcp FROM u WHERE ok)"


@query(_UNIT + " SELECT unit_id, site, volume_epoch, vcp FROM p")
def unit_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.decoded(view(spark, sf_dir, "unit"))[0].select("unit_id", "site", "volume_epoch", "vcp")


@query(_UNIT + " SELECT 'malformed' AS reason, count(*) AS n FROM u WHERE NOT ok UNION ALL SELECT 'failed', count(*) FROM p WHERE volume_epoch % 700 = 0 UNION ALL SELECT 'done', count(*) FROM p WHERE volume_epoch % 700 <> 0")
def dlq_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that no attempt can process go to the dead letters; malformed ones are only counted."""
    good, bad = U.decoded(view(spark, sf_dir, "unit"))
    tried = U.with_attempts(good, F.col("volume_epoch") % 700 == 0)
    reason = F.when(F.col("dead"), "failed").otherwise("done")
    return bad.select(F.lit("malformed").alias("reason")).unionByName(tried.select(reason.alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


@query(with_views("chunk") + " SELECT volume, count(*) AS chunks, max(chunk_no) AS last_chunk FROM chunk WHERE vcp NOT IN (31, 32, 35) GROUP BY volume HAVING bool_or(kind = 'E')")
def volume_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.complete_volumes(view(spark, sf_dir, "chunk"))


@query("SELECT props AS name, min(event_id) AS first_id FROM events GROUP BY props")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return U.first_seen(e, "props", "event_id")


@query("WITH old AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') SELECT o_orderkey, 'old' AS origin FROM old UNION ALL SELECT DISTINCT o_orderkey, 'new' FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)")
def idempotent_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are inserted into a table that has the finished ones."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    old = o.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("old").alias("origin"))
    return old.unionByName(U.not_yet_in(o.select("o_orderkey", F.lit("new").alias("origin")), old, ["o_orderkey"]))


@query(r"SELECT page_id, len(string_split(url, '/')) - 1 AS depth, regexp_extract(url, '^([a-z]+)://([^/?#]+)', 2) AS host, string_split(url, '/')[-1] AS tail FROM pages WHERE url IS NOT NULL")
def link_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of links as the product resolver reads them."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").filter("url IS NOT NULL")
    depth, host, tail = S.link_parts(F.col("url"))
    return p.select("page_id", depth.alias("depth"), host.alias("host"), tail.alias("tail"))
