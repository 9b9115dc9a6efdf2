"""Queries on flashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.operators import lightning as L
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.registry import query

#: Places, one without a position, and the time at which they ask.
PLACES = [("home", 30.5, -87.0), ("coast", 29.0, -90.5), ("inland", 33.25, -84.75), ("dateline", 0.0, 179.9), ("unknown", None, None)]
NOW, MINUTES = "2024-01-20 00:00:00", 10 * 24 * 60
_HAVERSINE = "2 * 6371e0 * asin(sqrt(least(pow(sin(radians(plat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plon - lon) / 2), 2), 1e0))) * 1000e0 / 1609.344e0"
_NEAR = (
    with_views("flash")
    + ", places AS (SELECT * FROM (VALUES ('home', 30.5e0, -87.0e0), ('coast', 29.0e0, -90.5e0), ('inland', 33.25e0, -84.75e0)) t(place, plat, plon)), "
    + f"near AS (SELECT *, {_HAVERSINE} AS mi FROM flash, places WHERE flash_time > TIMESTAMP '{NOW}' - INTERVAL {MINUTES} MINUTE AND flash_time <= TIMESTAMP '{NOW}') "
)


def places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLACES, "place string, plat double, plon double")


def _near(spark: SparkSession, sf_dir: str, miles: float = 30) -> DataFrame:
    return L.near_places(view(spark, sf_dir, "flash"), places(spark), F.expr(f"TIMESTAMP_NTZ '{NOW}'"), miles, MINUTES)


@query(_NEAR + "SELECT p.place, round(min(mi), 6) AS nearest_mi, count(mi) FILTER (WHERE mi <= 10) AS n10, count(mi) FILTER (WHERE mi <= 30) AS n30, max(flash_time) AS last_flash FROM (SELECT place FROM places UNION ALL SELECT 'dateline') p LEFT JOIN (SELECT * FROM near WHERE mi <= 30) n ON n.place = p.place GROUP BY p.place")
def glm_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.proximity(_near(spark, sf_dir), places(spark)).withColumn("nearest_mi", F.round("nearest_mi", 6))


@query(with_views("flash") + "SELECT round(lat, 0)::BIGINT AS la, round(lon, 0)::BIGINT AS lo, count(*) AS n FROM flash GROUP BY 1, 2 ORDER BY n DESC, la, lo LIMIT 3")
def glm_hot_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.hot_bins(view(spark, sf_dir, "flash"))


@query(_NEAR + f"SELECT place, round(count(*) / {MINUTES}e0, 9) AS per_minute, round((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(flash_time))) / 6e7, 9) AS minutes_since FROM near WHERE mi <= 30 GROUP BY place")
def glm_rate_since_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.rates(_near(spark, sf_dir), F.lit(NOW), MINUTES)
    return out.select("place", F.round("per_minute", 9).alias("per_minute"), F.round("minutes_since", 9).alias("minutes_since"))


@query(_NEAR + ", d AS (SELECT place, date_trunc('day', flash_time) AS t, min(mi) AS m FROM near WHERE mi <= 100 GROUP BY 1, 2), w AS (SELECT *, first_value(m) OVER k AS f, count(*) OVER k AS c FROM d WINDOW k AS (PARTITION BY place ORDER BY t ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) SELECT place, t, round(m, 6) AS nearest_mi, CASE WHEN c < 3 THEN 'Unknown' WHEN m - f < -1 THEN 'Approaching' WHEN m - f > 1 THEN 'Receding' ELSE 'Steady' END AS trend FROM w")
def glm_trend5(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _near(spark, sf_dir, 100).groupBy("place", F.date_trunc("day", "flash_time").cast("timestamp_ntz").alias("t")).agg(F.min("mi").alias("nearest_mi"))
    return L.approach_trend(daily).withColumn("nearest_mi", F.round("nearest_mi", 6))


@query(_NEAR + ", d AS (SELECT place, date_trunc('day', flash_time) AS t, min(mi) <= 30 AS x FROM near WHERE mi <= 100 GROUP BY 1, 2), w AS (SELECT *, lag(x) OVER (PARTITION BY place ORDER BY t) AS b FROM d) SELECT place, t FROM w WHERE x AND NOT b")
def edge_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _near(spark, sf_dir, 100).groupBy("place", F.date_trunc("day", "flash_time").cast("timestamp_ntz").alias("t")).agg((F.min("mi") <= 30).alias("on"))
    return L.rising_edges(daily).select("place", "t")


@query(with_views("flash") + f"SELECT satellite, CASE WHEN epoch(TIMESTAMP '{NOW}') - epoch(max(flash_time)) > 600 THEN NULL ELSE count(*) END AS n FROM flash GROUP BY 1")
def stale_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose last row is older than STALE_S counts as unknown, never as 0."""
    return L.feed_counts(view(spark, sf_dir, "flash"), F.lit(NOW))
