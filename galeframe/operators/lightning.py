"""Flashes near places: nearest, counts in rings, rates, trends and alert edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galeframe.functions.geo import KM_PER_DEGREE, MILE_M, haversine_km

RINGS_MI, WINDOW_MIN, STALE_S = (10, 30), 30, 600


def near_places(flashes: DataFrame, places: DataFrame, now: Column, miles: float = 30, minutes: int = WINDOW_MIN) -> DataFrame:
    """Flashes of the last minutes within some miles of each place (place, plat, plon), with `mi`.

    Flashes and places meet in cells of a degree, so no flash is compared with far places; the ring of cells about a
    place is as wide as the distance needs at its latitude, goes on across 180 degrees, and is whole near a pole.
    """
    km = miles * MILE_M / 1000
    reach = km / KM_PER_DEGREE
    top = F.abs("plat") + reach
    wide = F.when(top >= 89, F.lit(179.5)).otherwise(F.least(F.lit(reach) / F.cos(F.radians(top)), F.lit(179.5)))
    around = lambda c: F.pmod(c + 180, F.lit(360)) - 180
    cells = places.filter("plat IS NOT NULL AND plon IS NOT NULL").select(
        "*", F.explode(F.sequence(F.floor(F.col("plat") - reach), F.floor(F.col("plat") + reach))).alias("cy"), wide.alias("wide")
    )
    cells = cells.select("place", "plat", "plon", "cy", F.explode(F.sequence(F.floor(F.col("plon") - F.col("wide")), F.floor(F.col("plon") + F.col("wide")))).alias("cx")).withColumn("cx", around(F.col("cx")))
    recent = flashes.filter((F.col("flash_time") > now - F.expr(f"INTERVAL {minutes} MINUTES")) & (F.col("flash_time") <= now))
    recent = recent.withColumns({"cy": F.floor("lat"), "cx": around(F.floor("lon"))})
    mi = haversine_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")) * (1000 / MILE_M)
    return recent.join(cells, ["cy", "cx"]).withColumn("mi", mi).filter(F.col("mi") <= miles).drop("cy", "cx")


def proximity(near: DataFrame, places: DataFrame, rings: tuple[int, ...] = RINGS_MI) -> DataFrame:
    """Of each place with a position: the nearest flash, counts within the rings (0 without flashes), and the last flash."""
    counts = [F.count(F.when(F.col("mi") <= r, 1)).alias(f"n{r}") for r in rings]
    found = near.groupBy("place").agg(F.min("mi").alias("nearest_mi"), *counts, F.max("flash_time").alias("last_flash"))
    known = places.filter("plat IS NOT NULL AND plon IS NOT NULL").select("place").distinct()
    return known.join(found, "place", "left").fillna(0, [f"n{r}" for r in rings])


def hot_bins(flashes: DataFrame, most: int = 3) -> DataFrame:
    """The busiest one-degree bins; degrees are rounded half away from zero."""
    degree = lambda c: F.round(F.col(c), 0).cast("long")
    counts = flashes.groupBy(degree("lat").alias("la"), degree("lon").alias("lo")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "la", "lo").limit(most)


def approach_trend(series: DataFrame) -> DataFrame:
    """Of each place over its last 5 samples of nearest_mi: closer, away or steady; unknown below 3 samples."""
    w = Window.partitionBy("place").orderBy("t").rowsBetween(-4, 0)
    first, n = F.first("nearest_mi").over(w), F.count("nearest_mi").over(w)
    change = F.col("nearest_mi") - first
    trend = F.when(n < 3, "Unknown").when(change < -1e0, "Approaching").when(change > 1e0, "Receding").otherwise("Steady")
    return series.withColumn("trend", trend)


def rates(near: DataFrame, now: Column, minutes: int = WINDOW_MIN) -> DataFrame:
    """Of each place with flashes: how many a minute, and the minutes since the last."""
    since = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.max("flash_time").cast("timestamp"))) / 6e7
    return near.groupBy("place").agg((F.count("*") / float(minutes)).alias("per_minute"), since.alias("minutes_since"))


def feed_counts(flashes: DataFrame, now: Column, stale_s: int = STALE_S) -> DataFrame:
    """Flashes of each satellite; a feed whose newest row is older than some seconds counts as unknown (null), never as 0."""
    age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.max("flash_time").cast("timestamp"))
    return flashes.groupBy("satellite").agg(F.when(age <= stale_s, F.count("*")).alias("n"))


def held(samples: DataFrame, key: str, order: str, at: str, least_s: int) -> DataFrame:
    """Runs of one `state` of each key that lasted some seconds or longer: state, n and began. Null states are a state."""
    w = Window.partitionBy(key).orderBy(order)
    changed = F.coalesce(~F.col("state").eqNullSafe(F.lag("state").over(w)), F.lit(True)) | (F.row_number().over(w) == 1)
    islands = samples.withColumn("island", F.sum(changed.cast("int")).over(w))
    runs = islands.groupBy(key, "island", "state").agg(F.count("*").alias("n"), F.min(at).alias("began"), F.max(at).alias("ended"))
    length = F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("began").cast("timestamp"))
    return runs.filter(length >= least_s * 1_000_000).select(key, "state", "n", "began")


def rising_edges(states: DataFrame) -> DataFrame:
    """Rows at which a place's `on` turns from false to true; a first true row is no edge."""
    w = Window.partitionBy("place").orderBy("t")
    return states.withColumn("before", F.lag("on").over(w)).filter("on AND NOT before").drop("before")
