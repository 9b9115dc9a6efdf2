"""Scores of tracked objects: trends, motion, durations, linearity, lifecycle, families.

Trackers number the identities of each site by themselves, so an identity is a `site` with an `id`; summaries have a row
for each site. Rows without a site (null) are a site of their own. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galeframe.functions.geo import equal_area_radius_km
from galeframe.functions.quantiles import stepped_quantiles

VOLUME_MIN, NEAR_KM, IMPOSSIBLE_MS, TREND_MIN = 5, 20.0, 45.0, 30
SPEED_STEP = 0.001
IDENTITY = ["site", "id"]


def _at(df: DataFrame) -> Column:
    """When a sample was seen, in seconds: its time `t` if it has one, else its volume's number times VOLUME_MIN."""
    return F.col("t").cast("double") if "t" in df.columns else (F.col("vol") * (VOLUME_MIN * 60)).cast("double")


def _minutes(df: DataFrame) -> Column:
    return (F.max("t") - F.min("t")) / 60 if "t" in df.columns else (F.max("vol") - F.min("vol")) * VOLUME_MIN


def collapsed(obs: DataFrame, identity: str) -> DataFrame:
    """One sample of each site, identity and volume: area-weighted centre, summed area, greatest intensity and top.

    Rows whose identity is null or negative go. `obs` may have the time of its volume as `t` (seconds); then samples have the latest, and all scores go by it.
    """
    w = F.greatest(F.col("area"), F.lit(1e-9))
    one = obs.filter(F.col(identity).isNotNull() & (F.col(identity) >= 0))
    return one.groupBy("site", F.col(identity).alias("id"), "vol").agg(
        (F.sum(w * F.col("seed_x")) / F.sum(w)).alias("x"), (F.sum(w * F.col("seed_y")) / F.sum(w)).alias("y"),
        F.sum("area").alias("area"), F.max("dbz").alias("dbz"), F.max("top").alias("top"), F.count("*").alias("n_cells"),
        *([F.max("t").alias("t")] if "t" in obs.columns else []),
    )


def steps(samples: DataFrame) -> DataFrame:
    """Samples with dt (s), dx and dy since the one before of their identity, and the speed; the first ones go."""
    at = _at(samples)
    w = Window.partitionBy(*IDENTITY).orderBy(at)
    out = samples.select("*", *((F.col(c) - F.lag(c).over(w)).alias(f"d{c}") for c in ("x", "y")), (at - F.lag(at).over(w)).alias("dt"))
    return out.filter("dt > 0").withColumn("speed", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")) / F.col("dt"))


def speed_summary(moved: DataFrame) -> DataFrame:
    """Per site: number of steps, mean and 95th percentile (to SPEED_STEP) of their speeds, and how many are impossible."""
    v = F.col("speed")
    sums = moved.groupBy("site").agg(F.count("*").alias("n"), F.avg(v).alias("mean_ms"), F.count(F.when(v > IMPOSSIBLE_MS, 1)).alias("impossible"))
    high = stepped_quantiles(moved, ["site"], v, {"p95_ms": 0.95}, SPEED_STEP).withColumnRenamed("site", "of")
    return sums.join(high, F.col("site").eqNullSafe(F.col("of"))).select("site", "n", "mean_ms", "p95_ms", "impossible")


def _slope(value: str, w) -> Column:
    """Least-squares change per minute (`minute`) over a frame; null with one sample or no spread in time."""
    t, y = F.col("minute"), F.col(value)
    n = F.count("*").over(w)
    num = n * F.sum(t * y).over(w) - F.sum(t).over(w) * F.sum(y).over(w)
    den = n * F.sum(t * t).over(w) - F.sum(t).over(w) * F.sum(t).over(w)
    return num / F.nullif(den.cast("double"), F.lit(0e0))


def trends(samples: DataFrame, values: tuple[str, ...] = ("area", "dbz", "top")) -> DataFrame:
    """Slopes per minute over the last half hour; with a single sample there, over the last two of the track."""
    first = F.min(_at(samples)).over(Window.partitionBy(*IDENTITY))  # minutes of a track's own life, so that sums of squares stay small
    samples = samples.withColumn("minute", (_at(samples) - first) / 60)
    base = Window.partitionBy(*IDENTITY).orderBy("minute")
    recent, two = base.rangeBetween(-TREND_MIN, 0), base.rowsBetween(-1, 0)
    cols = {f"{v}_trend": F.when(F.count("*").over(recent) >= 2, _slope(v, recent)).otherwise(_slope(v, two)) for v in values}
    return samples.withColumns(cols).drop("minute")


def durations(samples: DataFrame) -> DataFrame:
    per = samples.groupBy(*IDENTITY).agg(_minutes(samples).alias("minutes"), F.count("*").alias("n"))
    share = lambda c: F.avg(F.when(c, 1e0).otherwise(0e0))
    return per.groupBy("site").agg(F.count("*").alias("tracks"), F.avg("minutes").alias("mean_min"), F.median("minutes").alias("median_min"), F.max("minutes").alias("max_min"), F.avg("n").alias("vols_mean"), share(F.col("n") >= 3).alias("frac_ge3"), share(F.col("n") == 1).alias("frac_singleton"))


def _residual(y: str) -> Column:
    """RMS distance from the best line in time (`minute`)."""
    t = F.col("minute")
    sxx, syy = F.var_pop(t), F.var_pop(y)
    sxy = F.covar_pop(t, F.col(y))
    return F.sqrt(F.greatest(syy - sxy * sxy / sxx, F.lit(0e0)))


def linearity(samples: DataFrame) -> DataFrame:
    """Per site, duration-weighted means over tracks of 3 samples or more: residual of position (km), of area by its mean, of dBZ."""
    s = samples.withColumns({"xk": F.col("x") / 1000e0, "yk": F.col("y") / 1000e0, "minute": _at(samples) / 60})
    per = s.groupBy(*IDENTITY).agg(F.count("*").alias("n"), _minutes(samples).alias("minutes"), _residual("xk").alias("rx"), _residual("yk").alias("ry"), _residual("area").alias("ra"), F.avg("area").alias("ma"), _residual("dbz").alias("rd"))
    per = per.filter("n >= 3 AND minutes > 0")
    w = F.greatest(F.col("minutes").cast("double"), F.lit(1e-6))
    mean = lambda v: F.sum(v * w) / F.sum(w)
    return per.groupBy("site").agg(F.count("*").alias("n_fit"), mean(F.sqrt(F.col("rx") * F.col("rx") + F.col("ry") * F.col("ry"))).alias("pos_rms_km"), mean(F.col("ra") / F.col("ma")).alias("area_rms_frac"), mean(F.col("rd")).alias("dbz_rms"))


def fragmentation(samples: DataFrame) -> DataFrame:
    """Per site: new identities by the hours from its first to its last sample, and identities by the hours that they lived."""
    at = _at(samples)
    per = samples.groupBy(*IDENTITY).agg((F.max(at) - F.min(at)).alias("d"), F.min(at).alias("a"), F.max(at).alias("b"))
    hours = lambda c: F.greatest(c / 3600e0, F.lit(1e-6))
    return per.groupBy("site").agg((F.count("*") / hours(F.max("b") - F.min("a"))).alias("new_ids_per_hour"), (F.count("*") / hours(F.sum("d"))).alias("ids_per_storm_hour"))


def _cells(df: DataFrame, side: str, around: bool = False) -> DataFrame:
    """`df` with the cell of NEAR_KM (cx, cy) of its points, or those about it as well: near points share one."""
    at = lambda c: F.floor(F.col(f"{side}{c}") / (NEAR_KM * 1000))
    if not around:
        return df.withColumns({"cx": at("x"), "cy": at("y")})
    near = lambda c: F.explode(F.sequence(at(c) - 1, at(c) + 1))
    return df.withColumn("cx", near("x")).withColumn("cy", near("y"))


def _near(a: str, b: str) -> Column:
    return F.sqrt(F.pow(F.col(f"{a}x") - F.col(f"{b}x"), 2) + F.pow(F.col(f"{a}y") - F.col(f"{b}y"), 2)) / 1000e0


def lifecycle(samples: DataFrame) -> DataFrame:
    """Births and deaths of identities per site, and how many stand beside a storm that lives on.

    samples: site, id, vol, x, y, area, split_from, one row per site, id and volume. A birth's neighbours are ids of its
    site alive in its volume and the one before, within the smaller of NEAR_KM and the sum of radii; a death's are ids
    alive in its volume and the next, within NEAR_KM; both meet in cells of that size. A site's first volume has no
    births, its last no deaths.
    """
    w = Window.partitionBy(*IDENTITY).orderBy("vol")
    whole = Window.partitionBy(*IDENTITY)
    samples = samples.withColumn("site", F.struct("site"))  # so that a null one joins like any other
    s = samples.withColumns({"born": F.min("vol").over(whole), "died": F.max("vol").over(whole), "before": F.lag("vol").over(w), "after": F.lead("vol").over(w), "r": equal_area_radius_km(F.col("area"))})
    span = samples.groupBy("site").agg(F.min("vol").alias("v0"), F.max("vol").alias("v1"))
    s = s.join(span, "site")
    births = s.filter("vol = born AND vol > v0").select("site", "vol", "id", "split_from", *(F.col(c).alias(f"b{c}") for c in ("x", "y", "r")))
    stay = s.filter("after = vol + 1").select("site", (F.col("vol") + 1).alias("vol"), *(F.col(c).alias(f"p{c}") for c in ("x", "y", "r")))
    reach = F.least(F.lit(NEAR_KM), F.col("br") + F.col("pr"))
    meet = ["site", "vol", "cx", "cy"]
    split_like = _cells(births, "b", around=True).join(_cells(stay, "p"), meet).filter(_near("b", "p") <= reach).select("site", "id", "split_from").distinct()
    deaths = s.filter("vol = died AND vol < v1").select("site", "vol", "id", *(F.col(c).alias(f"b{c}") for c in ("x", "y")))
    next_ = s.filter("before = vol - 1").select("site", (F.col("vol") - 1).alias("vol"), *(F.col(c).alias(f"p{c}") for c in ("x", "y")))
    silent = _cells(deaths, "b", around=True).join(_cells(next_, "p"), meet).filter(_near("b", "p") <= NEAR_KM).select("site", "id").distinct()
    n = lambda df, name: df.groupBy("site").agg(F.count("*").alias(name))
    splits = split_like.groupBy("site").agg(F.count(F.when(F.col("split_from").isNull(), 1)).alias("orphan_births"), F.count("split_from").alias("recorded_splits"))
    out = span.select("site").join(n(births, "births"), "site", "left").join(splits, "site", "left").join(n(deaths, "deaths"), "site", "left").join(n(silent, "silent_deaths"), "site", "left")
    out = out.fillna(0, ["births", "orphan_births", "recorded_splits", "deaths", "silent_deaths"])
    part = F.col("recorded_splits") + F.col("orphan_births")
    return out.select(F.col("site.site").alias("site"), "births", "orphan_births", "recorded_splits", "deaths", "silent_deaths", F.when(part == 0, F.lit(1e0)).otherwise(F.col("recorded_splits") / part).alias("split_coverage"))


def motion(moved: DataFrame, last: int = 4) -> DataFrame:
    """Time-weighted mean velocity of the last displacements, those faster than a storm left out."""
    ok = moved.filter(F.col("speed") <= IMPOSSIBLE_MS)
    w = Window.partitionBy(*IDENTITY).orderBy(_at(ok)).rowsBetween(-(last - 1), 0)
    return ok.select("site", "id", "vol", *((F.sum(c).over(w) / F.sum("dt").over(w)).alias(v) for c, v in (("dx", "u_ms"), ("dy", "v_ms"))))


def family_rollup(obs: DataFrame) -> DataFrame:
    """Per site, volume and family: summed area, extremes, and the sorted distinct track ids."""
    return obs.groupBy("site", "vol", "family_id").agg(F.sum("area").alias("area"), F.max("dbz").alias("dbz"), F.max("top").alias("top"), F.sort_array(F.collect_set("track_id")).alias("track_ids"))


def churn(families: DataFrame) -> DataFrame:
    """Per site, changed members by all members over consecutive volumes of each family."""
    w = Window.partitionBy("site", "family_id").orderBy("vol")
    pair = families.withColumn("was", F.lag("track_ids").over(w)).filter("was IS NOT NULL")
    changed = F.size(F.array_except("track_ids", "was")) + F.size(F.array_except("was", "track_ids"))
    return pair.groupBy("site").agg((F.sum(changed) / F.sum(F.size(F.array_union("track_ids", "was")))).alias("churn"), F.count("*").alias("n"))


def votes(members: DataFrame) -> DataFrame:
    """Of each site's group (site, grp, uid, pos) the prior uid with most members; ties go to the one seen first."""
    n = members.groupBy("site", "grp", "uid").agg(F.count("*").alias("votes"), F.min("pos").alias("first_pos"))
    known = F.col("uid").isNotNull()
    best = F.max_by(F.when(known, F.struct("uid", "votes")), F.when(known, F.struct("votes", -F.col("first_pos")))).alias("best")
    return n.groupBy("site", "grp").agg(F.sum("votes").alias("size"), best).select("site", "grp", "size", F.col("best.uid").alias("uid"), F.coalesce("best.votes", F.lit(0).cast("long")).alias("votes"))


def claims(voted: DataFrame) -> DataFrame:
    """The site's group that keeps each prior uid: most votes, then members, then the larger group id. Others get a parent."""
    w = Window.partitionBy("site", "uid").orderBy(F.desc("votes"), F.desc("size"), F.desc("grp"))
    rank = F.row_number().over(w)
    return voted.withColumn("rank", rank).select("site", "grp", F.when(F.col("uid").isNotNull() & (F.col("rank") == 1), F.col("uid")).alias("kept"), F.when(F.col("uid").isNotNull() & (F.col("rank") > 1), F.col("uid")).alias("parent"))


def as_text(scores: DataFrame, places: int = 2) -> DataFrame:
    """A line "name value" of each number of a one-row table; what isn't finite is n/a."""
    def line(c: str) -> Column:
        v = F.col(c).cast("double")
        finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
        return F.concat(F.rpad(F.lit(c), 24, " "), F.when(finite, F.format_number(v, places)).otherwise("n/a"))

    return scores.select(F.explode(F.array(*map(line, scores.columns))).alias("line"))


def volume_gap(volumes: DataFrame, default_s: float = 300e0) -> DataFrame:
    """The median time between the volumes (site, vol_time) of each site; a site with one volume has the default."""
    w = Window.partitionBy("site").orderBy("vol_time")
    gap = (F.unix_micros("vol_time") - F.unix_micros(F.lag("vol_time").over(w))) / 1e6
    return volumes.withColumn("gap", gap).groupBy("site").agg(F.coalesce(F.median("gap"), F.lit(default_s)).alias("dt_s"))


def volume_time(start: Column, first_ray: Column, now: Column) -> Column:
    """When a volume was scanned: its start, else that of its first ray, else now."""
    return F.coalesce(start, first_ray, now)


def own_family(cells: DataFrame) -> DataFrame:
    """`cells` with `family`: that of the cell, else its own negative number, so that cells without one stay apart."""
    return cells.withColumn("family", F.coalesce("family_id", -F.col("track_id")))


def public_cells(cells: DataFrame, at: Column) -> DataFrame:
    """Cells (site, cell_id, lon, lat, dbz, split_from and, if known, polygons of (x, y)) as they are announced: ISO time, no NaN
    but null, and a GeoJSON feature: its outline if it has one, else its place. Cells without a place have no geometry."""
    clean = lambda c: F.when(~F.isnan(c), F.round(c, 3))
    lon, lat = clean(F.col("lon")), clean(F.col("lat"))
    point = F.when(lon.isNotNull() & lat.isNotNull(), F.struct(F.lit("Point").alias("type"), F.to_json(F.array(lon, lat)).alias("coordinates")))
    geometry = point
    if "polygons" in cells.columns:
        rings = F.transform("polygons", lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.array(F.round(p["x"], 3), F.round(p["y"], 3)))))
        area = F.struct(F.lit("MultiPolygon").alias("type"), F.to_json(rings).alias("coordinates"))
        geometry = F.when(F.size("polygons") > 0, area).otherwise(point)
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shape = F.when(geometry.isNotNull(), F.concat(F.lit('{"type":"'), geometry["type"], F.lit('","coordinates":'), geometry["coordinates"], F.lit("}"))).otherwise("null")
    facts = F.to_json(F.struct("site", "cell_id", clean(F.col("dbz")).alias("dbz"), "split_from", stamp.alias("valid_time")))
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'), facts, F.lit("}"))
    return cells.select("site", "cell_id", "split_from", lon.alias("lon"), lat.alias("lat"), clean(F.col("dbz")).alias("dbz"), stamp.alias("valid_time"), feature.alias("feature"))


def as_tracks(cells: DataFrame) -> DataFrame:
    """Tracked cells under the names that track scores read."""
    return cells.withColumnsRenamed({"cell_uid": "track_id", "family_uid": "family_id"})
