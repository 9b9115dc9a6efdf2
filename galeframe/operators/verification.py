"""Objects against point reports.

Objects and reports belong to a `site` (a report to every site that it is in range of, see `in_range`), and only those of
one site meet; scores have a row for each site. Rows with a null site, volume or place meet nothing. `within_minutes` goes
by time alone unless it is given columns.

Where cells multiply rows before a join, Spark's estimate of a table's size doesn't count the copies and would have millions
of them broadcast from the driver; such joins of `matched` and `inside` are always merged, so the driver holds no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galeframe.functions.geo import haversine_km, in_ring

MATCH_KM, WITHIN_MIN, SITE_KM = 15.0, 15, 140.0


def matched(objects: DataFrame, reports: DataFrame, km: float = MATCH_KM) -> DataFrame:
    """Pairs (obj, report_id) of one site and volume within some km; they meet in cells of that size and their neighbours."""
    size = km * 1000
    cell = lambda c: F.floor(F.col(c) / size)
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    o = objects.select("site", "obj", "vol", F.col("seed_x").alias("ox"), F.col("seed_y").alias("oy")).withColumns({"cx": cell("ox"), "cy": cell("oy")})
    r = reports.select("site", "report_id", "vol", "x", "y", F.explode(near).alias("i")).select("*", F.explode(near).alias("j"))
    r = r.withColumns({"cx": cell("x") + F.col("i"), "cy": cell("y") + F.col("j")}).drop("i", "j")
    gap = F.sqrt(F.pow(F.col("ox") - F.col("x"), 2) + F.pow(F.col("oy") - F.col("y"), 2))
    return o.join(r.hint("merge"), ["site", "vol", "cx", "cy"]).filter(gap <= size).select("site", "vol", "obj", "report_id")


def inside(rings: DataFrame, reports: DataFrame, km: float = MATCH_KM) -> DataFrame:
    """Pairs (obj, report_id) of a site and volume with the report in a ring (xs, ys) of the object; they meet in cells of some km."""
    size = km * 1000
    span = lambda c: F.explode(F.sequence(F.floor(F.array_min(c) / size), F.floor(F.array_max(c) / size)))
    o = rings.select("site", "obj", "vol", "xs", "ys", span("xs").alias("cx")).withColumn("cy", span("ys"))
    r = reports.select("site", "report_id", "vol", "x", "y").withColumns({"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)})
    return o.join(r.hint("merge"), ["site", "vol", "cx", "cy"]).filter(in_ring(F.col("x"), F.col("y"), F.col("xs"), F.col("ys"))).select("site", "vol", "obj", "report_id")


def matched_or_inside(objects: DataFrame, reports: DataFrame, rings: DataFrame, km: float = MATCH_KM) -> DataFrame:
    """Pairs of one site and volume within some km, or with the report inside a ring (site, obj, vol, xs, ys) of the object."""
    return matched(objects, reports, km).union(inside(rings, reports, km)).distinct()


def contingency(objects: DataFrame, reports: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per site: detected reports, hits, false alarms, POD, FAR and CSI; a ratio without a base is 0."""
    n = lambda df, name: df.groupBy("site").agg(F.count("*").alias(name))
    met = pairs.groupBy("site").agg(F.count_distinct("report_id").alias("detected"), F.count_distinct("obj").alias("hits"))
    out = n(objects, "objects").join(n(reports, "reports"), "site", "full").join(met, "site", "left").fillna(0, ["objects", "reports", "detected", "hits"])
    out = out.withColumn("false_alarms", F.col("objects") - F.col("hits"))
    over = lambda a, b: F.when(b == 0, F.lit(0e0)).otherwise(a / b)
    return out.withColumns({"pod": over(F.col("detected"), F.col("reports")), "far": over(F.col("false_alarms"), F.col("objects")), "csi": over(F.col("detected"), F.col("reports") + F.col("false_alarms"))})


def in_range(reports: DataFrame, sites: DataFrame, km: float = SITE_KM) -> DataFrame:
    """Reports (lat, lon) with each site (site, slat, slon) at most some km away; both meet in cells of two degrees."""
    reach = km / 111.0
    wide = F.least(F.lit(reach) / F.cos(F.radians(F.least(F.abs("slat") + reach, F.lit(89e0)))), F.lit(178e0))
    steps = lambda low, high: F.explode(F.sequence(F.floor(low / 2), F.floor(high / 2)))
    cells = sites.select("site", "slat", "slon", steps(F.col("slat") - reach, F.col("slat") + reach).alias("cy"), wide.alias("wide"))
    cells = cells.select("site", "slat", "slon", "cy", steps(F.col("slon") - F.col("wide"), F.col("slon") + F.col("wide")).alias("cx"))
    cells = cells.withColumn("cx", F.pmod("cx", F.lit(180))).distinct()
    rows = reports.withColumns({"cy": F.floor(F.col("lat") / 2), "cx": F.pmod(F.floor(F.col("lon") / 2), F.lit(180))})
    gap = haversine_km(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"))
    return rows.join(cells, ["cy", "cx"]).withColumn("site_km", gap).filter(F.col("site_km") <= km).drop("cy", "cx", "slat", "slon")


def within_minutes(volumes: DataFrame, reports: DataFrame, minutes: int = WITHIN_MIN, by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of volumes (v, vt) and reports (r, rt) at most some minutes apart: equal buckets of that length, or neighbours.

    All that are near in time meet; with `by` (such as site, reports as from `in_range`) only those that are equal there.
    """
    bucket = lambda c: F.floor(F.unix_timestamp(c) / (minutes * 60))
    spread = reports.withColumn("b", F.explode(F.sequence(bucket(F.col("rt")) - 1, bucket(F.col("rt")) + 1)))
    gap = F.abs(F.unix_timestamp("vt") - F.unix_timestamp("rt"))
    return volumes.withColumn("b", bucket(F.col("vt"))).join(spread, ["b", *by]).filter(gap <= minutes * 60).drop("b")


def pooled(objects: DataFrame, case: str, member: str, metric: Column) -> DataFrame:
    """A metric of each member, its mean in each case, and the mean of the cases: pooled, with the rows and the cases.

    Members without the metric (null) don't count, nor cases of only such."""
    per = objects.groupBy(case, member).agg(metric.alias("m"), F.count("*").alias("rows"))
    cases = per.groupBy(case).agg(F.avg("m").alias("m"), F.sum("rows").alias("rows"))
    return cases.agg(F.avg("m").alias("pooled"), F.sum("rows").alias("n"), F.count("*").alias("cases"))


def case_times(start: Column, end: Column, minutes: int = 30) -> tuple[Column, Column, Column, Column]:
    """Of a case: its first day, the times some minutes before and after it, and its midpoint (to the microsecond)."""
    a, b = F.unix_micros(start), F.unix_micros(end)
    wide = minutes * 60_000_000
    return F.date_trunc("day", start), F.timestamp_micros(a - wide), F.timestamp_micros(b + wide), F.timestamp_micros(a + F.floor((b - a) / 2).cast("long"))


def block_about(volumes: DataFrame, cases: DataFrame, size: int) -> DataFrame:
    """The `size` consecutive volumes (case_key, vol_time) about each case's midpoint; the earlier of two equally near."""
    from pyspark.sql import Window

    w = Window.partitionBy("case_key").orderBy("vol_time")
    rows = volumes.join(cases, "case_key").withColumn("rn", F.row_number().over(w))
    gap: Column = F.abs(F.unix_timestamp("vol_time") - F.unix_timestamp("mid"))
    centre = rows.groupBy("case_key").agg(F.min_by("rn", F.struct(gap, F.col("rn"))).alias("at"), F.max("rn").alias("n"))
    first = F.greatest(F.lit(1), F.least(F.col("at") - size // 2, F.col("n") - size + 1))
    return rows.join(centre, "case_key").filter((F.col("rn") >= first) & (F.col("rn") < first + size)).select("case_key", "vol_time", "rn")


def continuity(cells: DataFrame) -> DataFrame:
    """Per site: mean, median and share above a half of the overlap (shared cells by all cells) of families from volume to volume.

    `cells` has site, family, vol and a cell of its footprint in each row. A family is compared with where it was last seen.
    """
    from pyspark.sql import Window

    family = ["site", "family"]
    cells = cells.select(*family, "vol", "cell").distinct()
    sizes = cells.groupBy(*family, "vol").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*family).orderBy("vol")
    steps = sizes.withColumns({"before": F.lag("vol").over(w), "m": F.lag("n").over(w)}).filter("before IS NOT NULL")
    earlier = cells.join(steps.select(*family, F.col("before").alias("vol"), F.col("vol").alias("now")), [*family, "vol"]).select(*family, F.col("now").alias("vol"), "cell")
    both = earlier.join(cells, [*family, "vol", "cell"]).groupBy(*family, "vol").agg(F.count("*").alias("both"))
    iou = steps.join(both, [*family, "vol"], "left").select("site", (F.coalesce("both", F.lit(0)) / (F.col("n") + F.col("m") - F.coalesce("both", F.lit(0)))).alias("iou"))
    return iou.groupBy("site").agg(F.count("*").alias("n"), F.avg("iou").alias("mean_iou"), F.median("iou").alias("median_iou"), F.avg((F.col("iou") > 0.5).cast("double")).alias("over_half"))
