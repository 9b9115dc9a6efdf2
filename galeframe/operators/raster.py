"""Full-disk imagery: fixed-grid navigation, calibration, enhancement, frame selection and derived products."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the fixed grid: semi-axes (m), distance of the satellite (m), its longitude, pixels and their angle.
R_EQ, R_POL, H_M, LON0, SIZE = 6378137.0, 6356752.31414, 42164160.0, -75.0, 5424
STEP_RAD, FIRST_RAD = 0.000056, 0.151844
#: Linear calibration where none is supplied, and the anchors (Celsius, R, G, B) of the enhancement.
WARM_K, COLD_K = 340.349, 89.62
ANCHORS = ((-30, 0, 0, 255), (-40, 0, 255, 255), (-50, 0, 255, 0), (-60, 255, 255, 0), (-70, 255, 0, 0), (-80, 0, 0, 0), (-90, 255, 255, 255))


def scan_position(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """(row, column, visible) of a geodetic point; half-even rounding, clipped to the disk image."""
    phi = F.atan(F.lit((R_POL / R_EQ) ** 2) * F.tan(F.radians(lat)))
    e2 = (R_EQ**2 - R_POL**2) / R_EQ**2
    rc = F.lit(R_POL) / F.sqrt(1e0 - e2 * F.cos(phi) * F.cos(phi))
    d = F.radians(lon) - F.radians(F.lit(LON0))
    sx, sy, sz = F.lit(H_M) - rc * F.cos(phi) * F.cos(d), -rc * F.cos(phi) * F.sin(d), rc * F.sin(phi)
    visible = H_M * (H_M - sx) >= sy * sy + F.lit((R_EQ / R_POL) ** 2) * sz * sz
    across, up = F.asin(-sy / F.sqrt(sx * sx + sy * sy + sz * sz)), F.atan(sz / sx)
    index = lambda v: F.least(F.greatest(F.rint(v), F.lit(0e0)), F.lit(SIZE - 1e0)).cast("long")
    return index((FIRST_RAD - up) / STEP_RAD), index((across + FIRST_RAD) / STEP_RAD), visible


def mercator_latitude(row: Column, rows: int, south: float, north: float) -> Column:
    """Latitude of a row of an axis that is even in Mercator y: the first row lies on the northern parallel, the last on the southern."""
    y = lambda v: F.log(F.tan(F.lit(0.7853981633974483) + F.radians(v) / 2e0))
    top, low = y(F.lit(north)), y(F.lit(south))
    return F.degrees(2e0 * F.atan(F.exp(top - (top - low) * row / float(max(1, rows - 1)))) - F.lit(1.5707963267948966))


def kelvin(level: Column, table: Column | None = None) -> Column:
    """By a 256-entry table if it falls strictly throughout, else linearly."""
    linear = F.lit(WARM_K) + (F.lit(COLD_K) - F.lit(WARM_K)) * level / 255e0
    if table is None:
        return linear
    falls = F.forall(F.zip_with(F.slice(table, 1, 255), F.slice(table, 2, 255), lambda a, b: a > b), lambda x: x)
    return F.when((F.size(table) == 256) & falls, F.get(table, level.cast("int"))).otherwise(linear)


def enhanced(celsius: Column) -> tuple[Column, Column, Column]:
    """(R, G, B): grey from 40 down to -30 degrees, then colours between ANCHORS; fractions are cut off."""
    grey = F.floor(40e0 + (40e0 - F.greatest(F.least(celsius, F.lit(40e0)), F.lit(-30e0))) / 70e0 * 215e0)
    out = []
    for k in (1, 2, 3):
        colour: Column = F.lit(ANCHORS[-1][k])
        for a, b in reversed(list(zip(ANCHORS[:-1], ANCHORS[1:], strict=True))):
            part = F.floor(a[k] + (b[k] - a[k]) * (a[0] - celsius) / float(a[0] - b[0]))
            colour = F.when(celsius >= b[0], part).otherwise(colour)
        out.append(F.when(celsius >= -30e0, grey).otherwise(colour).cast("long"))
    return tuple(out)


def last_frames(frames: DataFrame, most: int = 18) -> DataFrame:
    """The newest frames by the time in their names; names without one count as oldest."""
    stamp = F.try_to_timestamp(F.regexp_extract("path", r"(\d{8}T\d{6}Z)", 1), F.lit("yyyyMMdd'T'HHmmss'Z'"))
    return frames.withColumn("frame_time", stamp).orderBy(F.col("frame_time").desc_nulls_last(), F.desc("path")).limit(most)


def gathered(pixels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Output cells (out_row, out_col) with the level of their source pixel in every frame; 0 where it is missing or null.

    `mapping` (row_no, col_no to out_row, out_col) is a fixed output grid; pixels are unique by frame and place. A frame
    that has all source pixels needs no more than the join with the grid; only others are filled.
    """
    found = pixels.join(mapping, ["row_no", "col_no"]).select("frame", "out_row", "out_col", F.coalesce("level", F.lit(0).cast("long")).alias("level"))
    cells = mapping.count()
    counts = pixels.select("frame").distinct().join(found.groupBy("frame").agg(F.count("*").alias("n")), "frame", "left")
    short = counts.filter(F.coalesce("n", F.lit(0)) < cells).select("frame")
    wanted = short.crossJoin(mapping.select("out_row", "out_col"))  # the output grid of each such frame
    missing = wanted.join(found, ["frame", "out_row", "out_col"], "left_anti").withColumn("level", F.lit(0).cast("long"))
    return found.unionByName(missing)


def with_frame_before(frames: DataFrame, value: str, before: str, block: int = 48) -> DataFrame:
    """`frames` (a row each) with the value of the frame before, however many lie between their numbers.

    Blocks of frames are windows of their own, so no task sees all; the first of a block takes the last of the nearest
    block before it, from a table with a row for each block. Null frames have none before.
    """
    rows = frames.withColumn("block", F.floor(F.col("frame") / block))
    w = Window.partitionBy("block").orderBy("frame")
    ends = rows.filter("frame IS NOT NULL").groupBy("block").agg(F.max_by(F.struct(value), "frame").alias("end"))
    ends = ends.select("block", F.lag("end").over(Window.orderBy("block")).alias("end"))  # a row for each day of 48 frames
    first = F.row_number().over(w) == 1
    out = rows.join(ends, "block", "left").withColumn(before, F.when(first, F.col(f"end.{value}")).otherwise(F.lag(value).over(w)))
    return out.drop("block", "end")


def cloud_products(pixels: DataFrame) -> DataFrame:
    """Per frame: coldest and warmest percentile, mean, share more than 8 K colder than the warm one, cooling since the frame before.

    Levels are whole numbers, so percentiles come from a histogram of them. Frames without the frame before have no cooling
    and no initiation; pixels with a null level don't count.
    """
    k = kelvin(F.col("level"))
    levels = pixels.filter("level IS NOT NULL").groupBy("frame", "level").agg(F.count("*").alias("pixels")).withColumn("k", k)
    share = lambda p: F.percentile("k", F.lit(p), F.col("pixels"))
    per = levels.groupBy("frame").agg(share(0.01).alias("cold_k"), share(0.95).alias("warm_k"), (F.sum(F.col("k") * F.col("pixels")) / F.sum("pixels")).alias("mean_k"), F.sum("pixels").alias("n"))
    count = lambda c: F.sum(F.when(c, F.col("pixels")).otherwise(0))
    cloudy = levels.join(per.select("frame", "warm_k"), "frame").groupBy("frame").agg((100e0 * count(F.col("k") < F.col("warm_k") - 8) / F.sum("pixels")).alias("cloud_pct"), count(F.col("k") - 273.15e0 <= -50).alias("deep"))
    out = with_frame_before(per.join(cloudy, "frame"), "cold_k", "cold_before")
    return out.withColumn("cooling", F.col("cold_before") - F.col("cold_k")).withColumn("initiation", F.coalesce(F.col("cooling") >= 4, F.lit(False))).drop("cold_before")


#: Bands of the differences, by name: the first less the second, in Kelvin.
DIFFERENCES = {"fog_btd": (13, 7), "split_window": (13, 15)}


def band_differences(pixels: DataFrame, differences: dict[str, tuple[int, int]] = DIFFERENCES) -> DataFrame:
    """Per frame the mean of each difference of two bands (frame, band, row_no, col_no, level) over the pixels that have both."""
    needed = sorted({b for pair in differences.values() for b in pair})
    place = pixels.filter(F.col("band").isin(needed)).groupBy("frame", "row_no", "col_no")
    bands = place.agg(*(F.avg(F.when(F.col("band") == b, kelvin(F.col("level")))).alias(f"k{b}") for b in needed))
    return bands.groupBy("frame").agg(*(F.avg(F.col(f"k{a}") - F.col(f"k{b}")).alias(name) for name, (a, b) in differences.items()))


def sun_elevation(lat: Column, lon: Column, day_of_year: Column, utc_hour: Column) -> Column:
    """Degrees above the horizon, from a mean declination and solar time."""
    tilt = F.radians(F.lit(-23.44e0) * F.cos(F.radians(360e0 / 365e0 * (day_of_year + 10e0))))
    angle = F.radians(15e0 * (utc_hour - 12e0) + lon)
    return F.degrees(F.asin(F.sin(F.radians(lat)) * F.sin(tilt) + F.cos(F.radians(lat)) * F.cos(tilt) * F.cos(angle)))


def albedo(reflectance: Column, elevation: Column) -> Column:
    """Reflectance by the cosine of the zenith angle; null with the sun under 5 degrees."""
    return F.when(elevation >= 5e0, reflectance / F.sin(F.radians(elevation)))


def plate_pixel(lon: Column, lat: Column, west: float, south: float, east: float, north: float, width: int, height: int) -> tuple[Column, Column]:
    """(x, y) of a point on an equirectangular crop."""
    return (lon - west) / (east - west) * width, (north - lat) / (north - south) * height


def stale_loops(frames: DataFrame, key: str, at: str, now: Column, minutes: int = 75) -> DataFrame:
    """Whether the newest frame of each loop is older than some minutes."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.max(F.col(at).cast("timestamp")))
    return frames.groupBy(key).agg((age > minutes * 60_000_000).alias("stale"))


def manifest(frames: DataFrame, bounds: tuple[float, float, float, float]) -> DataFrame:
    """One JSON text: bounds, palette and the frames (path, frame_time) in time order, their files named by time."""
    name = F.concat(F.date_format("frame_time", "yyyyMMdd'T'HHmmss'Z'"), F.lit(".png"))
    anchors = F.array(*(F.array(*(F.lit(int(v)) for v in a)) for a in ANCHORS))
    rows = F.sort_array(F.collect_list(F.struct("frame_time", name.alias("file"))))
    files = F.transform(rows, lambda r: r["file"])
    return frames.filter("frame_time IS NOT NULL").agg(F.to_json(F.struct(F.array(*map(F.lit, bounds)).alias("bounds"), anchors.alias("palette"), files.alias("frames"))).alias("body"))


def mercator_height(width: int, west: float, south: float, east: float, north: float) -> int:
    """Rows that give square pixels on a Mercator map."""
    y = lambda v: math.log(math.tan(math.pi / 4 + math.radians(v) / 2))
    return round(width * (y(north) - y(south)) / math.radians(east - west))


def whole_frames(frames: DataFrame, size: int = SIZE) -> DataFrame:
    """Frames (height, width) of the full size; others go, those of unknown size among them."""
    return frames.filter((F.col("height") == size) & (F.col("width") == size))


def calibrated(pixels: DataFrame, sidecars: DataFrame) -> DataFrame:
    """`pixels` (path, level) with kelvin by the table (path, kelvin_table) of the same name before the ending, else linearly.

    Tables are a row for each frame; of several with one name that of the least path counts.
    """
    stem = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")
    tables = sidecars.groupBy(stem(F.col("path")).alias("stem")).agg(F.min_by("kelvin_table", "path").alias("kelvin_table"))
    out = pixels.withColumn("stem", stem(F.col("path"))).join(tables, "stem", "left")
    linear, by_table = kelvin(F.col("level")), kelvin(F.col("level"), F.col("kelvin_table"))
    return out.withColumn("kelvin", F.coalesce(by_table, linear)).drop("stem", "kelvin_table")
