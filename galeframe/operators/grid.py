"""Polar gates to a sparse Cartesian voxel table, and what is read from its columns. An absent row is no echo."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galeframe.functions.geo import beam_height_m, ground_range_m, to_dbz, to_linear
from galeframe.functions.quantiles import exact_quantiles
from galeframe.sources.shared import kept

#: Steps in which differences are counted to find their quantiles; these don't depend on it.
BIAS_STEP = 0.001


@dataclass(frozen=True)
class GridParams:
    h_m: float = 1000.0
    v_m: float = 500.0
    range_m: float = 150_000.0
    top_m: float = 15_000.0
    seed_dbz: float = 40.0
    base_dbz: float = 30.0
    echo_dbz: float = 18.3


GRID = GridParams()


def located(gates: DataFrame, p: GridParams = GRID) -> DataFrame:
    """Gates with their voxel (iz, iy, ix); those without a value or outside the box go."""
    z = beam_height_m(F.col("range_m"), F.col("el_deg"))
    s = ground_range_m(F.col("range_m"), F.col("el_deg"))
    out = gates.filter(F.col("dbz").isNotNull() & ~F.isnan("dbz")).withColumns({"z": z, "s": s})
    out = out.withColumns({"x": F.col("s") * F.sin(F.radians("az_deg")), "y": F.col("s") * F.cos(F.radians("az_deg"))})
    out = out.filter((F.abs("x") < p.range_m) & (F.abs("y") < p.range_m) & (F.col("z") >= 0) & (F.col("z") < p.top_m))
    cell = lambda c, size: F.floor(c / size).cast("long")
    return out.withColumns({"iz": cell(F.col("z"), p.v_m), "iy": cell(F.col("y") + p.range_m, p.h_m), "ix": cell(F.col("x") + p.range_m, p.h_m)})


def grid_volumes(gates: DataFrame, p: GridParams = GRID) -> DataFrame:
    """One row per voxel with gates: their maximum, number and mean in linear units."""
    keys = ["site", "vol", "iz", "iy", "ix"]
    mean = to_dbz(F.avg(to_linear(F.col("dbz"))))
    return located(gates, p).groupBy(*keys).agg(F.max("dbz").alias("dbz_max"), F.count("*").alias("n_gates"), mean.alias("dbz_cal"))


def fill_gaps(voxels: DataFrame, value: str) -> DataFrame:
    """Layers between two sampled ones of a column, interpolated; nothing beyond either end. `filled` marks them."""
    w = Window.partitionBy("site", "vol", "iy", "ix").orderBy("iz")
    ends = voxels.select("site", "vol", "iy", "ix", "iz", F.col(value).alias("v"), F.lead("iz").over(w).alias("iz2"), F.lead(value).over(w).alias("v2"))
    gaps = ends.filter("iz2 - iz > 1").withColumn("k", F.explode(F.sequence(F.col("iz") + 1, F.col("iz2") - 1)))
    filled = gaps.select("site", "vol", "iy", "ix", F.col("k").alias("iz"), (F.col("v") + (F.col("v2") - F.col("v")) * (F.col("k") - F.col("iz")) / (F.col("iz2") - F.col("iz"))).alias("v"), F.lit(True).alias("filled"))
    return ends.select("site", "vol", "iy", "ix", "iz", "v", F.lit(False).alias("filled")).unionByName(filled)


def column_products(layers: DataFrame, p: GridParams = GRID) -> DataFrame:
    """Column maximum, echo top and base in km, and how many layers reach the seed level; of columns (v, iz)."""
    echo = F.when(F.col("v") >= p.echo_dbz, F.col("iz"))
    return layers.groupBy("site", "vol", "iy", "ix").agg(
        F.max("v").alias("colmax"),
        (F.max(echo) * p.v_m / 1000e0).alias("etop_km"),
        (F.min(echo) * p.v_m / 1000e0).alias("ebase_km"),
        F.count(F.when(F.col("v") >= p.seed_dbz, 1)).alias("nlev_seed"),
    )


def bin_bias(voxels: DataFrame) -> DataFrame:
    """How far the maximum of a voxel's gates lies above their linear mean, where there are several.

    The differences are written once: means of doubles may differ in their last bits when they are worked out again.
    """
    several, strong = F.col("n_gates") > 1, (F.col("n_gates") > 1) & (F.col("dbz_max") >= 40)
    rows = kept(voxels.select("site", several.alias("several"), strong.alias("strong"), (F.col("dbz_max") - F.col("dbz_cal")).alias("d")), "bin-bias")
    several, strong = F.when(F.col("several"), F.col("d")), F.when(F.col("strong"), F.col("d"))
    sums = rows.groupBy("site").agg(
        F.count("*").alias("n_voxels"),
        (100e0 * F.avg(F.when(F.col("several"), 1e0).otherwise(0e0))).alias("multi_pct"),
        F.avg(several).alias("mean_db"),
        F.max(several).alias("max_db"),
        F.avg(strong).alias("mean_db_40"),
    )
    quantiles = exact_quantiles(rows, ["site"], several, {"median_db": 0.5, "p95_db": 0.95}, BIAS_STEP)
    both = sums.join(quantiles.withColumnRenamed("site", "of"), F.col("site").eqNullSafe(F.col("of")), "left").drop("of")
    return both.select("site", "n_voxels", "multi_pct", "mean_db", "median_db", "p95_db", "max_db", "mean_db_40")
