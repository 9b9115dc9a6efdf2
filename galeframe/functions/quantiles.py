"""Quantiles of groups of any size, from counts that tasks add up before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stepped_quantiles(rows: DataFrame, by: list[str], value: Column, shares: dict[str, float], step: float) -> DataFrame:
    """Per group a column of each share (name: share): the interpolated quantile of the values rounded to `step`.

    So it is exact for rounded values and within half a step for others. A group's memory is its number of different
    steps, not of rows. Null and NaN values don't count; a group of none has nulls.
    """
    rounded = F.round(value / step).cast("long")
    counts = rows.select(*by, F.when(value.isNotNull() & ~F.isnan(value), rounded).alias("k")).groupBy(*by, "k").agg(F.count("*").alias("n"))
    found = {name: F.percentile("k", F.lit(share), F.when(F.col("k").isNull(), 1).otherwise(F.col("n"))) * step for name, share in shares.items()}
    return counts.groupBy(*by).agg(*(c.alias(n) for n, c in found.items()))


def exact_quantiles(rows: DataFrame, by: list[str], value: Column, shares: dict[str, float], step: float) -> DataFrame:
    """Per group a column of each share (name: share): the interpolated quantile of all values; `step` has no part in the result.

    `rows` are read twice and must have the same values both times: steps are counted first, which tells the ones that a
    quantile's two neighbours stand in; then only the values in these are counted one by one. So what one task sorts is a
    group's different steps, or the different values of a step. The steps in question, at most two for each group and
    share, are sent to all tasks. Null and NaN values don't count; a group of none has no row.
    """
    known = rows.select(*by, value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v")).withColumn("k", F.floor(F.col("v") / step))
    before = lambda keys, at: F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = known.groupBy(*by, "k").agg(F.count("*").alias("n"))
    steps = steps.select(*by, "k", "n", before(by, "k").alias("below"), F.sum("n").over(Window.partitionBy(*by)).alias("total"))

    def ends(name: str, share: float) -> list[Column]:
        place = F.lit(float(share)) * (F.col("total") - 1)
        return [F.struct(F.lit(name).alias("name"), end(place).alias("rank"), (place - F.floor(place)).alias("part")) for end in (F.floor, F.ceil)]

    ranks = F.explode(F.array(*(x for name, share in shares.items() for x in ends(name, share)))).alias("r")
    wanted = steps.select(*by, "k", "n", "below", ranks).select(*by, "k", "n", "below", "r.*").filter("rank >= below AND rank < below + n")
    wanted = wanted.select(*(F.col(c).alias(f"of_{c}") for c in (*by, "k")), "name", (F.col("rank") - F.col("below")).alias("rank"), "part")
    here = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*by, "k")]
    near = known.join(F.broadcast(wanted), here, "left_semi").groupBy(*by, "k", "v").agg(F.count("*").alias("n")).withColumn("below", before([*by, "k"], "v"))
    found = near.join(F.broadcast(wanted), here).filter("rank >= below AND rank < below + n")
    low, high = F.min("v"), F.max("v")
    each = found.groupBy(*by, "name").agg(F.when(low == high, low).otherwise(low + (high - low) * F.max("part")).alias("q"))
    return each.groupBy(*by).agg(*(F.max(F.when(F.col("name") == name, F.col("q"))).alias(name) for name in shares))
