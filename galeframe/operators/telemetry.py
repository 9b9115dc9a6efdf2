"""Counters, ratios, histograms and states of telemetry."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def increases(samples: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """`samples` with `delta` since the sample before; after a reset the value itself, for the first one null."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(value).over(w)
    return samples.withColumn("delta", F.when(before.isNull(), None).when(F.col(value) >= before, F.col(value) - before).otherwise(F.col(value)))


def cumulative_buckets(samples: DataFrame, keys: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Of each key and bound `le`: how many values are at most it. All bounds come from one pass over the samples."""
    counts = [F.count(F.when(F.col(value) <= b, 1)).alias(str(i)) for i, b in enumerate(bounds)]
    wide = samples.groupBy(*keys).agg(F.count("*").alias("total"), *counts)
    rows = F.array(*(F.struct(F.lit(float(b)).alias("le"), F.col(str(i)).alias("n")) for i, b in enumerate(bounds)))
    return wide.select(*keys, "total", F.inline(rows))


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """The q-quantile of cumulative buckets (le, n, total), linear within a bucket; above the last bound, that bound."""
    w = Window.partitionBy(*keys).orderBy("le")
    low, below = F.coalesce(F.lag("le").over(w), F.lit(0e0)), F.coalesce(F.lag("n").over(w), F.lit(0))
    rank = F.col("total") * F.lit(q)
    rows = buckets.withColumns({"low": low, "below": below, "rank": rank})
    at = F.col("low") + (F.col("le") - F.col("low")) * (F.col("rank") - F.col("below")) / (F.col("n") - F.col("below"))
    inside = F.when((F.col("n") >= F.col("rank")) & (F.col("below") < F.col("rank")), at)
    return rows.groupBy(*keys).agg(F.coalesce(F.min(inside), F.max("le")).alias("quantile"))


def ratio(top: Column, bottom: Column, least: float = 1e-4) -> Column:
    return top / F.greatest(bottom, F.lit(least))


def receiver_status(up: Column, age_s: Column, socket_ms: Column, product_min: Column) -> Column:
    """The first that holds: down, just started, no socket, silent socket, no products, ok."""
    return (
        F.when(~up, "down")
        .when(age_s < 120, "ok (grace)")
        .when(socket_ms.isNull(), "disconnected")
        .when(socket_ms > 120_000, "stalled")
        .when(product_min > 30, "no-products")
        .otherwise("ok")
    )


def allowed_restarts(events: DataFrame, keys: list[str], time: str, cooldown_s: int = 300) -> DataFrame:
    """Those events that lie a cooldown or more after the last allowed one of their key; without a time, none.

    Each key's times stream in order through one task, which holds its last allowed time only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last = None
        for batch in batches:
            times, keep = batch.column(time).to_pylist(), []
            owners = zip(*(batch.column(k).to_pylist() for k in keys), strict=True) if keys else [()] * len(times)
            for i, (own, t) in enumerate(zip(owners, times, strict=True)):
                if own != key or t - last >= cooldown_s:
                    keep.append(i)
                    key, last = own, t
            yield batch.take(pa.array(keep, type=pa.int64()))

    rows = events.select(*keys, F.col(time).cast("long").alias(time)).filter(F.col(time).isNotNull())
    rows = rows.distinct() if cooldown_s > 0 else rows
    dealt = rows.repartition(*keys) if keys else rows.repartition(1)
    return dealt.sortWithinPartitions(*keys, time).mapInArrow(run, rows.schema)


def socket_age(text: Column) -> Column:
    """Milliseconds since a socket last received, from a listing; null without a socket."""
    return F.nullif(F.regexp_extract(text, r"lastrcv:(\d+)", 1), F.lit("")).cast("long")


def scraped(lines: DataFrame, source: str, order: str, line: str, marker: str, keys: dict[str, str]) -> DataFrame:
    """Of each source's last line that holds a marker, the numbers behind some keys (name: pattern), as in `key: -1.5`.

    A key that isn't there, or whose number doesn't read, is null; a source without such a line has no row."""
    marked = lines.filter(F.contains(F.col(line), F.lit(marker)))
    last = marked.groupBy(source).agg(F.max_by(line, order).alias("last"))
    number = lambda pattern: F.regexp_extract("last", rf"{pattern}:\s*([-0-9.]+)", 1).try_cast("double")
    return last.select(source, *(number(p).alias(n) for n, p in keys.items()))


def busy_percent(samples: DataFrame, keys: list[str], order: str, counter: str, seconds: str) -> DataFrame:
    """100 less the share of idle seconds: the counter's increase by the time between samples, averaged over each key's counters."""
    per = increases(samples, keys, order, counter).groupBy(*keys).agg(F.sum("delta").alias("idle"), (F.max(seconds) - F.min(seconds)).alias("s"))
    return per.select(*keys, (100e0 - 100e0 * F.col("idle") / F.nullif(F.col("s"), F.lit(0))).alias("busy_pct"))


def used_and_free(samples: DataFrame, keys: list[str], free: Column, whole: Column) -> DataFrame:
    """Per cent in use, and what is free, by aggregates of a capacity; a capacity of 0 gives null."""
    return samples.groupBy(*keys).agg(((1e0 - free / F.nullif(whole, F.lit(0e0))) * 100e0).alias("used_pct"), (whole - free).alias("free"))


def deliveries(messages: DataFrame) -> DataFrame:
    """`messages` (unit_id, at) with how often their unit has been delivered by then."""
    return messages.withColumn("delivery", F.row_number().over(Window.partitionBy("unit_id").orderBy("at")))
