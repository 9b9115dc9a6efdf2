"""Counters, gauges and cumulative buckets of streams, from what Spark observes while it runs them.

`observed` counts a stream's rows, and those that meet named conditions, inside the batch that is run anyway; a listener adds
up the counts of all batches, the times that batches took, and the last rates. Nothing is computed twice and no row is
collected. A batch that runs again is counted again, as its work is done again.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

BUCKETS = (0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 300.0, float("inf"))
METRIC = "name string, kind string, le double, value double"


def observed(stream: DataFrame, name: str, counted: dict[str, Column] | None = None) -> DataFrame:
    """`stream` whose rows, and those that meet each condition, are counted as `<name>_rows` and `<name>_<condition>`."""
    extra = [F.count(F.when(c, 1)).alias(f"{name}_{k}") for k, c in (counted or {}).items()]
    return stream.observe(name, F.count(F.lit(1)).alias(f"{name}_rows"), *extra)


class Recorder(StreamingQueryListener):
    """Adds up the progress of all queries while it listens."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.lock = spark, threading.Lock()
        self.totals: dict[str, float] = {"batches": 0}
        self.gauges: dict[str, float] = {}
        self.buckets, self.seconds = [0] * len(BUCKETS), 0.0

    def onQueryStarted(self, event) -> None: ...  # noqa: N802

    def onQueryIdle(self, event) -> None: ...  # noqa: N802

    def onQueryTerminated(self, event) -> None: ...  # noqa: N802

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self.lock:
            for row in p.observedMetrics.values():
                for name, value in row.asDict().items():
                    self.totals[name] = self.totals.get(name, 0) + value
            if p.numInputRows:
                self.totals["batches"] += 1
                took = p.batchDuration / 1000
                self.seconds += took
                self.buckets = [n + (took <= le) for n, le in zip(self.buckets, BUCKETS, strict=True)]
                self.gauges["rows_per_second"] = p.processedRowsPerSecond

    def rows(self) -> list[dict]:
        with self.lock:
            out = [(f"{n}_total", "counter", None, float(v)) for n, v in self.totals.items()]
            out += [(n, "gauge", None, float(v)) for n, v in self.gauges.items()]
            out += [("batch_seconds_bucket", "histogram", le, float(n)) for le, n in zip(BUCKETS, self.buckets, strict=True)]
            out += [("batch_seconds_count", "histogram", None, float(self.totals["batches"])), ("batch_seconds_sum", "histogram", None, self.seconds)]
        return [dict(zip([f.split()[0] for f in METRIC.split(", ")], r, strict=True)) for r in out]

    def write(self, path: str) -> None:
        """Append the present values to a table."""
        self.spark.createDataFrame([tuple(r.values()) for r in self.rows()], METRIC).withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


@contextlib.contextmanager
def recorded(spark: SparkSession) -> Iterator[Recorder]:
    """A recorder of the streams that run meanwhile; at the end all their progress has reached it."""
    recorder = Recorder(spark)
    spark.streams.addListener(recorder)
    try:
        yield recorder
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        spark.streams.removeListener(recorder)
