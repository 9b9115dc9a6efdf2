"""Queries on telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.operators import telemetry as M
from galeframe.plans.fixtures import view, with_views
from galeframe.plans.registry import query

BOUNDS = [50, 100, 250, 500]
_DELTA = with_views("metric") + ", d AS (SELECT *, CASE WHEN lag(counter) OVER w IS NULL THEN NULL WHEN counter >= lag(counter) OVER w THEN counter - lag(counter) OVER w ELSE counter END AS delta FROM metric WINDOW w AS (PARTITION BY name ORDER BY metric_id))"
_HIST = with_views("metric") + ", b AS (SELECT name, le, count(*) FILTER (WHERE value <= le) AS n, count(*) AS total FROM metric, (VALUES (50e0), (100e0), (250e0), (500e0)) t(le) GROUP BY name, le)"


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.increases(view(spark, sf_dir, "metric"), ["name"], "metric_id", "counter")


@query(_DELTA + " SELECT name, date_trunc('hour', ts) AS hour, coalesce(sum(delta), 0)::BIGINT AS increase FROM d GROUP BY ALL")
def metric_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas(spark, sf_dir).groupBy("name", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.coalesce(F.sum("delta"), F.lit(0)).cast("bigint").alias("increase"))


@query(_DELTA + " SELECT site, round(sum(value) / greatest(sum(delta), 1e-4), 9) AS ratio FROM d GROUP BY site")
def metric_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas(spark, sf_dir).groupBy("site").agg(F.round(M.ratio(F.sum("value"), F.sum("delta").cast("double")), 9).alias("ratio"))


@query(_HIST + " SELECT name, le, n, total FROM b")
def metric_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.cumulative_buckets(view(spark, sf_dir, "metric"), ["name"], "value", BOUNDS)


_QUANTILES = " UNION ALL ".join(f"SELECT name, {q}e0 AS q, round(coalesce(min(CASE WHEN n >= total * {q}e0 AND below < total * {q}e0 THEN low + (le - low) * (total * {q}e0 - below) / (n - below) END), max(le)), 9) AS quantile FROM k GROUP BY name" for q in (0.05, 0.5, 0.95))


@query(_HIST + ", k AS (SELECT *, coalesce(lag(le) OVER w, 0e0) AS low, coalesce(lag(n) OVER w, 0) AS below FROM b WINDOW w AS (PARTITION BY name ORDER BY le)) " + _QUANTILES)
def metric_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = M.cumulative_buckets(view(spark, sf_dir, "metric"), ["name"], "value", BOUNDS)
    parts = [M.histogram_quantile(b, ["name"], q).select("name", F.lit(q).alias("q"), F.round("quantile", 9).alias("quantile")) for q in (0.05, 0.5, 0.95)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(_DELTA + ", b AS (SELECT name, 100e0 - 100e0 * sum(delta) / (max(metric_id) - min(metric_id)) AS busy FROM d GROUP BY name), u AS (SELECT name, (1e0 - min(value) / max(value)) * 100e0 AS used, max(value) - min(value) AS free FROM metric GROUP BY name) SELECT name, round(busy, 9) AS busy_pct, round(used, 9) AS used_pct, round(free, 9) AS free FROM b JOIN u USING (name)")
def metric_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = view(spark, sf_dir, "metric")
    busy = M.busy_percent(m, ["name"], "metric_id", "counter", "metric_id")
    both = busy.join(M.used_and_free(m, ["name"], F.min("value"), F.max("value")), "name")
    return both.select("name", *(F.round(c, 9).alias(c) for c in ("busy_pct", "used_pct", "free")))


_STATUS = "CASE WHEN user_id % 13 = 0 THEN 'down' WHEN event_id % 400 < 120 THEN 'ok (grace)' WHEN event_id % 17 = 0 THEN 'disconnected' WHEN (event_id * 37) % 200000 > 120000 THEN 'stalled' WHEN value / 10 > 30 THEN 'no-products' ELSE 'ok' END"


@query(f"SELECT {_STATUS} AS status, count(*) AS n FROM events GROUP BY 1")
def status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    socket = F.when(F.col("event_id") % 17 != 0, (F.col("event_id") * 37) % 200000)
    status = M.receiver_status(F.col("user_id") % 13 != 0, F.col("event_id") % 400, socket, F.col("value") / 10)
    return e.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


_LINE = "CASE WHEN event_id % 4 = 0 THEN concat('tick ', CAST(event_id AS VARCHAR(12))) WHEN event_id % 9 = 1 THEN concat('[monitor] gain: -', CAST(event_id % 50 AS VARCHAR(4)), '.5') ELSE concat('[monitor] gain: ', CAST(event_id % 50 AS VARCHAR(4)), '.25, vit(avg):  ', CAST(event_id % 300 AS VARCHAR(4)), ', omega: ', CAST(event_id % 7 AS VARCHAR(4)), CASE WHEN event_id % 5 = 0 THEN '.1.2' ELSE '' END) END"
_MONITOR = f"WITH l AS (SELECT user_id, event_id, {_LINE} AS line FROM events), m AS (SELECT user_id, arg_max(line, event_id) AS line FROM l WHERE contains(line, '[monitor]') GROUP BY user_id)"


@query(_MONITOR + r" SELECT user_id, try_cast(regexp_extract(line, 'gain:\s*([-0-9.]+)', 1) AS DOUBLE) AS gain, try_cast(regexp_extract(line, 'vit\(avg\):\s*([-0-9.]+)', 1) AS DOUBLE) AS vit, try_cast(regexp_extract(line, 'omega:\s*([-0-9.]+)', 1) AS DOUBLE) AS omega FROM m")
def log_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of each source's last line of its monitor."""
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("user_id", "event_id", f"{_LINE} AS line")
    return M.scraped(lines, "user_id", "event_id", "line", "[monitor]", {"gain": "gain", "vit": r"vit\(avg\)", "omega": "omega"})


_ALLOWED = "WITH RECURSIVE e AS (SELECT DISTINCT user_id, floor(epoch(ts))::BIGINT AS t FROM events WHERE ts IS NOT NULL), r AS (SELECT user_id, min(t) AS t FROM e GROUP BY user_id UNION ALL SELECT r.user_id, min(e.t) FROM r JOIN e ON e.user_id IS NOT DISTINCT FROM r.user_id AND e.t >= r.t + 36000 GROUP BY r.user_id)"


@query(_ALLOWED + " SELECT user_id, t FROM r")
def restart_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restarts that a cooldown of 10 hours allows each user; tests compare with a plain loop."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))
    return M.allowed_restarts(e, ["user_id"], "t", 36_000)
