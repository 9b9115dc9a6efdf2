"""Streaming queries: tables are replayed as streams, in several batches, and the results read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.operators.alerts import segments
from galeframe.operators.tracker import track
from galeframe.plans.alerts import HAZARDS
from galeframe.plans.fixtures import VIEWS, view, with_views
from galeframe.plans.registry import query
from galeframe.sources.manifest import Published
from galeframe.sources.shared import kept, latest, new_folder, put_batch, replace_table
from galeframe.streaming import hazards as H
from galeframe.streaming import live as S


def replayed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a stream of its table's files."""
    table, columns = VIEWS[name]
    path = f"{sf_dir}/{table}.parquet"
    kind = spark.read.parquet(path).schema
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 4).parquet(f"{sf_dir}/{table[:-1]}[{table[-1]}].parquet")
    return stream.selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def finished(stream: DataFrame, sink, mode: str, where: str) -> None:
    q = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", f"{where}-offsets").trigger(availableNow=True).start()
    q.awaitTermination()


def cells(obs: DataFrame) -> DataFrame:
    last = F.max_by(F.struct(F.col("seed_x").alias("x"), F.col("seed_y").alias("y"), "area", "dbz"), "obs_id").alias("s")
    one = obs.groupBy((F.col("track_id") % 4).alias("site"), (F.col("vol") * 300).alias("t"), F.col("track_id").alias("cell_id")).agg(last)
    return one.select("site", "t", "cell_id", "s.*")


@query(with_views("flash") + ", w AS (SELECT satellite, energy, unnest(range(0, 3)) AS k, time_bucket(INTERVAL 10 MINUTE, flash_time) AS b FROM flash) SELECT b - to_minutes(k * 10) AS start, satellite, count(*) AS n, max(energy) AS max_energy FROM w GROUP BY ALL")
def stream_flash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = new_folder(spark, "flash-windows")
    finished(S.flash_windows(replayed(spark, sf_dir, "flash")), replace_table(where), "complete", where)
    return latest(spark, where).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(with_views("unit") + ", p AS (SELECT DISTINCT json_extract_string(body, '$.site') AS site, (json_extract_string(body, '$.volume_epoch'))::BIGINT AS volume_epoch, (json_extract_string(body, '$.vcp'))::INT AS vcp FROM unit WHERE json_valid(body)) SELECT * FROM p WHERE volume_epoch % 700 <> 0")
def stream_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "units")
    fails = lambda units: units.withColumn("failed", F.col("volume_epoch") % 700 == 0)
    finished(replayed(spark, sf_dir, "unit"), S.unit_sink(spark, root, fails), "append", root)
    return Published(spark, root).table("done").select("site", "volume_epoch", "vcp")


_RETRY = with_views("unit") + ", p AS (SELECT DISTINCT json_extract_string(body, '$.site') AS site, (json_extract_string(body, '$.volume_epoch'))::BIGINT AS volume_epoch FROM unit WHERE json_valid(body)), q AS (SELECT *, (volume_epoch // 300) % 5 AS bad FROM p)"


@query(_RETRY + " SELECT site, volume_epoch, least(bad + 1, 3)::INTEGER AS delivery, bad >= 3 AS dead FROM q")
def stream_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units over several files and batches, of which many fail in their first deliveries: three of five work in the end."""
    root, table = new_folder(spark, "retries"), new_folder(spark, "unit-files")
    view(spark, sf_dir, "unit").repartitionByRange(4, "unit_id").write.parquet(table)
    fails = lambda units: units.withColumn("failed", F.col("delivery") <= F.floor(F.col("volume_epoch") / 300) % 5)
    sink = S.unit_sink(spark, root, fails, idle_s=0)
    source = spark.readStream.schema("unit_id bigint, body string").option("maxFilesPerTrigger", 1).parquet(table)
    finished(source, sink, "append", root)
    for n in range(10, 12):  # batches without new rows, as a later trigger brings them
        sink(spark.createDataFrame([], "unit_id bigint, body string"), n)
    tables = Published(spark, root)
    own = lambda df, dead: df.select("site", "volume_epoch", "delivery", F.lit(dead).alias("dead"))
    return own(tables.table("done"), False).unionByName(own(tables.table("dead"), True))


_ORDER = "PARTITION BY key ORDER BY seq"
_EVENTS = HAZARDS + (
    f", p AS (SELECT *, coalesce(sum(gone::INT) OVER ({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life, coalesce(lag(NOT gone) OVER ({_ORDER}), false) AS active, lag(ugc) OVER ({_ORDER}) AS last_ugc FROM h)"
    ", q AS (SELECT *, last_value(CASE WHEN NOT gone THEN ring END IGNORE NULLS) OVER (PARTITION BY key, life ORDER BY seq ROWS UNBOUNDED PRECEDING) AS carried FROM p WHERE active OR NOT gone)"
)


@query(_EVENTS + " SELECT key, CASE WHEN gone THEN 'removed' WHEN action = 'NEW' AND NOT active THEN 'new' ELSE 'update' END AS kind, seq, pos, CASE WHEN gone THEN last_ugc ELSE ugc END AS ugc, carried AS ring FROM q")
def stream_hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the hazard stream: what each segment changes, with the zones and polygon then in force."""
    where = new_folder(spark, "hazards")
    rows = segments(replayed(spark, sf_dir, "bulletin")).select("key", F.col("bulletin_id").alias("seq"), "pos", "action", F.array_join("ugc", ",").alias("ugc"), F.to_json("poly.ring").alias("ring"))
    finished(S.hazard_events(rows), put_batch(where), "append", where)
    return S.last_events(spark.read.parquet(where))


@query()
def storm_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch tracker; tests compare it with the stream and with exact lifecycles."""
    return track(cells(view(spark, sf_dir, "obs")))


@query()
def stream_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    where, table = new_folder(spark, "tracks"), new_folder(spark, "track-cells")
    source = cells(view(spark, sf_dir, "obs"))
    source.write.parquet(table)
    finished(S.tracked(spark.readStream.schema(source.schema).parquet(table)), put_batch(where), "append", where)
    return spark.read.parquet(where).drop("batch")


#: Segments by the time of their bulletins; a hazard ends by removal, or at its end before the next segment.
_BY_TIME = HAZARDS + (
    ", t AS (SELECT h.*, 1704067200 + (h.seq // 8) * 60 AS sent, epoch(end_time)::BIGINT AS ends FROM h JOIN seg ON seg.bulletin_id = h.seq), mark AS (SELECT max(sent) - 1830 AS w FROM t)"
    ", i AS (SELECT t.*, w, lead(sent) OVER k AS next_at, lag(gone) OVER k AS was_gone, lag(ends) OVER k AS was_end FROM t, mark WHERE sent <= w WINDOW k AS (PARTITION BY key ORDER BY sent, seq, pos))"
    ", j AS (SELECT *, NOT coalesce(was_gone, true) AND coalesce(was_end > sent, true) AS active FROM i)"
    ", l AS (SELECT *, sum((NOT active)::INT) OVER (PARTITION BY key ORDER BY sent, seq, pos) AS life FROM j)"
    ", q AS (SELECT *, lag(ugc) OVER (PARTITION BY key ORDER BY sent, seq, pos) AS last_ugc, last_value(CASE WHEN NOT gone THEN ring END IGNORE NULLS) OVER (PARTITION BY key, life ORDER BY sent, seq, pos ROWS UNBOUNDED PRECEDING) AS carried FROM l)"
    ", e AS (SELECT key, CASE WHEN gone THEN 'removed' WHEN action = 'NEW' AND NOT active THEN 'new' ELSE 'update' END AS kind, seq, pos, CASE WHEN gone THEN last_ugc ELSE ugc END AS ugc, carried AS ring FROM q WHERE active OR NOT gone"
    " UNION ALL SELECT key, 'expired', seq, pos, ugc, carried FROM q WHERE NOT gone AND ends <= coalesce(next_at, w))"
)


@query(_BY_TIME + " SELECT key, kind, seq, pos, ugc, ring FROM e")
def stream_hazard_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hazards by the bulletins' own clock: several files and batches, out of order, ended by the watermark."""
    where, table = new_folder(spark, "hazard-times"), new_folder(spark, "segment-files")
    at = F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("bulletin_id") / 8) * 60)
    rows = segments(view(spark, sf_dir, "bulletin")).select("key", F.col("bulletin_id").alias("seq"), "pos", "action", F.array_join("ugc", ",").alias("ugc"), F.to_json("poly.ring").alias("ring"), at.alias("at"), F.col("end_time").alias("ends"))
    # Files come one after another, overlap by some minutes, and have their rows in any order.
    rows = kept(rows, "rows")  # ranges are found in a pass of their own, which shouldn't parse all texts once more
    parts = rows.repartitionByRange(4, F.col("seq") + F.pmod(F.xxhash64("seq"), F.lit(64))).withColumn("part", F.spark_partition_id())
    parts = kept(parts, "segments")
    for i in range(4):
        parts.filter(F.col("part") == i).drop("part").coalesce(1).sortWithinPartitions(F.xxhash64("seq")).write.mode("append").parquet(table)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(table)
    with H.state_in_rocksdb(spark):
        finished(H.hazards_by_time(stream, "1830 seconds"), put_batch(where), "append", where)
    return spark.read.parquet(where).drop("batch")
