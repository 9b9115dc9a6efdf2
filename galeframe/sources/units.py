"""Work units, retries, idempotent inserts and completed volumes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "site string, volume_utc string, volume_epoch bigint, vcp int, bucket string, key string"
MAX_ATTEMPTS = 3
#: Scan patterns of clear air.
CLEAR_AIR = (31, 32, 35)


def decoded(units: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Units whose JSON reads, with its fields, and those whose JSON doesn't."""
    rows = units.withColumn("u", F.from_json(body, UNIT + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    broken = F.col("u").isNull() | F.col("u._corrupt_record").isNotNull()
    keep = [F.col(c) for c in units.columns if c != body]
    fields = [F.col(f"u.{f.split()[0]}") for f in UNIT.split(", ")]
    return rows.filter(~broken).select(*keep, *fields), rows.filter(broken).select(*units.columns)


def with_attempts(units: DataFrame, fails: Column | Callable[[int], Column], most: int = MAX_ATTEMPTS) -> DataFrame:
    """`units` with the attempts that each takes, and whether it ends as a dead letter after `most` of them.

    `fails`: whether an attempt fails, or a function of the attempt's number (from 1) that gives this. An attempt is made
    only if those before failed; a null is no failure.
    """
    failed = [F.coalesce(fails(k) if callable(fails) else fails, F.lit(False)) for k in range(1, most + 1)]
    rows = units.withColumn("_good_at", F.coalesce(*(F.when(~f, k) for k, f in enumerate(failed, 1)), F.lit(0)))
    return rows.withColumns({"attempts": F.when(F.col("_good_at") == 0, most).otherwise(F.col("_good_at")), "dead": F.col("_good_at") == 0}).drop("_good_at")


def not_yet_in(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch, one for each key, whose key the target lacks."""
    return batch.dropDuplicates(keys).join(target, keys, "left_anti").select(*batch.columns)


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Each key (as `name`) with the least `order` (as `first_id`) at which it came; nulls are a key."""
    return rows.groupBy(F.col(key).alias("name")).agg(F.min(order).alias("first_id"))


def complete_volumes(chunks: DataFrame) -> DataFrame:
    """Volumes whose last chunk has come, but for clear air."""
    per = chunks.filter(~F.col("vcp").isin(*CLEAR_AIR)).groupBy("volume").agg(F.count("*").alias("chunks"), F.max("chunk_no").alias("last_chunk"), F.bool_or(F.col("kind") == "E").alias("done"))
    return per.filter("done").drop("done")
