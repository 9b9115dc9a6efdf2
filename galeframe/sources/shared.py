"""Folders that driver and executors share, and sinks that replayed batches leave unchanged."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir, else the context's; a temporary one only on a local master (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="galeframe-")
    return f"{qualified(spark, base).rstrip('/')}/galeframe/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme as one of the cluster's file system, so that no executor takes it for its own disk."""
    if ":" in path.split("/")[0]:
        return path
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written once in the shared folder and read again: later steps start from there, also after executors are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put_batch(folder: str):
    """A foreachBatch sink: batch n is the folder batch=n, so a batch that runs again replaces itself."""

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    return put


def replace_table(folder: str):
    """A foreachBatch sink for complete results: each batch is a table of its own, the last one counts."""

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/{batch:09d}")

    return put


def latest(spark: SparkSession, folder: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = sorted(f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))
    return spark.read.parquet(f"{folder}/{names[-1]}")


def publish(spark: SparkSession, body: str, path: str) -> None:
    """Put a small text in place of a file at once: it is written beside it and renamed, so readers see the old or the new one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = system.create(beside)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(context.makeQualified(beside), context.makeQualified(target), options)


def spread(rows: DataFrame) -> DataFrame:
    """`rows` over at least as many tasks as there are cores: few large row groups would leave cores idle where each row is much work.

    Deal out narrow rows, before the work. Tables that are read in as many splits stay as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)
