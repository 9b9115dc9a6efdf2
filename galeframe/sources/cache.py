"""Grids kept by site, volume and settings: what was made once is read, only volumes that are missing are made.

Each hash of settings has tables of its own (see `Published`), in which rows and the keys that they belong to are published
together; so a key is written once, and a job that dies leaves none. Volumes that gave no rows have a key as well and aren't
tried again. Duplicates among the wanted volumes count once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from galeframe.sources.manifest import Published
from galeframe.streaming.live import settings_hash

KEY = ["site", "vol"]


def cached(gates: DataFrame, wanted: DataFrame, root: str, settings: dict, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that `make` gives for the gates of the `wanted` volumes (site, vol). Only gates of missing ones are read."""
    tables = Published(gates.sparkSession, f"{root}/{settings_hash(settings)}")
    wanted = wanted.select(*KEY).distinct()
    known = tables.table("keys")
    missing = wanted if known is None else wanted.join(known, KEY, "left_anti")
    if not missing.isEmpty():
        batches = tables.batches()
        tables.commit(batches[-1] + 1 if batches else 0, {"rows": make(gates.join(missing, KEY, "left_semi")), "keys": missing})
    rows = tables.table("rows")
    if rows is None:  # nothing was ever wanted
        return make(gates.limit(0))
    return rows.join(wanted, KEY, "left_semi")


def pruned(gates: DataFrame, root: str, settings: dict) -> list[str]:
    """Delete what other settings made; the hashes that went."""
    spark = gates.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [f.getPath() for f in system.listStatus(path) if f.isDirectory() and f.getPath().getName() != settings_hash(settings)] if system.exists(path) else []
    for old in gone:
        system.delete(old, True)
    return sorted(old.getName() for old in gone)
