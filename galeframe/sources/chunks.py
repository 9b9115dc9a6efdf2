"""A stream of volumes from their chunk files, <site>/<counter>/<yyyymmdd-HHMMSS>-<number>-<S, I or E>.

A volume is complete, and comes once, when its last chunk (E) has been written. The offset is a moment, not a set of names: a
batch has the volumes whose last chunk was written after the moment before and up to its own. So nothing grows over a
stream's life, the driver lists nothing, and a batch that runs again finds the same volumes. Each site is a task, which lists
the site's counters and looks into the newest few. Counters go from 1 to 999 and then begin anew: the newest stand before
the widest gap in the circle. A volume is known by the time it began, never by its counter.

Volumes that began more than MAX_AGE_S before their last chunk came are dropped, as are files with other names. A chunk
is left alone until it is MIN_AGE_S old. A site without a folder has no volumes.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: LOOK_INTO: more volumes than a site begins within MAX_AGE_S.
MIN_AGE_S, MAX_AGE_S, COUNTERS, LOOK_INTO = 5.0, 1800.0, 999, 10
VOLUME = "site string, volume_epoch bigint, source_prefix string, chunk_count int, bytes bigint"
NAME = re.compile(r"^(\d{8}-\d{6})-(\d{3})-([SIE])$")


def newest(counters: list[int], most: int = LOOK_INTO) -> list[int]:
    """The last counters of a circle, oldest first: those before its widest gap."""
    ring = sorted(set(counters))
    if len(ring) < 2:
        return ring
    gaps = [(ring[(i + 1) % len(ring)] - n) % COUNTERS or COUNTERS for i, n in enumerate(ring)]
    last = max(range(len(ring)), key=lambda i: (gaps[i], i))
    return (ring[last + 1 :] + ring[: last + 1])[-most:]


class SitePart(InputPartition):
    def __init__(self, site: str, after: float, until: float) -> None:
        self.site, self.after, self.until = site, after, until


class ChunkReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.sites = options["path"], [s for s in options["sites"].split(",") if s]
        self.since = float(options.get("since", "0"))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"until": self.since}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"until": time.time() - MIN_AGE_S}

    def partitions(self, start: dict, end: dict) -> list[SitePart]:
        return [SitePart(site, start["until"], end["until"]) for site in self.sites]

    def read(self, part: SitePart) -> Iterator[tuple]:
        system, root = fs.FileSystem.from_uri(self.root)
        listed = lambda path: system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        counters = [int(f.base_name) for f in listed(f"{root}/{part.site}") if f.type == fs.FileType.Directory and f.base_name.isdigit()]
        for counter in newest(counters):
            volumes: dict[str, list] = {}
            for f in listed(f"{root}/{part.site}/{counter}"):
                if m := NAME.match(f.base_name):
                    volumes.setdefault(m[1], []).append((m[3], f.mtime.timestamp(), f.size))
            for began, chunks in sorted(volumes.items()):
                ends = [at for kind, at, _ in chunks if kind == "E"]
                epoch = int(datetime.strptime(began, "%Y%m%d-%H%M%S").replace(tzinfo=UTC).timestamp())
                if ends and part.after < min(ends) <= part.until and min(ends) - epoch <= MAX_AGE_S:
                    yield (part.site, epoch, f"{part.site}/{counter}/", len(chunks), sum(size for *_, size in chunks))

    def commit(self, end: dict) -> None: ...


class ChunkFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "galeframe_chunks"

    def schema(self) -> str:
        return VOLUME

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return ChunkReader(dict(self.options))


def complete_volume_stream(spark: SparkSession, root: str, sites: list[str], since: float = 0.0) -> DataFrame:
    """site, volume_epoch, source_prefix, chunk_count and bytes of each volume as its last chunk comes, after the moment `since`."""
    spark.dataSource.register(ChunkFiles)
    return spark.readStream.format(ChunkFiles.name()).option("path", root).option("sites", ",".join(sites)).option("since", str(since)).load()
