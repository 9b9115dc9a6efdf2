"""Tables that are published batch by batch, several at once, with schemas that may grow.

A batch writes each of its tables into a folder of its own and then, by one rename, a manifest that names them. Readers take
only folders that a manifest names, so they see all tables of a batch or none, also when a job dies between two writes; what
it left unnamed is never read, and the batch that runs again writes new folders. A batch that has a manifest is done: running
it once more changes nothing.

A manifest keeps each folder's schema and the range of one column. Columns may be added, and numbers widened (int to bigint to
double, float to double); readers see all columns in their widest type, with nulls where a batch hadn't them yet. Any other
change of a type is refused before anything is published. `merged` puts the manifests of old batches into one, so that a
reader lists few files. A table without a batch is missing (None).
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galeframe.sources.shared import publish

ORDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType)


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both, or an error."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    kinds = {type(a), type(b)}
    if kinds <= {*ORDER}:
        return max((a, b), key=lambda t: ORDER.index(type(t)))
    if kinds <= {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    raise TypeError(f"a column can't change from {a.simpleString()} to {b.simpleString()}")


def united(schemas: list[T.StructType]) -> T.StructType:
    """All columns, in the order in which they came, in their widest types."""
    out: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            out[f.name] = widened(out[f.name], f.dataType) if f.name in out else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


class Published:
    """The tables below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_published")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []
        return [f"{self.root}/_published/{n}" for n in names if n.endswith(".json")]

    def _batches(self) -> dict[int, dict]:
        """Manifests by batch: small texts, one a batch, or one for all that `merged` took together."""
        files = self._files()
        if not files:
            return {}
        rows = [json.loads(r.value) for r in self.spark.read.text(files, wholetext=True).collect()]
        return {int(n): tables for row in rows for n, tables in row.items()}

    def batches(self) -> list[int]:
        return sorted(self._batches())

    def commit(self, batch: int, tables: dict[str, DataFrame], ranged: str | None = None) -> bool:
        """Publish the tables of a batch together; false if it has been published before."""
        known = self._batches()
        if batch in known:
            return False
        entry: dict[str, dict] = {}
        for name, df in tables.items():
            united([T.StructType.fromJson(t[name]["schema"]) for t in known.values() if name in t] + [df.schema])
            folder = f"{name}/{batch}-{uuid.uuid4().hex[:12]}"
            df.write.parquet(f"{self.root}/{folder}")
            entry[name] = {"folder": folder, "schema": df.schema.jsonValue()}
            if ranged in df.columns:
                low, high = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}").agg(F.min(ranged), F.max(ranged)).first()
                entry[name]["range"] = [ranged, low, high]
        publish(self.spark, json.dumps({batch: entry}), f"{self.root}/_published/{batch:012d}.json")
        return True

    def _read(self, entries: list[dict]) -> DataFrame | None:
        if not entries:
            return None
        schemas = [T.StructType.fromJson(e["schema"]) for e in entries]
        whole = united(schemas)
        alike: dict[str, list[str]] = {}
        for e, s in zip(entries, schemas, strict=True):
            alike.setdefault(s.json(), []).append(f"{self.root}/{e['folder']}")
        parts = []
        for kind, folders in alike.items():
            own = T.StructType.fromJson(json.loads(kind))
            have = {f.name for f in own}
            parts.append(self.spark.read.schema(own).parquet(*folders).select(*((F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole)))
        return reduce(DataFrame.unionByName, parts)

    def table(self, name: str, low: int | None = None, high: int | None = None, before: int | None = None) -> DataFrame | None:
        """All published rows of a table; only of batches before one, and of those that may have values from `low` to `high`."""
        out = []
        for n, tables in sorted(self._batches().items()):
            if name in tables and (before is None or n < before):
                _, a, b = tables[name].get("range", (None, None, None))
                if a is None or ((high is None or a <= high) and (low is None or b >= low)):
                    out.append(tables[name])
        return self._read(out)

    def latest(self, name: str, before: int | None = None) -> DataFrame | None:
        """A table that each batch writes whole: that of the last batch (before one)."""
        own = [tables[name] for n, tables in sorted(self._batches().items()) if name in tables and (before is None or n < before)]
        return self._read(own[-1:])

    def merged(self) -> None:
        """One manifest in place of those of all batches so far."""
        files, known = self._files(), self._batches()
        if len(files) < 2:
            return
        target = f"{self.root}/_published/merged-{uuid.uuid4().hex[:12]}.json"
        publish(self.spark, json.dumps(known), target)
        for f in files:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)
