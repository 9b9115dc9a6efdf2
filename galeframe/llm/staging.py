"""Tables kept in the cluster's shared folder, so that lost executors cost a reread and lineage stays short.

Each application writes below a folder of its own, which `clear` deletes once its results have been used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of local sessions (tests) that name none, by application.
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, else the context's; a temporary one only on a local master."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = _own.setdefault(context.applicationId, "")
        if not named:
            named = _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="galeframe-")
    if ":" not in named.split("/")[0]:  # without a scheme it is one of the cluster's file system, not of each executor
        path = context._jvm.org.apache.hadoop.fs.Path(named)
        named = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
        named = named.replace("file:/", "file:///", 1) if named.startswith("file:/") and not named.startswith("file://") else named
    return f"{named.rstrip('/')}/galeframe/{context.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all that this application staged; results that were not written elsewhere can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
