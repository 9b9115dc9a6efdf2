"""Dead units stay known, however many there are."""

from pyspark.sql import functions as F

from galeframe.sources.manifest import Published
from galeframe.sources.shared import new_folder
from galeframe.streaming import live as S


def test_all_dead_units_are_kept_and_never_taken_anew(spark):
    n, root = 10_400, new_folder(spark, "units")
    body = F.concat(F.lit('{"site":"K", "volume_epoch":'), F.col("id").cast("string"), F.lit(', "vcp":12}'))
    units = lambda a, b: spark.range(a, b).select(body.alias("body"))
    tried = []

    def work(df):
        tried.append(df.count())
        return df.withColumn("failed", F.col("volume_epoch") > 0)

    put, tables = S.unit_sink(spark, root, work, idle_s=0, most=1), Published(spark, root)
    put(units(0, n), 0)
    put(units(n, n + 50), 1)
    assert tables.table("dead").count() == tables.table("dead").distinct().count() == n + 49
    put(units(0, n + 50), 2)
    assert tried == [n, 50, 0] and tables.table("dead").count() == n + 49
    assert [tuple(r) for r in tables.table("done").select("volume_epoch", "delivery").collect()] == [(0, 1)]
