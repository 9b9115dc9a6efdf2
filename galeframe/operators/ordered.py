"""Stateful kernels over time: episodes of a site, each streaming in order through a task that holds a state and a volume.

A site's history is cut where nothing was seen for longer than a state lasts. What lies between two such gaps is an
episode; episodes run apart, of one site as of many, and so use all cores. Their numbers (from 0) come from a table with a
row for each volume. Identities that kernels count from 1 in each episode are put one after another by `after_earlier`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _runs(frame: pd.DataFrame, by: list[str]) -> list[int]:
    """Where the values of `by` change, with both ends."""
    now, before = frame[by], frame[by].shift()
    changed = ((now != before) & ~(now.isna() & before.isna())).any(axis=1).to_numpy()
    return [0, *(i for i in changed.nonzero()[0].tolist() if i), len(frame)]


def with_episodes(rows: DataFrame, gap_s: float) -> DataFrame:
    """`rows` (site, t) with `episode`, counted up at every gap in t that is longer than some seconds. Null sites are one site."""
    volumes = rows.select(F.struct("site").alias("s"), "t").distinct()
    w = Window.partitionBy("s").orderBy("t")
    begins = volumes.withColumn("new", F.coalesce((F.col("t") - F.lag("t").over(w) > gap_s).cast("int"), F.lit(0)))
    numbered = begins.select("s", "t", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("episode"))
    return rows.withColumn("s", F.struct("site")).join(numbered, ["s", "t"]).drop("s")


def after_earlier(found: DataFrame, counted: dict[str, list[str]]) -> DataFrame:
    """`found` (site, episode, ...) without the episode: the numbers of each episode come after those of the ones before.

    counted: for each column that tells how many numbers its row's episode has used, the columns (numbers or arrays of
    them) to be raised. `found` is read twice, so give a written table."""
    used = found.groupBy(F.struct("site").alias("s"), "episode").agg(*(F.max(c).alias(c) for c in counted))
    before = Window.partitionBy("s").orderBy("episode").rowsBetween(Window.unboundedPreceding, -1)
    first = used.select("s", "episode", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"first_{c}") for c in counted))
    out = found.withColumn("s", F.struct("site")).join(first, ["s", "episode"])
    for c, columns in counted.items():
        for n in columns:
            own = F.col(f"first_{c}")
            raised = F.transform(n, lambda x, own=own: x + own) if dict(found.dtypes)[n].startswith("array") else F.col(n) + own
            out = out.withColumn(n, raised)
    return out.drop("s", "episode", *counted, *(f"first_{c}" for c in counted))


def by_volume[S](rows: DataFrame, fresh: Callable[[], S], feed: Callable[[S, pd.DataFrame], pd.DataFrame], schema: str, gap_s: float) -> DataFrame:
    """`feed` of the rows of each episode, oldest first, in portions of whole volumes (t), with the state that `fresh` made for it.

    Episodes are dealt by hash and sorted by Spark, which spills; a task holds a batch and a volume of one. Rows without a
    time are left out. The result has `site` and `episode` before the columns of `schema`.
    """
    kind = rows.schema["site"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state, last_key = None, fresh(), None

        def fed(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            nonlocal state, last_key
            cuts = _runs(frame, ["site", "episode"])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = frame.iloc[a:b]
                site, episode = own["site"].iloc[0], int(own["episode"].iloc[0])
                key = (None if pd.isna(site) else site, episode)
                if last_key is not None and key != last_key:
                    state = fresh()
                last_key = key
                out = feed(state, own.drop(columns="episode"))
                out.insert(0, "episode", episode)
                out.insert(0, "site", site)
                yield out

        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = _runs(held, ["site", "episode", "t"])[-2] if len(held) else 0
            if last:
                yield from fed(held.iloc[:last])
                held = held.iloc[last:].reset_index(drop=True)
        if held is not None and len(held):
            yield from fed(held)

    timed = rows.withColumn("t", F.col("t").cast("double")).filter("t IS NOT NULL AND NOT isnan(t)")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, so that few bytes with much work aren't put into one task
    dealt = with_episodes(timed, gap_s).repartition(n, "site", "episode").sortWithinPartitions("site", "episode", "t", "cell_id")
    return dealt.mapInPandas(run, f"site {kind}, episode long, {schema}")
