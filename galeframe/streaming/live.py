"""Live pipelines: storm tracking, hazard state, flash windows and work units with retries."""

from __future__ import annotations

import json
import pickle
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from galeframe.functions.bulletins import REMOVE
from galeframe.operators.tracker import OUTPUT, Tracker, TrackerParams, run_volumes, tracked_columns
from galeframe.sources.manifest import Published
from galeframe.sources.shared import kept
from galeframe.sources.units import MAX_ATTEMPTS, decoded


def tracked(cells: DataFrame, p: TrackerParams = TrackerParams()) -> DataFrame:  # noqa: B008
    """`track` over a stream of cells, each site's tracker kept as its state.

    Cells that come after a later volume of their site were tracked go out without identities (null cell_uid).
    """
    kind = cells.schema["site"].dataType.simpleString()

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracker = pickle.loads(state.get[0]) if state.exists else Tracker(p)
        pdf = pd.concat(list(frames))
        late = pdf[pdf["t"] <= tracker.frames[-1][0]].dropna(subset=["cell_id"]) if tracker.frames else pdf[:0]
        rows = run_volumes(tracker, pdf) + [{"t": float(t), "cell_id": int(c)} for t, c in zip(late["t"], late["cell_id"], strict=True)]
        state.update((pickle.dumps(tracker),))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in OUTPUT.split(", ")])
        out.insert(0, "site", key[0])
        yield out

    return tracked_columns(cells).groupBy("site").applyInPandasWithState(run, f"site {kind}, {OUTPUT}", "tracker binary", "append", GroupStateTimeout.NoTimeout)


EVENTS = "key string, kind string, seq bigint, pos int, ugc string, ring string"
STATE = "segments string"
FORGET_S, LAST = 7 * 86400, 2**31 - 1


def folded(segments: list) -> dict[tuple, tuple]:
    """The event (kind, ugc, ring) of each segment (seq, pos, action, ugc, ring, end) of a key that has one, by (seq, pos)."""
    ugc, ring, active, out = None, None, False, {}
    for seq, pos, action, zones, own, _ in segments:
        if action in REMOVE:
            if active:
                out[seq, pos] = ("removed", ugc, ring)
            active, ugc, ring = False, None, None
        else:
            ugc, ring = zones or "", (own if own is not None else ring)
            out[seq, pos] = ("new" if not active and action == "NEW" else "update", ugc, ring)
            active = True
    return out


def hazard_events(segments: DataFrame, expire: bool = False) -> DataFrame:
    """new, update and removed events of a stream of segments (key, seq, pos, action, ugc, ring as text).

    Segments apply in the order of (seq, pos), one of each; a follow-up without a ring keeps the last one. A key's state is
    its segments. One that comes after a later one of its key is put in its place, and the events that this changes go out
    again, as `void` where none is left: of several events of one (key, seq, pos) the last counts.

    With `expire`, segments have an end as `ends` (timestamp). A hazard that is active when the clock passes its last
    segment's end goes out as `expired`, at pos LAST, and its state goes; one without an end never expires. The state of a
    removed hazard goes after FORGET_S. What comes for a key later starts it anew.
    """
    names = [c.split()[0] for c in EVENTS.split(", ")]
    clock = GroupStateTimeout.ProcessingTimeTimeout if expire else GroupStateTimeout.NoTimeout

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else []
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], "expired", held[-1][0], LAST, held[-1][3], held[-1][4])] if held[-1][2] not in REMOVE else [], columns=names)
            return
        places = {(s[0], s[1]): s for s in held}
        for r in pd.concat(list(frames)).itertuples(index=False):
            ends = None if not expire or pd.isna(r.ends) else pd.Timestamp(r.ends).timestamp()
            places.setdefault((int(r.seq), int(r.pos)), [int(r.seq), int(r.pos), r.action, r.ugc, r.ring, ends])
        whole = [places[k] for k in sorted(places)]
        before, after = folded(held), folded(whole)
        state.update((json.dumps(whole),))
        if expire:
            left = FORGET_S if whole[-1][2] in REMOVE else None if whole[-1][5] is None else whole[-1][5] - time.time()
            if left is not None:
                state.setTimeoutDuration(max(1, int(left * 1000)))
        rows = []
        for k in sorted(before.keys() | after.keys()):
            if before.get(k) != after.get(k):
                kind, ugc, ring = after.get(k, ("void", None, None))
                rows.append((key[0], kind, *k, ugc, ring))
        yield pd.DataFrame(rows, columns=names)

    return segments.groupBy("key").applyInPandasWithState(run, EVENTS, STATE, "append", clock)


def last_events(events: DataFrame, batch: str = "batch") -> DataFrame:
    """The events that count among those of all batches."""
    names = [c for c in events.columns if c not in ("key", "seq", "pos", batch)]
    last = events.groupBy("key", "seq", "pos").agg(F.max_by(F.struct(*names), batch).alias("e"))
    return last.select("key", "seq", "pos", "e.*").filter("kind <> 'void'").select(*(c for c in events.columns if c != batch))


def flash_windows(flashes: DataFrame, late: str = "10 minutes", length: str = "30 minutes", slide: str = "10 minutes") -> DataFrame:
    """Flashes per satellite and sliding window; rows later than `late` behind the newest are left out."""
    at = F.col("flash_time").cast("timestamp")
    w = F.window("at", length, slide)
    out = flashes.withColumn("at", at).withWatermark("at", late).groupBy(w.alias("w"), "satellite").agg(F.count("*").alias("n"), F.max("energy").alias("max_energy"))
    return out.select(F.col("w.start").alias("start"), "satellite", "n", "max_energy")


def deduplicated(units: DataFrame, keys: list[str], time: str, late: str = "10 minutes") -> DataFrame:
    return units.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


IDLE_S = 600


def unit_sink(spark, root: str, work: Callable[[DataFrame], DataFrame], body: str = "body", idle_s: float = IDLE_S, most: int = MAX_ATTEMPTS, clock: Callable[[], float] = time.time):
    """A foreachBatch sink of work units, published batch by batch below `root` (see `Published`).

    `work` returns its units (site, volume_epoch, vcp, delivery from 1, at) with a column `failed`; a null is no failure. It
    runs once for each delivery, and once more if its batch dies before it is published. Tables of a batch: `done`, units that
    worked, with their deliveries; `dead`, those that failed the last of `most` times, with the time they were dropped (all of
    them over all batches, as of `done`); `malformed`, bodies that can't be read; and, whole in each batch, `pending`, units
    that failed fewer times, with the time of the last. A pending unit is delivered again in the first batch that begins `idle_s` seconds
    after its last delivery (batches without new rows serve as well). Units that are done, dead or pending aren't taken anew.

    Of `done` and `dead`, only batches are read whose volumes overlap the batch's own in time.
    """
    tables = Published(spark, root)
    key = ["site", "volume_epoch"]

    def put(batch: DataFrame, number: int) -> None:
        now = clock()
        good, malformed = decoded(kept(batch.select(body), "bodies"), body)  # the source is read once
        fresh = kept(good.select(*key, "vcp").dropDuplicates(key), "units")
        low, high = fresh.agg(F.min("volume_epoch"), F.max("volume_epoch")).first()
        pending = tables.latest("pending", before=number)
        done, dead = (None if low is None else tables.table(name, low, high, before=number) for name in ("done", "dead"))
        for known in (done, pending, dead):
            fresh = fresh if known is None else fresh.join(known.select(*key), key, "left_anti")
        new = fresh.select(*key, "vcp", F.lit(1).alias("delivery"), F.lit(now).alias("at"))
        waiting = None if pending is None else pending.filter(F.col("at") > now - idle_s)
        if pending is not None:
            again = pending.filter(F.col("at") <= now - idle_s)
            new = new.unionByName(again.select(*key, "vcp", (F.col("delivery") + 1).alias("delivery"), F.lit(now).alias("at")))
        tried = kept(work(new).withColumn("failed", F.coalesce("failed", F.lit(False))), "tried")  # so each unit is worked on once
        rest = tried.filter("failed").select(*new.columns)
        still = rest.filter(F.col("delivery") < most)
        dropped = rest.filter(F.col("delivery") >= most).select(*key, "vcp", "delivery", F.lit(now).alias("dropped_at"))
        tables.commit(number, {
            "done": tried.filter("NOT failed").select(*key, "vcp", "delivery"),
            "malformed": malformed,
            "pending": still if waiting is None else still.unionByName(waiting),
            "dead": dropped,
        }, ranged="volume_epoch")

    return put


def announcement(cells: DataFrame, most: int = 5000) -> DataFrame:
    """One JSON text per volume of its `most` strongest cells, and how many there are. Only those are collected."""
    w = Window.partitionBy("site", "t")
    strongest = F.row_number().over(w.orderBy(F.desc("dbz"), F.desc("cell_id")))
    rows = cells.withColumns({"n": F.count("*").over(w), "rank": strongest}).filter(F.col("rank") <= most)
    ranked = F.sort_array(F.collect_list(F.struct("dbz", "cell_id", "x", "y")), False)
    return rows.groupBy("site", "t").agg(F.to_json(F.struct(F.first("n").alias("n"), ranked.alias("cells"))).alias("body"))


def settings_hash(settings: dict) -> str:
    """The first 16 hex signs of the SHA-256 of sorted JSON."""
    import hashlib

    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]
