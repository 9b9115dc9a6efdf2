"""Hazards by the bulletins' own clock: state that event time orders and ends.

Segments wait in a list until the watermark has passed their time, and are then applied in the order of (at, seq, pos), so
arrival doesn't matter within the delay. What is active is one small value of its key. A key has one timer, at the first time
of what waits or at the end of what is active; as it goes off, all that the watermark has passed is applied in one go, so a
segment is read from state once and not with every other one of its key. What a batch brings for a key is one text in the
list, as each value of state is a message of its own. A removal or an end clears what is active: a key holds what is active
and what is not yet due, never its
history. Segments that come later than the delay, behind the watermark, are dropped. (State TTL goes by the machine's clock and so has no
place here: timers do its work by event time.) A hazard without an end stays until it is removed. A removal of nothing
gives no event. Rows with a null key are one key; rows with a null time are never due and are dropped.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from galeframe.functions.bulletins import REMOVE

EVENTS = "key string, kind string, seq bigint, pos int, ugc string, ring string"
NAMES = [f.split()[0] for f in EVENTS.split(", ")]
WAITING = "segments string"  # JSON: [[seq, pos, action, ugc, ring, at, ends], ...]
ACTIVE = "seq bigint, pos int, ugc string, ring string, ends bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Lives(StatefulProcessor):
    """The life of one hazard."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.active = handle.getValueState("active", ACTIVE)
        self.timer = handle.getValueState("timer", "at bigint")

    def _wake(self, old: int | None, at: int | None) -> None:
        """Have the key's one timer for when the watermark has come to `at`; a timer goes off once the watermark is behind it."""
        if at is None:
            self.timer.clear()
        elif at != old:
            self.handle.registerTimer(at - 1)
            self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """All of a key's rows of a batch wait, but for those that are too late."""
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf[pdf["at_ms"] > timerValues.getCurrentWatermarkInMs()]
        ends = [None if v != v else int(v) for v in pdf["ends_ms"].astype(float).tolist()]
        texts = ([v if isinstance(v, str) else None for v in pdf[c].tolist()] for c in ("action", "ugc", "ring"))
        new = list(zip(pdf["seq"].tolist(), pdf["pos"].tolist(), *texts, pdf["at_ms"].tolist(), ends, strict=True))
        if new:
            self.waiting.appendValue((json.dumps(new),))
            first = min(r[5] for r in new)
            old = self.timer.get()[0] if self.timer.exists() else None
            if old is not None and first < old:
                self.handle.deleteTimer(old - 1)
            self._wake(old, first if old is None else min(first, old))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """The watermark has come to `now`: apply what was due until then, and end the hazard if its end was."""
        now = timerValues.getCurrentWatermarkInMs()
        waiting = sorted((r for texts in self.waiting.get() for r in json.loads(texts[0])), key=lambda r: (r[5], r[0], r[1]))
        due, later = [r for r in waiting if r[5] <= now], [r for r in waiting if r[5] > now]
        held = tuple(self.active.get()) if self.active.exists() else None
        out = []

        def ended(until: int) -> None:
            nonlocal held
            if held and held[4] is not None and held[4] <= until:
                out.append((key[0], "expired", *held[:4]))
                held = None

        for seq, pos, action, ugc, ring, at, ends in due:
            ended(at)
            if action in REMOVE:
                if held:
                    out.append((key[0], "removed", seq, pos, held[2], held[3]))
                held = None
            else:
                ring = ring if ring is not None else held[3] if held else None
                out.append((key[0], "update" if held or action != "NEW" else "new", seq, pos, ugc, ring))
                held = (seq, pos, ugc, ring, ends)
        ended(now)
        if due:
            self.waiting.put([(json.dumps(later),)]) if later else self.waiting.clear()
        if held:
            self.active.update(held)
        else:
            self.active.clear()
        times = [r[5] for r in later[:1]] + ([held[4]] if held and held[4] is not None else [])
        self._wake(None, min(times, default=None))  # Spark deletes the one that went off
        if out:
            yield pd.DataFrame(out, columns=NAMES)

    def close(self) -> None: ...


def hazards_by_time(segments: DataFrame, delay: str) -> DataFrame:
    """new, update, removed and expired events of a stream of segments (key, seq, pos, action, ugc, ring, at, ends).

    An event carries the seq and pos of its segment; that of an end those of the segment that set it."""
    millis = lambda c: F.unix_millis(c)
    rows = segments.filter("at IS NOT NULL").withWatermark("at", delay).withColumns({"at_ms": millis("at"), "ends_ms": millis("ends")})
    return rows.groupBy("key").transformWithStateInPandas(Lives(), EVENTS, "Append", "EventTime")


@contextlib.contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """List state and timers need this store; the session's own setting comes back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
