"""A hazard's state by itself: each waiting segment is read once, however many wait."""

import pandas as pd

from galeframe.streaming.hazards import Lives


class Kept:
    def __init__(self):
        self.rows, self.read = [], 0

    def exists(self):
        return bool(self.rows)

    def clear(self):
        self.rows = []


class Many(Kept):
    def get(self):
        self.read += 1
        return iter(list(self.rows))

    def appendList(self, rows):  # noqa: N802
        self.rows += rows

    def appendValue(self, row):  # noqa: N802
        self.rows.append(row)

    def put(self, rows):
        self.rows = list(rows)


class One(Kept):
    def get(self):
        return self.rows[0] if self.rows else None

    def update(self, row):
        self.rows = [row]


class Handle:
    def __init__(self):
        self.timers, self.states = set(), {}

    def getListState(self, name, schema):  # noqa: N802
        return self.states.setdefault(name, Many())

    def getValueState(self, name, schema):  # noqa: N802
        return self.states.setdefault(name, One())

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.now

    getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815


def batch(lives, handle, now, rows):
    """What Spark does for a batch of one key: its rows, then all timers behind the watermark."""
    out = []
    if rows:
        names = ["key", "seq", "pos", "action", "ugc", "ring", "at_ms", "ends_ms"]
        out += lives.handleInputRows(("k",), iter([pd.DataFrame([("k", *r) for r in rows], columns=names)]), Clock(now))
    fired = sorted(t for t in handle.timers if t < now)
    for t in fired:
        expiry = Clock(t)
        out += lives.handleExpiredTimer(("k",), Clock(now), expiry)
        handle.timers.discard(t)
    return [tuple(r) for df in out for r in df[["kind", "seq", "ugc", "ring"]].itertuples(index=False)], len(fired)


def test_many_waiting_segments_are_read_once():
    handle, lives = Handle(), Lives()
    lives.init(handle)
    n = 500
    rows = [(i, 0, "NEW" if i == 0 else "CON", f"Z{i}", "R" if i == 0 else None, 1000 * (i + 1), None) for i in range(n)]
    assert batch(lives, handle, 0, rows[::-1]) == ([], 0)
    assert len(handle.timers) == 1
    got, fired = batch(lives, handle, 1000 * n, [])  # the last segment's time is the watermark itself: it is due
    assert fired == 1 and handle.states["waiting"].read <= 2
    assert got == [("new" if i == 0 else "update", i, f"Z{i}", "R") for i in range(n)]
    assert not handle.states["waiting"].rows and not handle.timers


def test_timer_follows_the_earliest_time():
    handle, lives = Handle(), Lives()
    lives.init(handle)
    assert batch(lives, handle, 0, [(5, 0, "CON", "B", None, 5000, 9000)]) == ([], 0)
    assert batch(lives, handle, 0, [(1, 0, "NEW", "A", "R", 1000, 3000), (2, 0, "CAN", "A", None, 20_000, None)]) == ([], 0)
    assert len(handle.timers) == 1
    assert batch(lives, handle, 2000, [(0, 0, "NEW", "late", None, 1500, None)])[0] == [("new", 1, "A", "R")]
    assert batch(lives, handle, 2500, []) == ([], 0)
    assert batch(lives, handle, 6000, [])[0] == [("expired", 1, "A", "R"), ("update", 5, "B", None)]
    assert batch(lives, handle, 9000, [])[0] == [("expired", 5, "B", None)]
    assert batch(lives, handle, 30_000, [])[0] == [] and not handle.timers and not handle.states["active"].rows
