"""The overlap tracker: cells follow the track whose advected footprint they share most with, through splits and merges.

Footprints are sets of grid cells and move by whole cells (half a cell of error at most). Volumes stream in order past the
tracks of an episode of their site (see `by_volume`).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from math import hypot

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from galeframe.operators.ordered import after_earlier, by_volume
from galeframe.sources.shared import kept


@dataclass(frozen=True)
class OverlapParams:
    min_iou: float = 0.02
    gate_km: float = 15.0
    grid_km: float = 1.0
    max_ms: float = 45.0
    misses: int = 2
    moves: int = 4
    history: int = 120
    merge_share: float = 0.15
    gap_min: float = 60.0


@dataclass(frozen=True)
class Cell:
    cell_id: int
    x: float
    y: float
    area: float
    pixels: frozenset = frozenset()


@dataclass
class Track:
    track_id: int
    lineage_id: int
    split_from: int | None
    born: float
    t: float
    cell: Cell
    velocity: tuple[float, float] = (0.0, 0.0)
    moves: tuple = ()
    samples: int = 0
    missed: int = 0

    def moved(self, c: Cell, t: float, p: OverlapParams) -> Track:
        dt, velocity, moves = t - self.t, self.velocity, self.moves
        if dt > 0:
            v = ((c.x - self.cell.x) / dt, (c.y - self.cell.y) / dt)
            if hypot(*v) <= p.max_ms:
                moves = (*moves, (*v, dt))[-p.moves :]
                velocity = tuple(float(np.average([m[k] for m in moves], weights=[m[2] for m in moves])) for k in (0, 1))
        return replace(self, t=t, cell=c, velocity=velocity, moves=moves, samples=min(self.samples + 1, p.history), missed=0)


@dataclass
class OverlapTracker:
    p: OverlapParams = field(default_factory=OverlapParams)
    active: dict[int, Track] = field(default_factory=dict)
    events: list[tuple[float, str, tuple, tuple, int]] = field(default_factory=list)
    last_id: int = 0
    last_lineage: int = 0

    def _born(self, c: Cell, t: float, parent: Track | None = None) -> Track:
        self.last_id += 1
        if parent is not None:  # a daughter has its parent's record, motion and lineage
            return replace(parent, track_id=self.last_id, split_from=parent.track_id)
        self.last_lineage += 1
        return Track(self.last_id, self.last_lineage, None, t, t, c)

    def score(self, tr: Track, c: Cell, t: float, gate_km: float) -> float | None:
        """Shared footprint, and a little for nearness; none if too fast, or neither overlapping nor near."""
        dt = t - tr.t
        if dt > 0 and hypot(c.x - tr.cell.x, c.y - tr.cell.y) / dt > self.p.max_ms:
            return None
        dx, dy = tr.velocity[0] * dt, tr.velocity[1] * dt
        d = hypot(c.x - tr.cell.x - dx, c.y - tr.cell.y - dy) / 1000
        iou = 0.0
        if tr.cell.pixels and c.pixels:
            sy, sx = (int(np.rint(v / 1000 / self.p.grid_km)) for v in (dy, dx))
            both = sum((y + sy, x + sx) in c.pixels for y, x in tr.cell.pixels)
            iou = both / (len(tr.cell.pixels) + len(c.pixels) - both)
        return iou + max(0.0, 1 - d / gate_km) * 1e-3 if iou >= self.p.min_iou or d <= gate_km else None

    def update(self, t: float, cells: list[Cell]) -> list[tuple[Cell, Track]]:
        p, before = self.p, dict(self.active)
        out: dict[int, Track] = {}
        if before:
            dt = max(1.0, min(t - tr.t for tr in before.values()))
            gate = max(min(p.gate_km, p.max_ms * dt / 1000), 3 * p.grid_km)
            scores = {(k, j): s for k, tr in before.items() for j, c in enumerate(cells) if (s := self.score(tr, c, t, gate)) is not None}
            parents: dict[int, list[int]] = {}
            for j in range(len(cells)):
                own = [(s, k) for (k, i), s in scores.items() if i == j]
                if own:
                    parents.setdefault(max(own)[1], []).append(j)
            for k, js in parents.items():
                tr = before[k]
                js.sort(key=lambda j: -cells[j].area)
                out[js[0]] = self.active[k] = tr.moved(cells[js[0]], t, p)
                for j in js[1:]:
                    child = self._born(cells[j], t, tr).moved(cells[j], t, p)
                    out[j] = self.active[child.track_id] = child
                if len(js) > 1:
                    self.events.append((t, "split", (k,), tuple(out[j].track_id for j in js), tr.lineage_id))
            merged: dict[int, list[int]] = {}
            for k, tr in before.items():
                own = [(s, j) for (i, j), s in scores.items() if i == k]
                if k not in parents and own and max(own)[0] >= p.min_iou:
                    j = max(own)[1]
                    if cells[j].area > 0 and tr.cell.area >= p.merge_share * cells[j].area and j in out:
                        merged.setdefault(j, []).append(k)
            for j, ks in merged.items():
                for k in ks:
                    del self.active[k]
                self.events.append((t, "merge", (out[j].track_id, *ks), (out[j].track_id,), out[j].lineage_id))
        for j, c in enumerate(cells):
            if j not in out:
                out[j] = self._born(c, t).moved(c, t, p)
                self.active[out[j].track_id] = out[j]
                self.events.append((t, "birth", (), (out[j].track_id,), out[j].lineage_id))
        for k, tr in list(self.active.items()):
            if tr.t < t:
                tr.missed += 1
                if tr.missed > p.misses:
                    del self.active[k]
                    self.events.append((t, "death", (k,), (), tr.lineage_id))
        return [(c, out[j]) for j, c in enumerate(cells)]


TRACKS = "t double, cell_id long, track_id long, lineage_id long, split_from long, samples long"
EVENTS = "t double, kind string, track_ids array<long>, child_ids array<long>, lineage_id long"


def run_volumes(tracker: OverlapTracker, pdf: pd.DataFrame) -> tuple[list[tuple], list[tuple]]:
    """Tracks of the cells of the volumes of `pdf`, oldest first, and what happened to the tracks. Cells without an id go."""
    rows, tracker.events = [], []
    for t, own in pdf.dropna(subset=["cell_id"]).groupby("t"):
        cells = []
        for r in own.itertuples(index=False):
            pixels = frozenset(zip(r.pix_y, r.pix_x, strict=True)) if r.pix_y is not None else frozenset()
            cells.append(Cell(int(r.cell_id), float(r.x), float(r.y), float(r.area), pixels))
        rows += [(float(t), c.cell_id, tr.track_id, tr.lineage_id, tr.split_from, tr.samples) for c, tr in tracker.update(float(t), cells)]
    return rows, tracker.events


def overlap_tracks(cells: DataFrame, p: OverlapParams = OverlapParams(), events: bool = False) -> DataFrame:  # noqa: B008
    """Tracks of each cell (site, t, cell_id, x, y, area, pix_y, pix_x), or the births, splits, merges and deaths.

    Tracks don't go on over more than `gap_min` without any cell of their site; their deaths then have no event. A cell without
    pixels is followed by nearness alone, one without an id or time is left out; an empty table gives an empty result."""
    schema = EVENTS if events else TRACKS
    names = [c.split()[0] for c in schema.split(", ")]

    def feed(tracker: OverlapTracker, pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(run_volumes(tracker, pdf)[int(events)], columns=names)
        return out.assign(ids=tracker.last_id, lineages=tracker.last_lineage)

    rows = cells.select("site", "t", "cell_id", "x", "y", "area", "pix_y", "pix_x")
    found = kept(by_volume(rows, lambda: OverlapTracker(p), feed, schema + ", ids long, lineages long", p.gap_min * 60), "episodes")
    return after_earlier(found, {"ids": ["track_ids", "child_ids"] if events else ["track_id", "split_from"], "lineages": ["lineage_id"]})
