"""Footprints as rings, nested polygons, convex and concave hulls, line simplification, and how well an envelope fits its mask.

An object without cells has no rings, and no fidelity (nulls).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def footprint(cells: set[tuple[int, int]]) -> list[list[tuple[float, float]]]:
    """Closed rings of (x, y) along the edges of cells (y, x); outer rings run one way, holes the other."""
    after: dict[tuple[float, float], list[tuple[float, float]]] = {}
    for y, x in sorted(cells):
        corners = [(x - 0.5, y - 0.5), (x + 0.5, y - 0.5), (x + 0.5, y + 0.5), (x - 0.5, y + 0.5)]
        for k, side in enumerate(((y - 1, x), (y, x + 1), (y + 1, x), (y, x - 1))):
            if side not in cells:
                after.setdefault(corners[k], []).append(corners[(k + 1) % 4])
    rings = []
    while after:
        start = at = min(after)
        ring, before = [start], None
        while True:
            options = after[at]
            if before is not None and len(options) > 1:  # cells that touch at a corner: turn so that rings stay apart
                dx, dy = at[0] - before[0], at[1] - before[1]
                options.sort(key=lambda o: dx * (o[1] - at[1]) - dy * (o[0] - at[0]))
            step = options.pop()
            if not options:
                del after[at]
            before, at = at, step
            ring.append(at)
            if at == start:
                break
        rings.append(ring)
    return rings


def ring_area(ring: list[tuple[float, float]]) -> float:
    """Signed by direction."""
    x, y = np.array(ring).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def convex_hull(cells: set[tuple[int, int]]) -> list[tuple[float, float]]:
    """The closed hull of the corners of cells."""
    points = sorted({(x + a, y + b) for y, x in cells for a in (-0.5, 0.5) for b in (-0.5, 0.5)})

    def half(run: list[tuple[float, float]]) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for p in run:
            while len(out) >= 2 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    hull = half(points) + half(points[::-1])
    return [*hull, hull[0]]


def inside(rings: list[list[tuple[float, float]]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Points in an odd number of rings."""
    odd = np.zeros(len(x), dtype=bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
            if y1 != y2:
                odd ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return odd


def nested(rings: list[list[tuple[float, float]]]) -> list[list[list[tuple[float, float]]]]:
    """Polygons of closed rings that don't cross: an outer ring, then its holes. A ring in an even number of others is an outer
    one; a hole belongs to the smallest ring that holds it. Outer rings come by falling area."""
    order = sorted((r for r in rings if len(r) > 3), key=lambda r: -abs(ring_area(r)))

    def holds(outer: list[tuple[float, float]], ring: list[tuple[float, float]]) -> bool:
        (x1, y1), (x2, y2) = ring[0], ring[1]  # beside the middle of an edge, on the ring's own inner side
        side, long = (1e-6 if ring_area(ring) > 0 else -1e-6), max(abs(x2 - x1), abs(y2 - y1))
        x, y = (x1 + x2) / 2 - side * (y2 - y1) / long, (y1 + y2) / 2 + side * (x2 - x1) / long
        return bool(inside([outer], np.array([x]), np.array([y]))[0])

    above = [[j for j in range(i) if holds(order[j], ring)] for i, ring in enumerate(order)]
    out = {i: [ring] for i, ring in enumerate(order) if len(above[i]) % 2 == 0}
    for i, ring in enumerate(order):
        if len(above[i]) % 2:
            out[max(j for j in above[i] if j in out and len(above[j]) == len(above[i]) - 1)].append(ring)
    return list(out.values())


def delaunay(points: np.ndarray) -> np.ndarray:
    """Triangles (indexes, anticlockwise) of distinct points with small whole coordinates, by insertion. No three points off
    a line: none. Beyond each edge of the hull stands a triangle with the corner -1, whose circle is the half-plane there."""
    p = points.astype(np.int64)
    turn = lambda a, b, c: (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])
    off = np.flatnonzero(turn(p[0], p[1], p) != 0) if len(p) > 2 else []
    if not len(off):
        return np.empty((0, 3), dtype=np.int64)
    a, b, c = (0, 1, int(off[0])) if turn(p[0], p[1], p[off[0]]) > 0 else (1, 0, int(off[0]))
    tri = np.array([(a, b, c), (b, a, -1), (c, b, -1), (a, c, -1)], dtype=np.int64)
    for i in [k for k in range(len(p)) if k not in (a, b, c)]:
        u, v, w = (p[tri[:, k]] for k in range(3))
        real = tri[:, 2] >= 0
        du, dv, dw = u - p[i], v - p[i], w - p[i]
        square = lambda d: (d * d).sum(axis=1)
        cross = lambda d, e: d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]
        within = square(du) * cross(dv, dw) - square(dv) * cross(du, dw) + square(dw) * cross(du, dv) > 0
        side = turn(u, v, p[i])
        beyond = (side > 0) | ((side == 0) & ((du * dv).sum(axis=1) < 0))
        bad = np.where(real, within, beyond)
        edges = {(int(x[k]), int(x[(k + 1) % 3])) for x in tri[bad] for k in range(3)}
        new = []
        for s, t in edges:
            if (t, s) not in edges:
                new.append((t, i, -1) if s == -1 else (i, s, -1) if t == -1 else (s, t, i))
        tri = np.concatenate([tri[~bad], np.array(new, dtype=np.int64)])
    return tri[tri[:, 2] >= 0]


def concave_hull(cells: set[tuple[int, int]], ratio: float = 0.3) -> list[list[tuple[float, float]]]:
    """Closed rings of the hull of the corners of cells, eroded from outside where edges of their Delaunay triangulation are long.

    The longest border edge goes first, with its triangle, if it is longer than the shortest of all edges plus `ratio` of the
    range of lengths, and if the corner behind it is no border yet, so the hull stays whole and holds every cell. Squares
    with four such corners are two triangles of the triangulation, and their short edges always stay; so only the corners
    beside other squares have to be triangulated."""
    corners = {(x + a, y + b) for y, x in cells for a in (0, 1) for b in (0, 1)}  # the cell (y, x) between (x, y) and (x + 1, y + 1)
    full = {(x, y) for x, y in corners if {(x + 1, y), (x, y + 1), (x + 1, y + 1)} <= corners}
    around = lambda x, y: [(x, y), (x - 1, y), (x, y - 1), (x - 1, y - 1)]
    rim = sorted(c for c in corners if not all(q in full for q in around(*c)))
    points = np.array(rim, dtype=np.int64).reshape(-1, 2)
    gaps: list[tuple] = []
    for t in delaunay(points) if len(points) else []:
        x, y = points[t].sum(axis=0).tolist()
        if (x // 3, y // 3) not in full:
            gaps.append(tuple(rim[k] for k in t.tolist()))
    sides = lambda t: [frozenset((t[k], t[(k + 1) % 3])) for k in range(3)]
    length = lambda e: float(np.hypot(*np.subtract(*map(np.array, e))))
    owners: dict[frozenset, int] = {}
    for x, y in full:
        for e in ((x, y), (x + 1, y)), ((x, y + 1), (x + 1, y + 1)), ((x, y), (x, y + 1)), ((x + 1, y), (x + 1, y + 1)):
            owners[frozenset(e)] = owners.get(frozenset(e), 0) + 1
    at: dict[frozenset, list[int]] = {}
    for i, t in enumerate(gaps):
        for e in sides(t):
            owners[e] = owners.get(e, 0) + 1
            at.setdefault(e, []).append(i)
    longest = max((length(e) for e in at), default=1.0)
    most = 1.0 + ratio * (longest - 1.0) if cells else 1.0  # the side of a cell is the shortest edge
    border = {c for e, n in owners.items() if n == 1 for c in e}
    left = set(range(len(gaps)))
    heap = [(-length(e), i) for e, own in at.items() if owners[e] == 1 for i in own]
    heapq.heapify(heap)
    while heap:
        long, i = heapq.heappop(heap)
        if -long <= most:
            break
        outer = [e for e in sides(gaps[i]) if owners[e] == 1] if i in left else []
        if len(outer) != 1:
            continue
        behind = next(c for c in gaps[i] if c not in outer[0])
        if behind in border:
            continue
        left.discard(i)
        border.add(behind)
        for e in sides(gaps[i]):
            owners[e] -= 1
            for j in at[e]:
                if j in left and owners[e] == 1:
                    heapq.heappush(heap, (-length(e), j))
    # Rings of what is left: sides that only one square or triangle has, each with it on the left.
    loose: dict[tuple, list[tuple]] = {}
    walks = [((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)) for x, y in full] + [gaps[i] for i in left]
    for walk in walks:
        for k, a in enumerate(walk):
            b = walk[(k + 1) % len(walk)]
            if owners[frozenset((a, b))] == 1:
                loose.setdefault(a, []).append(b)
    rings = []
    while loose:
        start = here = min(loose)
        ring = [start]
        while True:
            step = loose[here].pop()
            if not loose[here]:
                del loose[here]
            here = step
            ring.append(here)
            if here == start:
                break
        rings.append([(x - 0.5, y - 0.5) for x, y in ring])
    return rings


METHODS = {"footprint": footprint, "convex": lambda cells: [convex_hull(cells)], "concave": concave_hull}


def fidelity(cells: set[tuple[int, int]], method: str) -> tuple[float, float, float]:
    """Overlap by union of mask and envelope, envelope area by mask area, and envelope area, in cells."""
    if method not in METHODS:
        raise ValueError(f"no envelope method {method!r}")
    if not cells:
        return float("nan"), float("nan"), float("nan")
    rings = METHODS[method](cells)
    area = abs(sum(map(ring_area, rings)))
    ys, xs = (np.array([c[i] for c in cells]) for i in (0, 1))
    gy, gx = np.mgrid[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1]
    # A little off the centre, which an edge of a hull may cross
    hit = inside(rings, gx.ravel() + 1e-7, gy.ravel() + 3e-7)
    mask = np.array([(int(b), int(a)) in cells for a, b in zip(gx.ravel(), gy.ravel(), strict=True)])
    return float((hit & mask).sum() / max(1, (hit | mask).sum())), area / len(cells), area


def simplified(ring: np.ndarray, tolerance: float, places: int = 3) -> np.ndarray | None:
    """Douglas-Peucker with a stack; rounded, repeated points dropped, fewer than 3 points: none."""
    keep = np.zeros(len(ring), dtype=bool)
    if len(ring):
        keep[[0, -1]] = True
    stack = [(0, len(ring) - 1)]
    while stack:
        a, b = stack.pop()
        if b <= a + 1:
            continue
        p, d = ring[a + 1 : b] - ring[a], ring[b] - ring[a]
        length = float(np.hypot(*d))
        gap = np.abs(d[0] * p[:, 1] - d[1] * p[:, 0]) / length if length else np.hypot(*p.T)
        k = int(np.argmax(gap))
        if gap[k] > tolerance:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    out = np.round(ring[keep], places)
    out = out[np.r_[True, (out[1:] != out[:-1]).any(axis=1)]] if len(out) else out
    return out if len(out) >= 3 else None


def _cells(y: object, x: object) -> set[tuple[int, int]]:
    return set() if y is None or x is None else set(zip(map(int, y), map(int, x), strict=True))


def envelopes(objects: DataFrame, method: str = "footprint") -> DataFrame:
    """`objects` (with pix_y, pix_x) with their fidelity: iou, excess, area."""
    kinds = objects.drop("pix_y", "pix_x").dtypes

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [fidelity(_cells(y, x), method) for y, x in zip(pdf["pix_y"], pdf["pix_x"], strict=True)]
            out = pdf.drop(columns=["pix_y", "pix_x"])
            out[["iou", "excess", "envelope_area"]] = np.array(found, dtype=float).reshape(-1, 3)
            yield out

    return objects.mapInPandas(run, ", ".join(f"`{n}` {k}" for n, k in kinds) + ", iou double, excess double, envelope_area double")


def outlines(objects: DataFrame, method: str = "footprint") -> DataFrame:
    """`objects` (with pix_y, pix_x) with `polygons`: for each part its outer ring, then its holes, as arrays of (x, y)."""
    kinds = objects.drop("pix_y", "pix_x").dtypes
    make = METHODS[method]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = pdf.drop(columns=["pix_y", "pix_x"])
            rings = [nested(make(c)) if (c := _cells(y, x)) else [] for y, x in zip(pdf["pix_y"], pdf["pix_x"], strict=True)]
            out["polygons"] = [[[[{"x": float(a), "y": float(b)} for a, b in ring] for ring in part] for part in parts] for parts in rings]
            yield out

    return objects.mapInPandas(run, ", ".join(f"`{n}` {k}" for n, k in kinds) + ", polygons array<array<array<struct<x:double,y:double>>>>")


def envelope_summary(fitted: DataFrame) -> DataFrame:
    p: Column = F.col("excess")
    false = F.greatest(F.col("envelope_area") - F.col("area_km2"), F.lit(0e0))
    return fitted.agg(F.count("*").alias("n"), F.avg("iou").alias("mean_iou"), F.percentile("iou", F.lit(0.05)).alias("p05_iou"), F.avg(p).alias("mean_excess"), F.percentile(p, F.lit(0.95)).alias("p95_excess"), F.max(p).alias("max_excess"), F.sum(false).alias("false_area"), (F.sum(false) / F.sum("envelope_area")).alias("false_fraction"))
