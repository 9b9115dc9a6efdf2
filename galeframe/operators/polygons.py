"""Overlap of arbitrary polygons: area of intersection, IoU, pieces of the intersection, and translation.

A polygon is a list of rings (arrays of struct(x, y)) by parity: rings may be holes, touch, cross each other or themselves.
A sweep cuts the plane at every corner and every crossing of edges; between two cuts no edges cross, so sorted from left
to right they bound trapezoids, each inside or outside either polygon. Touching in points or along edges has no area.

Pairs of objects meet in cells of a grid, by their boxes, and each near pair once; a pair is compared in the task where it
was joined. Cells are of a size given by the caller: about that of an object. Objects with a null or no polygon overlap
nothing; a ring's last point joins its first; rings of fewer than 3 points have no area. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rings = list[np.ndarray]


def _edges(rings: Rings) -> np.ndarray:
    """(x1, y1, x2, y2) of all sides that aren't level, upwards."""
    sides = [np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings if len(r) >= 3]
    e = np.concatenate(sides) if sides else np.empty((0, 4))
    e = e[e[:, 1] != e[:, 3]]
    down = e[:, 1] > e[:, 3]
    e[down] = e[down][:, [2, 3, 0, 1]]
    return e


def _crossing_heights(e: np.ndarray) -> np.ndarray:
    """The y of each point in which two sides cross."""
    i, j = np.triu_indices(len(e), 1)
    meet = (np.minimum(e[i, 3], e[j, 3]) > np.maximum(e[i, 1], e[j, 1])) & (np.maximum(e[i, 0], e[i, 2]) >= np.minimum(e[j, 0], e[j, 2])) & (np.maximum(e[j, 0], e[j, 2]) >= np.minimum(e[i, 0], e[i, 2]))
    i, j = i[meet], j[meet]
    a, b = (e[i, 2] - e[i, 0]) / (e[i, 3] - e[i, 1]), (e[j, 2] - e[j, 0]) / (e[j, 3] - e[j, 1])
    skew = a != b
    i, j, a, b = i[skew], j[skew], a[skew], b[skew]
    y = (e[j, 0] - e[i, 0] + a * e[i, 1] - b * e[j, 1]) / (a - b)
    return y[(y > np.maximum(e[i, 1], e[j, 1])) & (y < np.minimum(e[i, 3], e[j, 3]))]


def pieces(first: Rings, second: Rings) -> Iterator[tuple[bool, bool, tuple[float, float, float, float, float, float]]]:
    """Trapezoids (low y, left, right, high y, left, right) that tile both polygons, and which of them hold each."""
    edges = [_edges(first), _edges(second)]
    e, owner = np.concatenate(edges), np.repeat([0, 1], [len(x) for x in edges])
    cuts = np.unique(np.concatenate([e[:, 1], e[:, 3], _crossing_heights(e)]))
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        on = np.flatnonzero((e[:, 1] <= low) & (e[:, 3] >= high))
        at = lambda y: e[on, 0] + (e[on, 2] - e[on, 0]) * (y - e[on, 1]) / (e[on, 3] - e[on, 1])  # noqa: B023, E731
        order = np.argsort(at((low + high) / 2), kind="stable")
        a, b, mine = at(low)[order].tolist(), at(high)[order].tolist(), owner[on][order].tolist()
        inside = [False, False]
        for k in range(len(mine) - 1):
            inside[mine[k]] = not inside[mine[k]]
            if inside[0] or inside[1]:
                yield inside[0], inside[1], (low, a[k], a[k + 1], high, b[k], b[k + 1])


def areas(first: Rings, second: Rings) -> tuple[float, float, float]:
    """Areas of both polygons and of their intersection."""
    total = [0.0, 0.0, 0.0]
    for a, b, (low, l0, r0, high, l1, r1) in pieces(first, second):
        area = (high - low) * ((r0 - l0) + (r1 - l1)) / 2
        for k, of in enumerate((a, b, a and b)):
            total[k] += area if of else 0.0
    return total[0], total[1], total[2]


def clipped(first: Rings, second: Rings) -> list[np.ndarray]:
    """The intersection as rings of trapezoids, without those of no area."""
    both = [t for a, b, t in pieces(first, second) if a and b]
    return [np.array([(l0, low), (r0, low), (r1, high), (l1, high)]) for low, l0, r0, high, l1, r1 in both if (r0 - l0) + (r1 - l1) > 0]


def translated(polygon: Column, dx: Column, dy: Column) -> Column:
    """A polygon moved by dx and dy."""
    return F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + dx).alias("x"), (p["y"] + dy).alias("y"))))


def near_pairs(left: DataFrame, right: DataFrame, by: list[str], size: float) -> DataFrame:
    """Pairs of `by`, a, b, pa, pb of objects (`by`, id, polygon) whose boxes overlap, each once."""
    box = lambda f, c: f(F.transform(F.flatten("polygon"), lambda p: p[c]))

    def boxed(df: DataFrame, n: str) -> DataFrame:
        out = df.filter("polygon IS NOT NULL").select(*by, F.col("id").alias(n), F.col("polygon").alias(f"p{n}"), *(box(f, c).alias(f"{n}{c}{k}") for c in "xy" for k, f in ((0, F.array_min), (1, F.array_max))))
        cells = lambda c: F.explode(F.sequence(F.floor(F.col(f"{n}{c}0") / size), F.floor(F.col(f"{n}{c}1") / size)))
        return out.filter(F.col(f"{n}x0").isNotNull()).withColumn("cx", cells("x")).withColumn("cy", cells("y"))

    met = boxed(left, "a").join(boxed(right, "b"), [*by, "cx", "cy"])
    overlap = [(F.col(f"a{c}0") <= F.col(f"b{c}1")) & (F.col(f"b{c}0") <= F.col(f"a{c}1")) for c in "xy"]
    # Boxes that overlap share the cell of the lower left corner of their overlap; only there the pair counts.
    corner = [F.col(f"c{c}") == F.floor(F.greatest(f"a{c}0", f"b{c}0") / size) for c in "xy"]
    return met.filter(overlap[0] & overlap[1] & corner[0] & corner[1]).select(*by, "a", "b", "pa", "pb")


def _rings(value: list) -> Rings:
    return [np.array([(p["x"], p["y"]) for p in ring], dtype=float).reshape(-1, 2) for ring in value]


def overlaps(left: DataFrame, right: DataFrame, by: list[str], size: float) -> DataFrame:
    """`by`, a, b, area_a, area_b, shared and iou of all pairs of objects (`by`, id, polygon) that share an area."""
    pairs = near_pairs(left, right, by, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [areas(_rings(x), _rings(y)) for x, y in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), strict=True)]
            kept = batch.select([*by, "a", "b"])
            columns = [pa.array([f[k] for f in found], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], [*by, "a", "b", "area_a", "area_b", "shared"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*by, "a", "b").schema)
    out = pairs.mapInArrow(run, f"{kinds}, area_a double, area_b double, shared double")
    return out.filter("shared > 0").withColumn("iou", F.col("shared") / (F.col("area_a") + F.col("area_b") - F.col("shared")))
