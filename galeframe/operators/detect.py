"""Storm objects on column products: labels, thresholds, watershed, gates, suppression.

Kernels see one volume at a time: a volume is a grid of fixed size, so a group is bounded however much data there is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VOLUME = ["site", "vol"]
NEXT_TO = ((-1, 0), (1, 0), (0, -1), (0, 1))


@dataclass(frozen=True)
class Gates:
    levels: int = 3
    top_km: float = 3.0
    area_km2: float = 4.0


@dataclass(frozen=True)
class LadderParams:
    """Thresholds of the detector, the fewest pixels of a feature, the contour that bounds footprints, and the grid's step."""

    thresholds: tuple[float, ...] = (30.0, 35.0, 40.0, 45.0, 50.0, 55.0, 60.0)
    n_min: int = 20
    base_dbz: float = 30.0
    cell_km: float = 1.0
    gates: Gates = Gates()
    sigma: float = 0.5  # of the Gaussian, in cells, that smooths the field before thresholds are applied; 0: none


def object_statistics(pixels: DataFrame, dz_km: float = 0.5, cell_km: float = 1.0) -> DataFrame:
    """Of columns (cell_km wide) with `obj`: area, extremes, depth and the centroid weighted by intensity; no echo top: no object."""
    w = F.greatest(F.col("colmax"), F.lit(0e0))
    centre = lambda c: F.when(F.sum(w) > 0, F.sum(w * F.col(c)) / F.sum(w)).otherwise(F.avg(c))
    out = pixels.groupBy(*VOLUME, "obj").agg(
        (F.count("*") * cell_km**2).cast("double").alias("area_km2"), F.max("colmax").alias("max_dbz"), F.max("etop_km").alias("etop_km"), F.min("ebase_km").alias("ebase_km"),
        F.max("nlev_seed").alias("n_levels"), centre("ix").alias("cx"), centre("iy").alias("cy"),
    )
    return out.filter("etop_km IS NOT NULL").withColumn("depth_km", F.col("etop_km") - F.col("ebase_km") + dz_km)


def admitted(objects: DataFrame, gates: Gates = Gates()) -> DataFrame:  # noqa: B008
    return objects.filter((F.col("n_levels") >= gates.levels) & (F.col("etop_km") >= gates.top_km) & (F.col("area_km2") >= gates.area_km2))


def numbered(objects: DataFrame) -> DataFrame:
    """cell_id from 1 in order of strength, area, place."""
    w = Window.partitionBy(*VOLUME).orderBy(F.desc("max_dbz"), F.desc("area_km2"), "cx", "cy", "obj")
    return objects.select(*VOLUME, "obj", F.row_number().over(w).cast("bigint").alias("cell_id"))


def majority_parent(pixels: DataFrame) -> DataFrame:
    """The base component that most pixels of each seed component lie in; the smaller id of equals."""
    n = pixels.groupBy(*VOLUME, "seed", "base").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*VOLUME, "seed").orderBy(F.desc("n"), "base")
    return n.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")


def label(cells: np.ndarray) -> np.ndarray:
    """A label for each (y, x) or (z, y, x) row: components of cells that differ by 1 in one coordinate, from 1 in order."""
    number = {tuple(c): i for i, c in enumerate(cells.tolist())}
    parent = list(range(len(cells)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for c, i in number.items():
        for axis in range(cells.shape[1]):
            j = number.get((*c[:axis], c[axis] + 1, *c[axis + 1 :]))
            if j is not None:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(cells))], dtype=np.int64)
    return np.unique(roots, return_inverse=True)[1] + 1 if len(roots) else roots


def label_columns(mask: DataFrame, coordinates: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """`mask` (site, vol and coordinates) with `label`, components of each volume in order of their first cell."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(coordinates)).drop_duplicates(list(coordinates)).reset_index(drop=True)
        return pdf.assign(label=label(pdf[list(coordinates)].to_numpy(np.int64)))

    kinds = dict(mask.dtypes)
    names = [*VOLUME, *coordinates]
    return mask.select(*names).groupBy(*VOLUME).applyInPandas(run, ", ".join(f"{n} {kinds[n]}" for n in names) + ", label long")


def suppressed(objects: DataFrame, least_km: float) -> DataFrame:
    """Objects (x_km, y_km, max_dbz, area_km2, obj) without those less than some km from a stronger one that stays."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["max_dbz", "area_km2", "x_km", "y_km", "obj"], ascending=[False, False, True, True, True])
        xy, kept = pdf[["x_km", "y_km"]].to_numpy(float), []
        for i in range(len(xy)):
            if not kept or (np.hypot(*(xy[kept] - xy[i]).T) >= least_km).all():
                kept.append(i)
        return pdf.iloc[kept]

    rows = objects.select(*VOLUME, "obj", "max_dbz", "area_km2", "x_km", "y_km")
    return rows.groupBy(*VOLUME).applyInPandas(run, rows.schema)


def watershed(values: dict[tuple[int, int], float], markers: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """Cells flooded from markers, highest first; of equals the smaller (y, x), and the marker that reached it first."""
    import heapq

    out = dict(markers)
    heap = [(-values[c], c) for c in markers]
    heapq.heapify(heap)
    while heap:
        _, (y, x) = heapq.heappop(heap)
        for dy, dx in NEXT_TO:
            c = (y + dy, x + dx)
            if c in values and c not in out:
                out[c] = out[(y, x)]
                heapq.heappush(heap, (-values[c], c))
    return out


def ladder(cells: np.ndarray, values: np.ndarray, p: LadderParams) -> list[np.ndarray]:
    """Rows of each feature: components of n_min or more at the highest threshold that still has one; it takes the place
    of the component below that holds it."""
    features: list[np.ndarray] = []
    for t in p.thresholds:
        rows = np.flatnonzero(values >= t)
        labels = label(cells[rows]) if len(rows) else np.empty(0, dtype=np.int64)
        found = [g for k in np.unique(labels) if len(g := rows[labels == k]) >= p.n_min]
        above = set(np.concatenate(found).tolist()) if found else set()
        features = [f for f in features if not above.intersection(f.tolist())] + found
    return sorted(features, key=lambda f: int(f[0]))


def smoothed(cells: np.ndarray, values: np.ndarray, sigma: float) -> np.ndarray:
    """`values` at (y, x) cells after a separable Gaussian, cut off at 4 sigma; where there is no cell the field is 0."""
    if sigma <= 0 or not len(cells):
        return values
    reach = int(4 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights /= weights.sum()
    low = cells.min(axis=0) - reach
    field = np.zeros(cells.max(axis=0) - low + reach + 1)
    field[tuple((cells - low).T)] = values
    for axis in (0, 1):
        padded = np.pad(field, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)])
        field = sum(w * np.take(padded, range(k, k + field.shape[axis]), axis=axis) for k, w in enumerate(weights))
    return field[tuple((cells - low).T)]


def _detect_volume(pdf: pd.DataFrame, p: LadderParams) -> pd.DataFrame:
    pdf = pdf.sort_values(["iy", "ix"]).reset_index(drop=True)
    cells, values = pdf[["iy", "ix"]].to_numpy(np.int64), pdf["colmax"].to_numpy(float)
    smooth = smoothed(cells, values, p.sigma)
    features = ladder(cells, smooth, p)
    rows = []
    if features:
        base = {tuple(c): v for c, v in zip(cells.tolist(), values.tolist(), strict=True) if v >= p.base_dbz}
        markers = {tuple(c): k for k, f in enumerate(features, 1) for c in cells[f].tolist()}
        owner = watershed(base, {c: k for c, k in markers.items() if c in base})
        pdf["feature"] = [owner.get(tuple(c), 0) for c in cells.tolist()]
        for k, f in enumerate(features, 1):
            own = pdf[pdf["feature"] == k]
            level = max(t for t in p.thresholds if t <= smooth[f].min())  # the threshold that gave the feature
            w = smooth[f] - level + 1e-9
            top = own["etop_km"].max()
            if pd.isna(top):
                continue
            rows.append((k, float(np.average(cells[f, 1], weights=w)), float(np.average(cells[f, 0], weights=w)), float(own["colmax"].max()), len(own) * p.cell_km**2, float(top), float(own["ebase_km"].min()), int(own["nlev_seed"].max()), own["iy"].astype("int64").tolist(), own["ix"].astype("int64").tolist()))
    out = pd.DataFrame(rows, columns=["obj", "cx", "cy", "max_dbz", "area_km2", "etop_km", "ebase_km", "n_levels", "pix_y", "pix_x"])
    keys = [pdf["site"].iloc[0], pdf["vol"].iloc[0]]
    out.insert(0, "site", keys[0])
    out.insert(1, "vol", keys[1])
    return out


DETECTION = "obj long, cx double, cy double, max_dbz double, area_km2 double, etop_km double, ebase_km double, n_levels long, pix_y array<long>, pix_x array<long>"


def detect(columns: DataFrame, p: LadderParams = LadderParams()) -> DataFrame:  # noqa: B008
    """Admitted objects of each volume: position of the feature, footprint within the base contour (pix_y, pix_x)."""
    kinds = dict(columns.dtypes)
    slim = columns.filter(F.col("colmax") >= min(p.base_dbz, *p.thresholds)).select(*VOLUME, "iy", "ix", "colmax", "etop_km", "ebase_km", "nlev_seed")
    found = slim.groupBy(*VOLUME).applyInPandas(lambda pdf: _detect_volume(pdf, p), f"site {kinds['site']}, vol {kinds['vol']}, {DETECTION}")
    return admitted(found, p.gates)


def component_levels(voxels: DataFrame) -> DataFrame:
    """How many levels (iz) each object of a volume reaches."""
    return voxels.groupBy(*VOLUME, "obj").agg(F.count_distinct("iz").alias("n_levels"))
