"""Storm cores in three dimensions: peaks of seed voxels with a least separation, and the voxels that belong to each.

Voxels are sparse rows (site, vol, iz, iy, ix, v). Those of the seed level or more fall into components that touch by a
face. A peak is a voxel with no stronger one of its component within `apart` cells along every axis; of equally strong
ones so near to each other the first in the order (iz, iy, ix) stays, then the next that is far enough from it. A
component with one peak is one core; one with several is parted by flooding from its peaks, strongest voxel first, so
borders lie in the saddles.

Peaks come from joins by blocks of `apart` cells: a peak is the strongest of its own block, so only one candidate a block
is held against the 26 blocks about it. Kernels see only candidates as strong as another of their component, and voxels of
components with several peaks, a volume at a time; a volume is a grid of fixed size. Rows with a null in a place or value are no voxels; repeated voxels
count once with their greatest value; empty tables give none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galeframe.operators.detect import VOLUME, label_columns
from galeframe.sources.shared import kept

PLACE = ["iz", "iy", "ix"]


def seed_components(voxels: DataFrame, seed: float = 40.0) -> DataFrame:
    """The seed voxels (site, vol, iz, iy, ix, v) with `label`, their component of the volume."""
    seeds = voxels.dropna(subset=[*PLACE, "v"]).filter(F.col("v") >= seed).groupBy(*VOLUME, *PLACE).agg(F.max("v").alias("v"))
    return seeds.join(label_columns(seeds, tuple(PLACE)), [*VOLUME, *PLACE])


def peak_candidates(seeds: DataFrame, apart: int) -> DataFrame:
    """Voxels of `seed_components` with no stronger one of their component within `apart` cells along every axis."""
    block = {f"b{c}": F.floor(F.col(c) / apart) for c in PLACE}
    rows = seeds.withColumns(block)
    keys = [*VOLUME, "label", *block]
    best = rows.groupBy(*keys).agg(F.max("v").alias("best"))
    mine = rows.join(best, keys).filter("v = best").select(*VOLUME, "label", *PLACE, "v", *block)
    about = mine
    for b in block:
        about = about.withColumn(b, F.explode(F.sequence(F.col(b) - 1, F.col(b) + 1)))
    # Only blocks whose strongest voxel is stronger can hold one that is.
    about = about.join(best, keys).filter("best > v").drop("best")
    other = rows.select(*keys, *(F.col(c).alias(f"o{c}") for c in PLACE), F.col("v").alias("ov"))
    near = F.greatest(*(F.abs(F.col(c) - F.col(f"o{c}")) for c in PLACE)) <= apart
    beaten = about.join(other, keys).filter((F.col("ov") > F.col("v")) & near).select(*VOLUME, *PLACE).distinct()
    return mine.drop(*block).join(beaten, [*VOLUME, *PLACE], "left_anti")


def peaks(seeds: DataFrame, apart: int) -> DataFrame:
    """Peaks of each component, with `core`, their number in the volume from 1 in the order (iz, iy, ix)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["label", "v", *PLACE]).reset_index(drop=True)
        at, kept = pdf[PLACE].to_numpy(np.int64), []
        for rows in pdf.groupby(["label", "v"], sort=False).indices.values():
            mine: list[int] = []
            for i in rows.tolist():
                if not mine or (np.abs(at[mine] - at[i]).max(axis=1) > apart).all():
                    mine.append(i)
            kept += mine
        return pdf.iloc[kept]

    found = peak_candidates(seeds, apart)
    equals = found.withColumn("n", F.count("*").over(Window.partitionBy(*VOLUME, "label", "v")))
    tied = equals.filter("n > 1").drop("n")
    single = equals.filter("n = 1").drop("n").unionByName(tied.groupBy(*VOLUME).applyInPandas(run, tied.schema))
    number = F.row_number().over(Window.partitionBy(*VOLUME).orderBy(*PLACE)).cast("long")
    return single.withColumn("core", number)


def flood(cells: np.ndarray, values: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The owner of each cell (rows of coordinates) once those with an owner above 0 have flooded the rest, strongest cell
    first; of equals the cell that was reached first."""
    number = {tuple(c): i for i, c in enumerate(cells.tolist())}
    out = owners.copy()
    steps = [tuple(s * (i == axis) for i in range(cells.shape[1])) for axis in range(cells.shape[1]) for s in (-1, 1)]
    heap = [(-values[i], k, i) for k, i in enumerate(np.flatnonzero(out > 0).tolist())]
    heapq.heapify(heap)
    reached = len(heap)
    while heap:
        _, _, i = heapq.heappop(heap)
        for step in steps:
            j = number.get(tuple(a + b for a, b in zip(cells[i].tolist(), step, strict=True)))
            if j is not None and out[j] == 0:
                out[j] = out[i]
                heapq.heappush(heap, (-values[j], reached, j))
                reached += 1
    return out


def storm_cores(seeds: DataFrame, apart: int) -> DataFrame:
    """The voxels of `seed_components` with `core`, the number of the core of their volume that they belong to."""
    seeds = kept(seeds, "seeds")  # labels are made once
    own = kept(peaks(seeds, apart).select(*VOLUME, "label", *PLACE, "core"), "peaks")
    per = own.groupBy(*VOLUME, "label").agg(F.count("*").alias("n"), F.min("core").alias("only"))
    rows = seeds.join(per, [*VOLUME, "label"])
    single = rows.filter("n = 1").select(*VOLUME, *PLACE, "v", "label", F.col("only").alias("core"))
    several = rows.filter("n > 1").drop("n", "only").join(own, [*VOLUME, "label", *PLACE], "left").select(*VOLUME, *PLACE, "v", "label", F.coalesce("core", F.lit(0).cast("long")).alias("core"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(PLACE).reset_index(drop=True)
        return pdf.assign(core=flood(pdf[PLACE].to_numpy(np.int64), pdf["v"].to_numpy(float), pdf["core"].to_numpy(np.int64)))

    return single.unionByName(several.groupBy(*VOLUME).applyInPandas(run, several.schema))  # a flood doesn't leave its component


def core_statistics(cores: DataFrame) -> DataFrame:
    """Per core: voxels, levels that it reaches, greatest value, lowest and highest level, and its centre weighted by value."""
    w = F.greatest(F.col("v"), F.lit(1e-9))
    centre = [(F.sum(w * F.col(c)) / F.sum(w)).alias(f"c{c[1]}") for c in PLACE]
    return cores.groupBy(*VOLUME, "core").agg(F.count("*").alias("n_voxels"), F.count_distinct("iz").alias("n_levels"), F.max("v").alias("max_v"), F.min("iz").alias("low"), F.max("iz").alias("high"), *centre)
