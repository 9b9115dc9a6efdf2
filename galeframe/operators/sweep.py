"""How storm families depend on the distance that joins cells: one spanning tree a volume, cut at every distance.

The tree of a volume is grown from its first cell by the nearest one outside it (Prim), holding one distance a cell and
no matrix; cutting its edges beyond a distance leaves the components at that distance, so all distances share it. A volume
has a bounded number of cells and is one group. All else are joins and windows: a family's prior is the one that most of
its tracks were in when last seen (ties: the lowest track), a prior has one heir (most such tracks, then the larger family,
then the later and higher), and families linked so are one identity, found by pointers that double their reach.

Cells (site, vol, track_id, x, y in metres) are unique by site, volume and track; null places have no family. A null site is a
site of its own. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galeframe.operators.tracks import VOLUME_MIN, claims, votes
from galeframe.sources.shared import kept


def spanning_tree(xy: np.ndarray) -> list[tuple[int, int, float]]:
    """Edges (a, b, length) of a minimum spanning tree of points."""
    n, edges = len(xy), []
    near, by = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    inside = np.zeros(n, dtype=bool)
    at = 0
    for _ in range(n - 1):
        inside[at] = True
        gap = np.hypot(*(xy - xy[at]).T)
        closer = ~inside & (gap < near)
        near[closer], by[closer] = gap[closer], at
        at = int(np.where(inside, np.inf, near).argmin())
        edges.append((int(by[at]), at, float(near[at])))
    return edges


def dendrogram(cells: DataFrame) -> DataFrame:
    """Edges (site, vol, a, b, km) of each volume's tree over its tracks, by length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("track_id").reset_index(drop=True)
        ids = pdf["track_id"].to_numpy()
        rows = [(ids[a], ids[b], d / 1000) for a, b, d in sorted(spanning_tree(pdf[["x", "y"]].to_numpy(float)), key=lambda e: e[2])]
        out = pd.DataFrame(rows, columns=["a", "b", "km"])
        out.insert(0, "vol", pdf["vol"].iloc[0])
        out.insert(0, "site", pdf["site"].iloc[0])
        return out

    kinds = dict(cells.dtypes)
    rows = cells.select("site", "vol", "track_id", "x", "y").dropna(subset=["track_id", "x", "y"])
    return rows.groupBy("site", "vol").applyInPandas(run, f"site {kinds['site']}, vol {kinds['vol']}, a {kinds['track_id']}, b {kinds['track_id']}, km double")


def families_at(cells: DataFrame, distances: tuple[float, ...]) -> DataFrame:
    """site, vol, track_id, km and family (the least track of its component) at every distance."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("track_id").reset_index(drop=True)
        edges = sorted(spanning_tree(pdf[["x", "y"]].to_numpy(float)), key=lambda e: e[2])
        parent, out, done = list(range(len(pdf))), [], 0

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for km in sorted(distances):  # one pass over the edges for all distances
            while done < len(edges) and edges[done][2] / 1000 <= km:
                a, b = sorted(map(root, edges[done][:2]))
                parent[b] = a
                done += 1
            out.append(pdf[["site", "vol", "track_id"]].assign(km=km, family=[pdf["track_id"].iloc[root(i)] for i in range(len(pdf))]))
        return pd.concat(out)

    kinds = dict(cells.dtypes)
    rows = cells.select("site", "vol", "track_id", "x", "y").dropna(subset=["track_id", "x", "y"])
    return rows.groupBy("site", "vol").applyInPandas(run, f"site {kinds['site']}, vol {kinds['vol']}, track_id {kinds['track_id']}, km double, family {kinds['track_id']}")


def family_links(members: DataFrame) -> DataFrame:
    """site, km, vol, family with the family (pv, pf) that each is heir to; those that are heir to none have no row."""
    w = Window.partitionBy("site", "km", "track_id").orderBy("vol")
    prior = members.withColumns({"pv": F.lag("vol").over(w), "pf": F.lag("family").over(w)})
    uid = F.when(F.col("pv").isNotNull(), F.struct("pv", "pf"))
    grouped = prior.select(F.struct("site", "km").alias("site"), F.struct("vol", "family").alias("grp"), uid.alias("uid"), F.col("track_id").alias("pos"))
    won = claims(votes(grouped)).filter("kept IS NOT NULL")
    return won.select("site.site", "site.km", "grp.vol", "grp.family", "kept.pv", "kept.pf")


def identities(members: DataFrame, links: DataFrame) -> DataFrame:
    """site, km, vol, family with (rv, rf), the first family of their line. Each step doubles how far back a pointer reaches."""
    keys = ["site", "km", "vol", "family"]
    now = members.select(*keys).distinct().withColumn("site", F.struct("site"))  # null sites join
    back = links.withColumn("site", F.struct("site"))
    now = kept(now.join(back, keys, "left").select(*keys, F.coalesce("pv", "vol").alias("rv"), F.coalesce("pf", "family").alias("rf")), "lines")
    longest = now.groupBy("site").agg(F.count_distinct("vol").alias("n")).agg(F.max("n")).first()[0] or 1
    for _ in range((longest - 1).bit_length()):
        on = now.select("site", "km", F.col("vol").alias("rv"), F.col("family").alias("rf"), F.col("rv").alias("v"), F.col("rf").alias("f"))
        now = kept(now.join(on, ["site", "km", "rv", "rf"]).select(*keys, F.col("v").alias("rv"), F.col("f").alias("rf")), "lines")
    return now.withColumn("site", F.col("site.site"))


def distance_sweep(cells: DataFrame, footprints: DataFrame, distances: tuple[float, ...]) -> DataFrame:
    """Per site and distance: families a volume, identities, the longest life, mean overlap of the footprints of linked
    families, their churn (changed by all members), and the most cells of one. footprints: site, vol, track_id, cell."""
    members = kept(families_at(cells, distances), "families")
    links = kept(family_links(members), "links")
    by = ["site", "km"]
    sites = lambda df: df.withColumn("site", F.struct("site"))  # noqa: E731  # null sites join
    sizes = members.groupBy(*by, "vol", "family").agg(F.count("*").alias("n"))
    per = sites(sizes.groupBy(*by).agg((F.count("*") / F.count_distinct("vol")).alias("per_volume"), F.max("n").alias("most_cells")))
    lives = identities(members, links).groupBy(*by, "rv", "rf").agg(((F.max("vol") - F.min("vol")) * VOLUME_MIN).alias("minutes"))
    lives = sites(lives.groupBy(*by).agg(F.count("*").alias("families"), F.max("minutes").alias("longest_min")))

    pairs = sites(links)
    sets = sites(members.groupBy(*by, "vol", "family").agg(F.collect_list("track_id").alias("ids")))
    before = lambda df, *names: df.select("site", "km", F.col("vol").alias("pv"), F.col("family").alias("pf"), *names)
    two = pairs.join(sets, [*by, "vol", "family"]).join(before(sets, F.col("ids").alias("was")), [*by, "pv", "pf"])
    same = F.size(F.array_intersect("ids", "was"))
    both = F.size("ids") + F.size("was")
    churn = two.groupBy(*by).agg((F.sum(both - 2 * same) / F.sum(both - same)).alias("churn"))

    foot = sites(members.withColumn("site", F.struct("site")).join(sites(footprints), ["site", "vol", "track_id"]).withColumn("site", F.col("site.site")).select(*by, "vol", "family", "cell").distinct())
    area = foot.groupBy(*by, "vol", "family").agg(F.count("*").alias("n"))
    shared = pairs.join(foot, [*by, "vol", "family"]).join(before(foot, "cell"), [*by, "pv", "pf", "cell"]).groupBy(*by, "vol", "family").agg(F.count("*").alias("k"))
    fit = pairs.join(area, [*by, "vol", "family"]).join(before(area, F.col("n").alias("m")), [*by, "pv", "pf"]).join(shared, [*by, "vol", "family"], "left")
    k = F.coalesce("k", F.lit(0))
    overlap = fit.groupBy(*by).agg(F.avg(k / (F.col("n") + F.col("m") - k)).alias("overlap"))
    out = per.join(lives, by, "left").join(overlap, by, "left").join(churn, by, "left")
    return out.select(F.col("site.site").alias("site"), "km", "per_volume", "families", "longest_min", "overlap", "churn", "most_cells")
