"""Which zones hold a point: rings cut into cells, so that most points need no test and none meets all zones.

A zone is all rings (zone, ring: an array of struct(lon, lat)) of its name, by parity: a ring within another is a hole. The
index has a row for each cell that a zone touches: `full` cells lie wholly inside; others keep the zone's edges of their row
of cells, which is all that a ray to the right can cross there. Cells with more than CROWDED edges are cut again into
FINER x FINER cells. Points meet cells by an equal join; a crowded place is left to its adaptive skew handling. The test of a
pair is plain arithmetic over a cell's edges, which Spark compiles; arrays are walked only in cells of more than SLOTS edges.

Rings may cross 180 degrees: a step of more than half a turn is taken the short way, and cells wrap around. A ring's last
point joins its first. A point on an edge belongs to the side that the ray test gives it: left and lower edges are inside.
Rings of fewer than 3 points, with a null among them, or beyond the poles hold nothing; points with a null, or that aren't on
the globe, are in no zone. A point in several zones has a row for each. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_DEG, FINER, CROWDED, SLOTS = 0.5, 8, 64, 6
EDGE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _unwound(ring: Column) -> Column:
    """The points (x, y) of a ring, each less than half a turn from the one before."""
    first = F.struct(F.get(ring, F.lit(0))["lon"].alias("last"), F.array().cast("array<struct<x:double,y:double>>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        x = p["lon"] - 360e0 * F.round((p["lon"] - acc["last"]) / 360e0)
        return F.struct(x.alias("last"), F.concat(acc["out"], F.array(F.struct(x.alias("x"), p["lat"].alias("y")))).alias("out"))

    return F.aggregate(ring, first, step, lambda a: a["out"])


def _edges(points: Column) -> Column:
    n = F.size(points)
    at = lambda i: F.get(points, i)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(at(i)["x"].alias("x1"), at(i)["y"].alias("y1"), at((i + 1) % n)["x"].alias("x2"), at((i + 1) % n)["y"].alias("y2")))


def crossings(x: Column, y: Column, edges: Column) -> Column:
    """How many edges a ray to the right of a point crosses."""
    hit = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0e0)) + e["x1"])
    return F.size(F.filter(edges, lambda e: F.coalesce(hit(e), F.lit(False))))


def _span(a: Column, b: Column, size: float) -> Column:
    """The cells of an axis from a to b, one more on each side where a bound lies on theirs."""
    return F.sequence(F.floor(F.least(a, b) / size), F.floor(F.greatest(a, b) / size))


def _cut(edges: DataFrame, size: float, wanted: DataFrame | None = None) -> DataFrame:
    """zone, cx, cy, touched and edges of each cell of some size that a zone's rings span; `wanted`: only within these coarser cells."""
    turn = round(360 / size)
    rows = edges.withColumn("cy", F.explode(_span(F.col("e.y1"), F.col("e.y2"), size)))
    # The part of the edge within its row of cells, so that steep ones touch few cells.
    low, high = F.col("cy") * size, (F.col("cy") + 1) * size
    flat = F.col("e.y1") == F.col("e.y2")
    along = lambda y: F.col("e.x1") + (F.col("e.x2") - F.col("e.x1")) * (F.least(F.greatest(y, F.least("e.y1", "e.y2")), F.greatest("e.y1", "e.y2")) - F.col("e.y1")) / F.nullif(F.col("e.y2") - F.col("e.y1"), F.lit(0e0))
    a = F.when(flat, F.col("e.x1")).otherwise(along(low))
    b = F.when(flat, F.col("e.x2")).otherwise(along(high))
    slack = 1e-9
    rows = rows.withColumns({"c0": F.floor((F.least(a, b) - slack) / size), "c1": F.floor((F.greatest(a, b) + slack) / size)})
    strips = rows.groupBy("zone", "ring_no", "cy").agg(F.collect_list("e").alias("edges"), F.min("c0").alias("first"), F.max("c1").alias("last"), F.array_distinct(F.flatten(F.collect_list(F.sequence("c0", "c1")))).alias("touched"))
    if wanted is None:
        cells = strips.withColumn("c", F.explode(F.sequence("first", "last")))
    else:  # blocks of FINER cells are chosen before their strips' edges are copied to each
        key = ["zone", "ring_no", "cy"]
        block = F.explode(F.sequence(F.floor(F.col("first") / FINER), F.floor(F.col("last") / FINER)))
        blocks = strips.select(*key, "first", "last", F.floor(F.col("cy") / FINER).alias("py"), block.alias("b")).withColumn("px", F.pmod("b", F.lit(turn // FINER)))
        chosen = blocks.join(wanted.select("zone", F.col("cx").alias("px"), F.col("cy").alias("py")), ["zone", "px", "py"], "left_semi")
        own = F.sequence(F.greatest("first", F.col("b") * FINER), F.least("last", F.col("b") * FINER + FINER - 1))
        cells = chosen.select(*key, F.explode(own).alias("c")).join(strips.select(*key, "edges", "touched"), key)
    cells = cells.withColumn("cx", F.pmod("c", F.lit(turn)))
    off = (F.col("c") - F.col("cx")) * size
    shifted = F.transform("edges", lambda e: F.struct((e["x1"] - off).alias("x1"), e["y1"].alias("y1"), (e["x2"] - off).alias("x2"), e["y2"].alias("y2")))
    cells = cells.select("zone", "cx", "cy", F.array_contains("touched", F.col("c")).alias("touched"), shifted.alias("edges"))
    return cells.groupBy("zone", "cx", "cy").agg(F.max("touched").alias("touched"), F.flatten(F.collect_list("edges")).alias("edges"))


def _settled(cells: DataFrame, size: float) -> DataFrame:
    """Cells that lie inside or that an edge touches: `full` ones need no edges."""
    middle = crossings((F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size, F.col("edges")) % 2 == 1
    none = F.array().cast(EDGE)
    return cells.filter(F.col("touched") | middle).select("zone", "cx", "cy", (~F.col("touched")).alias("full"), F.when(F.col("touched"), F.col("edges")).otherwise(none).alias("edges"))


def zone_index(zones: DataFrame, cell: float = CELL_DEG) -> DataFrame:
    """zone, level, cx, cy, full and edges of the cells of all zones. Write it to use it often."""
    ring = F.col("ring")
    sound = (F.size(ring) >= 3) & F.forall(ring, lambda p: F.coalesce((F.abs(p["lat"]) <= 90) & (F.abs(p["lon"]) <= 540), F.lit(False)))
    rings = zones.filter(F.col("zone").isNotNull() & sound).select("zone", F.monotonically_increasing_id().alias("ring_no"), _unwound(ring).alias("points"))
    edges = rings.select("zone", "ring_no", F.explode(_edges(F.col("points"))).alias("e"))
    coarse = _cut(edges, cell)
    crowded = F.col("touched") & (F.size("edges") > CROWDED)
    fine = _cut(edges, cell / FINER, coarse.filter(crowded))
    level = lambda df, k, size: _settled(df, size).withColumn("level", F.lit(k))
    return level(coarse.filter(~crowded), 0, cell).unionByName(level(fine, 1, cell / FINER))


def _lean(index: DataFrame, cell: float) -> DataFrame:
    """`index` without the edges that lie wholly left of their cell: no ray to the right from within it meets them."""
    left = F.col("cx") * F.when(F.col("level") == 0, cell).otherwise(cell / FINER) - 1e-6
    return index.withColumn("edges", F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= left))


def _slots(index: DataFrame) -> DataFrame:
    """Rows of up to SLOTS edges with these in columns of their own; empty slots are never hit."""
    slot = lambda i, c: F.coalesce(F.get("edges", F.lit(i))[c], F.lit(0e0)).alias(f"{c}_{i}")
    return index.select("zone", "level", "cx", "cy", "full", *(slot(i, c) for i in range(SLOTS) for c in ("x1", "y1", "x2", "y2")))


def _held(x: Column, y: Column) -> Column:
    """Whether a ray to the right crosses an odd number of a row's edges: `crossings` as plain arithmetic over slots."""
    odd = F.lit(False)
    for i in range(SLOTS):
        x1, y1, x2, y2 = (F.col(f"{c}_{i}") for c in ("x1", "y1", "x2", "y2"))
        odd = odd != (((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1))  # no division unless y1 and y2 differ
    return odd


def in_zones(points: DataFrame, index: DataFrame, cell: float = CELL_DEG) -> DataFrame:
    """`points` (with lat, lon) with the `zone` of each that holds them, by an index of the same cell size, which is read twice.

    Both are always merged: an index made in the same plan is far larger than Spark's estimate of it."""
    x = F.pmod(F.col("lon"), F.lit(360e0))
    at = lambda k: F.struct(F.lit(k).alias("level"), F.floor(x / (cell / FINER**k)).alias("cx"), F.floor(F.col("lat") / (cell / FINER**k)).alias("cy"))
    names = points.columns
    sound = (F.abs("lat") <= 90) & (F.abs("lon") <= 540)
    rows = points.filter(sound).select(*(F.col(f"`{c}`").alias(f"p_{i}") for i, c in enumerate(names)), F.coalesce(x, F.lit(0e0)).alias("x"), F.coalesce("lat", F.lit(0e0)).alias("y"), F.explode(F.array(at(0), at(1))).alias("k")).select("*", "k.*").drop("k")
    met = lambda part, test: rows.join(part.hint("merge"), ["level", "cx", "cy"]).filter(F.col("full") | test).select(*(F.col(f"p_{i}").alias(c) for i, c in enumerate(names)), "zone")
    lean, few = _lean(index, cell), F.size("edges") <= SLOTS
    plain = met(_slots(lean.filter(few)), _held(F.col("x"), F.col("y")))
    # An array in a join's condition keeps Spark from compiling the join, so the few long rows have one of their own.
    return plain.unionByName(met(lean.filter(~few), crossings(F.col("x"), F.col("y"), F.col("edges")) % 2 == 1))
