"""Hazard bulletins to segments, and segments to the state of active hazards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galeframe.functions.bulletins import REMOVE, code_parts, event_codes, motion, movement, rings, ugc_blocks, vtec_time

#: Names of hazards.
NAMES = {
    "TO": "Tornado", "SV": "Severe Thunderstorm", "FF": "Flash Flood", "FL": "Flood", "FA": "Areal Flood", "MA": "Marine", "SM": "Special Marine",
    "EW": "Extreme Wind", "HU": "Hurricane", "TR": "Tropical Storm", "HW": "High Wind", "WI": "Wind", "HT": "Heat", "FG": "Dense Fog",
    "CF": "Coastal Flood", "RP": "Rip Current", "SU": "High Surf", "FZ": "Freeze", "WS": "Winter Storm", "BZ": "Blizzard", "FR": "Frost",
}
LEVELS = {"W": "Warning", "A": "Watch", "Y": "Advisory", "S": "Statement", "F": "Forecast", "O": "Outlook"}


def segments(bulletins: DataFrame, office: str | None = None) -> DataFrame:
    """A row per event code (of one office, if it is given): its parts, the zone list before it, and the first polygon behind it
    (`poly`) with its motion (`motion`), each null where it has none. Null and empty texts have no rows."""
    parsed = bulletins.select("*", event_codes(F.col("text")).alias("vtec"), ugc_blocks(F.col("text")).alias("zones"), rings(F.col("text")).alias("polys"))
    rows = parsed.withColumn("v", F.explode_outer("vtec")).filter("v IS NOT NULL")  # an inner explode would have the codes parsed a second time, to see if there are any
    parts = code_parts(F.col("v.whole"))
    if office is not None:
        rows = rows.filter(parts["office"] == office)
    pos = F.col("v.pos")
    before = F.filter("zones", lambda z: z["pos"] < pos)
    behind = F.filter("polys", lambda p: p["pos"] > pos)
    out = rows.select(*bulletins.columns, pos.alias("pos"), *parts.values(), F.coalesce(F.try_element_at(before, F.lit(-1))["codes"], F.array().cast("array<string>")).alias("ugc"), F.get(behind, F.lit(0)).alias("p"))
    out = out.withColumn("moved", movement(F.col("p.rest")))  # only where a query asks for it
    moves = F.struct(*motion(F.col("moved")))
    out = out.withColumns({"poly": F.when(F.col("p").isNotNull(), F.struct("p.pos", "p.ring")), "motion": F.when(moves["deg"].isNotNull(), moves)}).drop("p", "moved")
    key = F.concat_ws(".", "office", "phen", "sig", "etn")
    return out.withColumns({"key": key, "name": F.concat_ws(" ", named("phen", NAMES), named("sig", LEVELS)), "end_time": vtec_time(F.col("ends"))})


def named(column: str, names: dict[str, str]):
    """The name of a code, or the code."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.col(column))


def is_pushed(column_sig: str = "sig", column_phen: str = "phen"):
    return (F.col(column_sig) == "W") | ((F.col(column_sig) == "A") & F.col(column_phen).isin("TO", "SV"))


def alert_state(rows: DataFrame, order: list[str]) -> DataFrame:
    """The active hazard of each key once all rows are applied in order.

    Removal ends a hazard; anything else sets it. A follow-up without polygon keeps the last one since the removal
    before it, and one without motion the last motion, each by itself; the zones are those of the last row. A new hazard is `new` if its key was absent and its action NEW.
    """
    w = Window.partitionBy("key").orderBy(*order)
    removal = F.col("action").isin(*REMOVE)
    lives = rows.withColumn("removal", removal).withColumn("life", F.coalesce(F.sum(F.col("removal").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    life = Window.partitionBy("key", "life").orderBy(*order)
    kept = {c: F.last(c, ignorenulls=True).over(life) for c in ("poly", "motion") if c in rows.columns}
    lives = lives.withColumns(kept | {"n": F.row_number().over(Window.partitionBy("key").orderBy(*(F.desc(c) for c in order))), "is_new": (F.row_number().over(life) == 1) & (F.col("action") == "NEW") & ~F.col("removal")})
    return lives


def active(lives: DataFrame, now=None) -> DataFrame:
    """The last row of each key, unless it is a removal or its end lies before `now` (no end: never)."""
    out = lives.filter((F.col("n") == 1) & ~F.col("removal"))
    return out if now is None else out.filter(F.col("end_time").isNull() | (F.col("end_time") >= now))


def push_events(lives: DataFrame) -> DataFrame:
    return lives.filter(F.col("is_new") & is_pushed())


def summary(current) -> DataFrame:
    """Number and sorted names of active hazards, of a table or of its groups; "None" without any."""
    hazards = F.array_join(F.array_sort(F.collect_set("name")), ", ")
    return current.agg(F.count("*").alias("state"), F.when(F.count("*") == 0, "None").otherwise(hazards).alias("hazards"))


def geometry(current: DataFrame, shapes: DataFrame) -> DataFrame:
    """Rings of each hazard: its own polygon if it has one, else the shapes (ugc, ring) of its zones.

    Hazards with a polygon pass the join beside the others, as a union of two filters would make `current` twice. They match
    nothing there and go by their key, since a null for all of them would take them to one task.
    """
    own = F.col("poly").isNotNull()
    zones = F.when(own, F.array(F.lit(None).cast("string"))).otherwise(F.col("ugc"))
    rows = current.select("key", own.alias("own"), F.col("poly.ring").alias("own_ring"), F.explode(zones).alias("ugc"))
    known = shapes.select(F.col("ugc").alias("zone"), "ring", F.lit(True).alias("known"))
    by = F.when(F.col("own"), F.col("key")).otherwise(F.col("ugc"))
    found = rows.join(known, (by == F.col("zone")) & ~F.col("own"), "left").filter("own OR known")
    kind = F.when(F.col("own"), "polygon").otherwise("zone")
    return found.select("key", kind.alias("kind"), "ugc", F.when(F.col("own"), F.col("own_ring")).otherwise(F.col("ring")).alias("ring"))


def document(current: DataFrame) -> DataFrame:
    """One JSON text of all active hazards, sorted by key: their polygon if they have one, else their zones, and their motion."""
    motion = ["motion"] if "motion" in current.columns else []
    item = F.struct("key", "name", "ends", "etn", F.when(F.col("poly").isNull(), F.col("ugc")).alias("ugc"), F.col("poly.ring").alias("poly"), *motion)
    return current.agg(F.to_json(F.struct(F.count("*").alias("count"), F.sort_array(F.collect_list(item)).alias("alerts"))).alias("body"))


def touching(current: DataFrame, places: DataFrame) -> DataFrame:
    """The hazards (key, ugc) of which a zone is one of any place's (place, ugc), and these places; both meet by zone."""
    zones = lambda df, *keep: df.select(*keep, F.explode(F.array_distinct("ugc")).alias("zone"))
    return zones(current, "key").join(zones(places, "place"), "zone").select("key", "place").distinct()


def local_expiry(current: DataFrame, zone: str) -> DataFrame:
    """`current` with `expires`, its end in local time as in "Mon 03:05 PM CST" without the zone's name."""
    return current.withColumn("expires", F.date_format(F.from_utc_timestamp("end_time", zone), "EEE hh:mm a"))
