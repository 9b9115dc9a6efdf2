"""Parsing of hazard bulletins as Column expressions: zone lists, event codes, polygons and motion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the bulletin format.
VTEC = r"/([OTEX])\.(NEW|CON|CAN|EXP|EXA|EXB|EXT|UPG|ROU)\.([A-Z]{4})\.([A-Z]{2})\.([AWYSFO])\.(\d{4})\.(\d{6}T\d{4}Z)-(\d{6}T\d{4}Z)/"
UGC_LIST = r"((?:[A-Z]{2}[CZ]\d{3}|\d{3})(?:>\d{3})?(?:-(?:[A-Z]{2}[CZ]\d{3}|\d{3})(?:>\d{3})?)*)-\d{6}-$"
#: Numbers that share the state and type before them.
UGC_RUN = r"[A-Z]{2}[CZ]\d{3}(?:>\d{3})?(?:-\d{3}(?:>\d{3})?)*"
LATLON = r"LAT\.\.\.LON((?:\s+\d{3,5})+)"
MOTION = r"^[\s\S]{0,400}?TIME\.\.\.MOT\.\.\.LOC\s+\d{4}Z\s+(\d{1,3}DEG\s+\d{1,3}KT(?:\s+\d{3,5})+)"
REMOVE, LOOK_BACK = ("CAN", "EXP", "UPG"), 600


def positioned(text: Column, pattern: str, groups: int) -> Column:
    """Every match of a pattern: struct(pos, whole, g1..gn), each looked for behind the one before."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))

    def add(rows: Column, m: Column) -> Column:
        last = F.try_element_at(rows, F.lit(-1))
        begin = F.coalesce(last["pos"] + F.length(last["whole"]), F.lit(1))
        return F.concat(rows, F.array(F.struct(F.call_function("locate", m, text, begin).alias("pos"), m.alias("whole"))))

    rows = F.aggregate(found, F.array().cast("array<struct<pos:int,whole:string>>"), add)
    if not groups:
        return rows
    return F.transform(rows, lambda r: F.struct(r["pos"].alias("pos"), r["whole"].alias("whole"), *(F.regexp_extract(r["whole"], pattern, g).alias(f"g{g}") for g in range(1, groups + 1))))


def expand_ugc(tokens: Column) -> Column:
    """Sorted distinct zone codes of a list: ranges a>b inclusive, bare numbers take the last state and type."""
    runs = F.regexp_extract_all(tokens, F.lit(UGC_RUN), F.lit(0))

    def codes(run: Column) -> Column:
        return F.transform(F.flatten(F.transform(F.split(F.substr(run, F.lit(4)), "-"), zones)), lambda n: F.concat(F.left(run, F.lit(3)), n))

    def zones(number: Column) -> Column:
        first, last = F.left(number, F.lit(3)).cast("int"), F.right(number, F.lit(3)).cast("int")
        span = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.when(F.length(number) == 3, F.array(number)).otherwise(F.transform(span, lambda n: F.lpad(n.cast("string"), 3, "0")))

    return F.sort_array(F.array_distinct(F.flatten(F.transform(runs, codes))))


def ugc_blocks(text: Column) -> Column:
    """struct(pos, codes) of every zone list; pos is where its closing time stands."""
    ends = positioned(text, r"\d{6}-\r?\n", 0)

    def block(e: Column) -> Column:
        begin = F.greatest(e["pos"] - LOOK_BACK, F.lit(1))
        window = F.regexp_replace(F.substring(text, begin, e["pos"] - begin + 7), r"\s+", "")
        return F.struct(e["pos"].alias("pos"), expand_ugc(F.regexp_extract(window, UGC_LIST, 1)).alias("codes"))

    return F.filter(F.transform(ends, block), lambda b: F.size(b["codes"]) > 0)


def pairs(numbers: Column) -> Column:
    """Points struct(lon, lat) of hundredths of degrees, north and west; an odd last number is dropped."""
    north, west = (F.regexp_extract_all(numbers, F.lit(r"(\d+)\s+(\d+)"), F.lit(g)) for g in (1, 2))
    return F.zip_with(north, west, lambda y, x: F.struct((-x.cast("int") / 100e0).alias("lon"), (y.cast("int") / 100e0).alias("lat")))


def rings(text: Column) -> Column:
    """struct(pos, ring, rest) of every polygon of 3 points or more; `rest` is the text behind it, for `motion`."""
    blocks = positioned(text, LATLON, 0)

    def block(b: Column) -> Column:
        rest = F.substring(text, b["pos"] + F.length(b["whole"]), F.lit(600))
        return F.struct(b["pos"].alias("pos"), pairs(b["whole"]).alias("ring"), rest.alias("rest"))

    return F.filter(F.transform(blocks, block), lambda b: F.size(b["ring"]) >= 3)


def movement(rest: Column) -> Column:
    """The numbers of the motion within 400 signs behind a polygon, for `motion`: deg, kt, then north and west of each place; none without one."""
    return F.transform(F.regexp_extract_all(F.regexp_extract(rest, MOTION, 1), F.lit(r"\d+"), F.lit(0)), lambda s: s.cast("int"))


def motion(n: Column) -> list[Column]:
    """deg, kt, heading and loc (the first place) of the numbers of a motion; nulls without one."""
    deg, loc = F.get(n, F.lit(0)), F.struct((-F.get(n, F.lit(3)) / 100e0).alias("lon"), (F.get(n, F.lit(2)) / 100e0).alias("lat"))
    return [deg.alias("deg"), F.get(n, F.lit(1)).alias("kt"), ((deg + 180) % 360).alias("heading"), F.when(F.size(n) >= 4, loc).alias("loc")]


def polygons(text: Column) -> Column:
    """struct(pos, ring, deg, kt, heading, loc) of every polygon of 3 points or more; motion within 400 signs behind it."""
    moved = F.transform(rings(text), lambda b: F.struct(b["pos"].alias("pos"), b["ring"].alias("ring"), movement(b["rest"]).alias("n")))
    return F.transform(moved, lambda b: F.struct(b["pos"].alias("pos"), b["ring"].alias("ring"), *motion(b["n"])))


def event_codes(text: Column) -> Column:
    """struct(pos, whole) of every event code; `code_parts` cuts it, best once a code has a row of its own, where only the parts in use are cut."""
    return positioned(text, VTEC, 0)


def code_parts(whole: Column) -> dict[str, Column]:
    """The groups of VTEC by name: the parts of a code have fixed places, which cut faster than they match."""
    places = {"class": (2, 1), "action": (4, 3), "office": (8, 4), "phen": (13, 2), "sig": (16, 1), "etn": (18, 4), "begins": (23, 12), "ends": (36, 12)}
    return {name: F.substring(whole, *at).alias(name) for name, at in places.items()}


def vtec_time(stamp: Column) -> Column:
    """Null for an open end (all zeros) or nonsense."""
    return F.try_to_timestamp(stamp, F.lit("yyMMdd'T'HHmm'Z'"))
