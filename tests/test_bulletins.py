"""Bulletins and hazards: results on odd rows against plain loops, and plans that do each piece of work once."""

import random
import re

from pyspark.sql import functions as F

from galeframe.functions import bulletins as B
from galeframe.operators import alerts as A
from galeframe.plans import alerts as P

RING = "array<struct<lon:double,lat:double>>"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_geometry_makes_the_hazards_once(spark, tmp_path):
    """Hazards without key, zones or ring, repeated zones, a key like a zone, shapes without code or ring or twice."""
    square, other = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0)], [(5.0, 5.0)]
    hazards = [("a", (1, square), ["Z1", "Z2"]), ("b", None, ["Z1", "Z1", None, "Z3", "Z9"]), ("c", None, []), ("d", None, None), (None, (2, square), ["Z1"]), (None, None, ["Z2"]), ("Z1", (3, None), ["Z1"]), ("e", (4, []), None), ("Z2", None, ["Z2"]), ("a", (1, square), ["Z1", "Z2"])]
    shapes = [("Z1", square), ("Z2", other), ("Z2", None), ("Z3", []), (None, square), ("b", square)]
    spark.createDataFrame(hazards, f"key string, poly struct<pos:int,ring:{RING}>, ugc array<string>").write.parquet(f"{tmp_path}/hazards")
    got = A.geometry(spark.read.parquet(f"{tmp_path}/hazards"), spark.createDataFrame(shapes, f"ugc string, ring {RING}"))
    want = [(k, "polygon", None, p[1]) for k, p, _ in hazards if p] + [(k, "zone", z, ring) for k, p, zones in hazards if p is None for z in zones or [] for u, ring in shapes if z is not None and z == u]
    plain = lambda ring: None if ring is None else [tuple(p) for p in ring]
    assert got.columns == ["key", "kind", "ugc", "ring"]
    assert sorted(((r.key, r.kind, r.ugc, plain(r.ring)) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert plan(got).count("parquet") == 1


def expanded(tokens):
    """A plain loop over the tokens of a zone list."""
    out, prefix = set(), ""
    for t in tokens.split("-"):
        prefix, numbers = (t[:3], t[3:]) if t[:1].isalpha() else (prefix, t)
        if prefix and numbers:
            first, _, last = numbers.partition(">")
            out |= {f"{prefix}{n:03d}" for n in range(int(first), int(last or first) + 1)}
    return sorted(out)


def test_zone_lists_are_expanded_once(spark):
    r = random.Random(2)
    number = lambda: f"{(n := r.randrange(1000)):03d}" + r.choice(["", "", "", f">{min(999, n + r.randrange(9)):03d}", f">{r.randrange(1000):03d}"])
    lists = ["-".join(r.choice(["", "", "FLZ", "FLC", "GAC"]) + number() for _ in range(r.randrange(1, 9))) for _ in range(300)] + ["", "007", "FLZ999>000-001", "FLZ000>999-FLC000"]
    df = spark.createDataFrame([(x,) for x in [*lists, *lists[:20], None]], "t string")
    got = [(x.t, x.u) for x in df.select("t", B.expand_ugc(F.col("t")).alias("u")).collect()]
    assert sorted(got, key=repr) == sorted([(x, expanded(x)) for x in [*lists, *lists[:20]]] + [(None, None)], key=repr)
    # Each list is matched by one pattern, once; a pattern inside a lambda for the numbers would be matched for each number again.
    blocks = plan(df.select(B.ugc_blocks(F.col("t")).alias("u")))
    assert len(re.findall(r"rlike|regexp_extract", blocks, re.I)) == 3 and blocks.count("[A-Z]{2}[CZ]") == 3


def test_places_and_parts_of_repeated_codes(spark):
    """Codes that come twice, touch each other, or stand in other text are found where they stand."""
    code = "/O.NEW.KMOB.TO.W.0001.240101T0000Z-240102T0100Z/"
    other = code.replace("NEW", "CAN").replace("KMOB", "KTAE")
    texts = [code, f"é {code}{code}\n{other}{code}", f"{code[:-1]} {other}", f"/{code}/{code}", "", None, "no code"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(1, texts[1])], "id int, text string")
    got = [(x.id, x.pos, x["class"], x.action, x.office, x.phen, x.sig, x.etn, x.begins, x.ends) for x in A.segments(df).collect()]
    want = [(i, m.start() + 1, *m.groups()) for i, t in [*enumerate(texts), (1, texts[1])] for m in re.finditer(B.VTEC, t or "")]
    assert sorted(got) == sorted(want) and len(want) == 12
    assert sorted(x.pos for x in A.segments(df, "KTAE").collect()) == sorted(w[1] for w in want if w[4] == "KTAE")
    key = plan(A.segments(df).select("key"))
    assert not re.search(r"substring\([^()]*, (2, 1|4, 3|23, 12|36, 12)\)", key)  # parts that no one asks for aren't cut


def polygons_of(text):
    """A plain loop over the polygons of a bulletin: place, ring, and the place of the first sign behind them."""
    out = []
    for m in re.finditer(B.LATLON, text or "", re.ASCII):
        n = [int(x) for x in m[1].split()]
        ring = [(-n[i + 1] / 100, n[i] / 100) for i in range(0, len(n) - 1, 2)]
        if len(ring) >= 3:
            out.append((m.start() + 1, ring, m.end()))
    return out


def odd_bulletins(n, seed):
    r = random.Random(seed)
    space = lambda: r.choice([" ", " ", "\n", "\r\n", "\t ", " \x0b", "\f"])
    numbers = lambda most: "".join(space() + str(r.randrange(10 ** r.randint(2, 6))).zfill(3) for _ in range(r.randrange(most)))
    polygon = lambda: "LAT...LON" + numbers(10)
    motion = lambda: f"TIME...MOT...LOC{space()}{r.choice(['0041', '41'])}Z{space()}{r.randrange(2000)}DEG{space()}{r.randrange(1200)}KT{numbers(5)}"
    other = lambda: r.choice(["é🌀 ", "12345 ", "x" * 380, "x" * 410, "/O.NEW.KMOB.TO.W.0001.240101T0000Z-240102T0100Z/"])
    texts = ["".join(r.choice([polygon, polygon, motion, other])() + r.choice(["", "\n", "\n"]) for _ in range(r.randrange(8))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(i, texts[i]) for i in range(20)] + [(n, None), (n + 1, ""), (None, texts[7]), (None, None)]


def plain(ring):
    return [tuple(p) for p in ring]


def test_polygons_are_matched_once(spark):
    rows = odd_bulletins(400, 3)
    df = spark.createDataFrame(rows, "bulletin_id int, text string")
    got = [(x.bulletin_id, x.text, None if x.p is None else [(p.pos, plain(p.ring), p.rest) for p in x.p]) for x in df.select("*", B.rings(F.col("text")).alias("p")).collect()]
    want = [(i, t, None if t is None else [(pos, ring, t[end : end + 600]) for pos, ring, end in polygons_of(t)]) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr) and sum(len(w[2] or []) > 1 for w in want) > 5
    parsed = plan(df.select(B.rings(F.col("text")).alias("p")))
    assert parsed.count(r"LAT\.\.\.LON") == 1 and len(re.findall(r"regexp_extract|split\(", parsed)) == 3  # the numbers are cut twice, not anew for each


def test_first_polygons_are_filtered_behind_the_parsing(spark, tmp_path):
    rows = odd_bulletins(200, 4)
    df = spark.createDataFrame(rows, "bulletin_id int, text string")
    got = P.first_polygons(df).select("bulletin_id", "p.pos", "p.ring").collect()
    assert sorted([(x.bulletin_id, x.pos, plain(x.ring)) for x in got], key=repr) == sorted([(i, *polygons_of(t)[0][:2]) for i, t in rows if polygons_of(t)], key=repr)
    spark.createDataFrame([(k,) for k in [*range(50), 3, 3, None]], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = plan(P.latlon_polygon(spark, str(tmp_path)))
    assert lines.count(r"LAT\.\.\.LON") == 1 and lines.index("Filter isnotnull(p#") < lines.index("Generate")
    assert P.latlon_polygon(spark, str(tmp_path)).filter("bulletin_id = 3").count() == 3 and P.latlon_polygon(spark, str(tmp_path)).count() == 39


def motion_of(rest):
    """A plain search in the signs behind a polygon: deg, kt, heading and first place."""
    m = re.match(r"[\s\S]{0,400}?TIME\.\.\.MOT\.\.\.LOC\s+\d{4}Z\s+(\d{1,3})DEG\s+(\d{1,3})KT((?:\s+\d{3,5})+)", rest, re.ASCII)
    if not m:
        return None, None, None, None
    n = [int(x) for x in m[3].split()]
    return int(m[1]), int(m[2]), (int(m[1]) + 180) % 360, (-n[1] / 100, n[0] / 100) if len(n) > 1 else None


def test_motion_is_matched_once(spark, tmp_path):
    near = "LAT...LON 3000 8600 3030 8600 3030 8650"
    move = "TIME...MOT...LOC 0041Z {}DEG\n{}KT 3010"
    edges = [f"{near}{gap * 'x'}{move.format(200, 25)}{tail}" for gap in (0, 399, 400, 401, 550) for tail in ("", " 8620", "\r\n8620 3011", "1 862015")]
    rows = odd_bulletins(600, 5) + [(1000 + i, t) for i, t in enumerate(edges + [f"{near}\n{near}\n{move.format(0, 0)} 000"])]
    df = spark.createDataFrame(rows, "bulletin_id int, text string")
    moves = lambda p: (p.deg, p.kt, p.heading, p.loc and tuple(p.loc))
    got = [(x.bulletin_id, x.text, None if x.p is None else [(p.pos, plain(p.ring), *moves(p)) for p in x.p]) for x in df.select("*", B.polygons(F.col("text")).alias("p")).collect()]
    want = [(i, t, None if t is None else [(pos, ring, *motion_of(t[end : end + 600])) for pos, ring, end in polygons_of(t)]) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr) and sum(p[2] is not None for w in want for p in w[2] or []) > 20
    # The same motion goes with an event code before the polygon.
    code = "/O.NEW.KMOB.TO.W.0001.240101T0000Z-240102T0100Z/"
    own = A.segments(df.select("bulletin_id", F.concat(F.lit(code), "text").alias("text"))).filter("pos = 1")
    first = {t: polygons_of(t)[0] for _, t in rows if t is not None and polygons_of(t)}
    want = [(i, motion_of(t[first[t][2] :][:600]) if t in first else (None,) * 4) for i, t in rows if t is not None]
    assert sorted([(x.bulletin_id, moves(x.motion) if x.motion else (None,) * 4) for x in own.collect()], key=repr) == sorted(want, key=repr)
    spark.createDataFrame([(k,) for k in [*range(50), 3, 3, None]], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    for parsed in (df.select(B.polygons(F.col("text")).alias("p")), P.motion_parse(spark, str(tmp_path))):
        assert plan(parsed).count(r"TIME\.\.\.MOT") == 1 and plan(parsed).count(r"LAT\.\.\.LON") == 1
    assert P.motion_parse(spark, str(tmp_path)).filter("bulletin_id = 3").count() == 3
