import datetime
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from galeframe.operators.alerts import active, alert_state, segments
from galeframe.operators.tracker import Tracker, TrackerParams
from galeframe.plans.fixtures import view
from galeframe.plans.streams import finished, storm_tracks, stream_hazards, stream_tracks
from galeframe.sources.manifest import Published
from galeframe.sources.shared import new_folder, put_batch
from galeframe.streaming import live as S

SF = "/root/testdata/sf0.001"


def test_stream_tracks_like_the_batch(spark):
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.select("site", "t", "cell_id", "cell_uid", "family_uid", "split_from", F.round("age_min", 6)).collect())))
    assert rows(stream_tracks(spark, SF)) == rows(storm_tracks(spark, SF))


def test_volumes_in_several_batches_track_alike(spark):
    rnd = random.Random(1)
    cells = [(k % 2, 300 * v, i, 1000.0 * v + 40_000 * i + rnd.uniform(-500, 500), 500.0 * v, 20.0 + i, 45.0 + v) for k in range(2) for v in range(20) for i in range(4) if rnd.random() > 0.1]
    schema = "site int, t double, cell_id long, x double, y double, area double, dbz double"
    cells = [(a, float(b), *c) for a, b, *c in cells]
    table, where = new_folder(spark, "cells"), new_folder(spark, "out")
    for part in range(4):
        spark.createDataFrame([c for c in cells if int(c[1]) // 1500 == part], schema).coalesce(1).write.mode("append").parquet(table)
    q = S.tracked(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(table)).writeStream.foreachBatch(put_batch(where)).option("checkpointLocation", where + "-c").trigger(availableNow=True).start()
    q.awaitTermination()
    from galeframe.operators.tracker import track

    key = lambda df: sorted((r.site, r.t, r.cell_id, r.cell_uid) for r in df.collect())
    assert key(spark.read.parquet(where)) == key(track(spark.createDataFrame(cells, schema)))


def test_split_inherits_and_identity_lasts():
    t = Tracker(TrackerParams())
    seen = []
    for k in range(9):
        x = 3000.0 * k
        cells = [(1, x, 0.0, 600.0, 55.0)] if k < 3 or k > 5 else [(1, x, 2000.0, 320.0, 54.0), (2, x, -9000.0, 300.0, 53.0)]
        seen.append({r["cell_id"]: r for r in t.update(300.0 * k, cells)})
    assert len({s[1]["cell_uid"] for s in seen}) == 1 and len({r["family_uid"] for s in seen for r in s.values()}) == 1
    assert seen[8][1]["age_min"] == 40.0 and seen[4][1]["area_trend"] is not None


def test_daughter_is_known_by_its_footprint():
    box = lambda y, x, h, w: frozenset((a, b) for a in range(y, y + h) for b in range(x, x + w))
    t = Tracker(TrackerParams())
    t.update(0.0, [(1, 0.0, 0.0, 100.0, 50.0, box(0, 0, 10, 10))])
    rows = {r["cell_id"]: r for r in t.update(300.0, [(1, 100.0, 0.0, 50.0, 50.0, box(0, 0, 10, 5)), (2, 5000.0, 0.0, 40.0, 50.0, box(0, 6, 10, 4)), (3, 90_000.0, 0.0, 9.0, 50.0, box(0, 90, 3, 3))])}
    assert rows[2]["split_from"] == rows[1]["cell_uid"] and rows[2]["age_min"] == 5.0 and rows[3]["split_from"] is None


def test_empty_volume_and_retirement():
    t = Tracker(TrackerParams(retire_min=10))
    a = t.update(0.0, [(1, 0.0, 0.0, 5.0, 40.0)])[0]["cell_uid"]
    assert t.update(300.0, []) == [] and t.update(600.0, [(1, 100.0, 0.0, 5.0, 40.0)])[0]["cell_uid"] == a
    assert t.update(6000.0, [(1, 9e6, 0.0, 5.0, 40.0)])[0]["cell_uid"] != a and a not in t.cells.nodes


def test_contested_uid_goes_to_more_votes():
    from galeframe.operators.tracker import Level

    level = Level()
    level.reconciled({0: [(0.0, 1), (1.0, 1), (2.0, 1)]})
    got = level.reconciled({5: [(0.0, 1)], 6: [(1.0, 1), (2.0, 1)], 7: [(9.0, 9)]})
    assert got == {6: (1, None), 5: (2, 1), 7: (3, None)} or got == {6: (1, None), 7: (2, None), 5: (3, 1)}


def test_hazard_stream_ends_in_the_batch_state(spark):
    events = stream_hazards(spark, SF)
    last = {r.key: r.kind for r in events.groupBy("key").agg(F.max_by("kind", "seq").alias("kind")).collect()}
    batch = {r.key for r in active(alert_state(segments(view(spark, SF, "bulletin")), ["bulletin_id"])).collect()}
    assert {k for k, kind in last.items() if kind != "removed"} == batch


def hazard_batches(spark, batches):
    """The events of batches of (bulletin_id, text), each a file of its own."""
    table, where = new_folder(spark, "bulletins"), new_folder(spark, "hazards")
    for rows in batches:
        spark.createDataFrame(rows, "bulletin_id bigint, text string").coalesce(1).write.mode("append").parquet(table)
        time.sleep(0.05)
    stream = spark.readStream.schema("bulletin_id bigint, text string").option("maxFilesPerTrigger", 1).parquet(table)
    rows = segments(stream).select("key", F.col("bulletin_id").alias("seq"), "pos", "action", F.array_join("ugc", ",").alias("ugc"), F.to_json("poly.ring").alias("ring"))
    finished(S.hazard_events(rows), put_batch(where), "append", where)
    return [(r.seq, r.kind, r.ugc) for r in S.last_events(spark.read.parquet(where)).orderBy("seq", "pos").collect()]


def bulletin(*parts):
    return "".join(f"{zone}-072000-\n/O.{action}.KMOB.TO.W.0001.240101T0000Z-240102T0000Z/\n" for zone, action in parts)


def test_cancelled_zones_and_the_rest_of_one_bulletin(spark):
    texts = [(1, bulletin(("FLZ201", "NEW"))), (2, bulletin(("FLZ201", "CAN"), ("FLZ202", "CON")))]
    assert hazard_batches(spark, [texts]) == [(1, "new", "FLZ201"), (2, "removed", "FLZ201"), (2, "update", "FLZ202")]
    state = active(alert_state(segments(spark.createDataFrame(texts, "bulletin_id bigint, text string")), ["bulletin_id", "pos"])).collect()
    assert [(r.bulletin_id, r.action) for r in state] == [(2, "CON")]


def test_late_segments_take_their_place(spark):
    texts = [(i, bulletin((f"FLZ{200 + i}", a))) for i, a in enumerate(["NEW", "CON", "CAN", "CAN", "NEW", "EXT"], 1)]
    want = hazard_batches(spark, [texts])
    assert [w[:2] for w in want] == [(1, "new"), (2, "update"), (3, "removed"), (5, "new"), (6, "update")]
    assert hazard_batches(spark, [[texts[i]] for i in (3, 5, 0, 4, 2, 1)]) == want


def test_hazards_of_a_shuffled_table_of_many_files(spark):
    folder = new_folder(spark, "orders-in-files")
    spark.read.parquet(f"{SF}/orders.parquet").orderBy(F.xxhash64("o_orderkey")).repartition(7).write.parquet(f"{folder}/orders.parquet")
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    assert rows(stream_hazards(spark, folder)) == rows(stream_hazards(spark, SF))


def test_late_volumes_go_out_without_identity(spark):
    table, where = new_folder(spark, "cells"), new_folder(spark, "out")
    schema = "site int, t double, cell_id long, x double, y double, area double, dbz double"
    for t in (0.0, 600.0, 300.0):
        spark.createDataFrame([(1, t, 7, 0.0, 0.0, 9.0, 50.0)], schema).coalesce(1).write.mode("append").parquet(table)
        time.sleep(0.05)
    finished(S.tracked(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(table)), put_batch(where), "append", where)
    assert sorted((r.t, r.cell_uid is None) for r in spark.read.parquet(where).collect()) == [(0.0, False), (300.0, True), (600.0, False)]


def units(spark, *rows):
    return spark.createDataFrame([(json.dumps({"site": s, "volume_epoch": e, "vcp": 12}) if e is not None else s,) for s, e in rows], "body string")


def of(tables, name, *columns, latest=False):
    return sorted(tuple(r[c] for c in columns) for r in (tables.latest(name) if latest else tables.table(name)).collect())


def test_units_are_delivered_again(spark):
    """One fails in two batches and works in the third, one never works; each waits until it has been idle long enough."""
    root, clock, made = new_folder(spark, "units"), [1000.0], []
    fails = {"SLOW": 2, "DEAD": 9}

    def work(df):
        made.extend((r.site, r.delivery) for r in df.collect())
        bad = F.coalesce(*(F.when((F.col("site") == s) & (F.col("delivery") <= n), True) for s, n in fails.items()))
        return df.withColumn("failed", bad)

    put, tables = S.unit_sink(spark, root, work, idle_s=600, clock=lambda: clock[0]), Published(spark, root)
    put(units(spark, ("SLOW", 1), ("DEAD", 2), ("FINE", 3), ("FINE", 3), ("{oops", None), (None, None)), 0)
    put(units(spark, ("SLOW", 1), ("FINE", 3)), 0)  # runs again: nothing changes
    assert of(tables, "done", "site", "delivery") == [("FINE", 1)] and len(of(tables, "pending", "site", latest=True)) == 2
    clock[0] += 599
    put(units(spark, ("SLOW", 1), ("LATER", 4)), 1)
    assert of(tables, "pending", "site", "delivery", latest=True) == [("DEAD", 1), ("SLOW", 1)]
    for n, wait in ((2, 1), (3, 600)):
        clock[0] += wait
        put(units(spark), n)
    assert of(tables, "done", "site", "delivery") == [("FINE", 1), ("LATER", 1), ("SLOW", 3)]
    assert of(tables, "dead", "site", "delivery", "dropped_at", latest=True) == [("DEAD", 3, 2200.0)] and of(tables, "pending", "site", latest=True) == []
    assert sorted(str(r.body) for r in tables.table("malformed").collect()) == ["None", "{oops"]
    put(units(spark, ("DEAD", 2), ("SLOW", 1)), 4)  # neither is taken anew
    runs = [m for m in made if m[0] in ("SLOW", "DEAD", "LATER")]
    assert sorted(set(runs)) == [("DEAD", 1), ("DEAD", 2), ("DEAD", 3), ("LATER", 1), ("SLOW", 1), ("SLOW", 2), ("SLOW", 3)]


def test_a_batch_that_dies_publishes_nothing(spark):
    root = new_folder(spark, "units")
    dies = lambda df: df.withColumn("failed", F.when(F.col("site") == "B", F.raise_error(F.lit("killed")).cast("boolean")).otherwise(False))
    with pytest.raises(Exception, match="killed"):
        S.unit_sink(spark, root, dies)(units(spark, ("A", 1), ("B", 2)), 0)
    tables = Published(spark, root)
    assert tables.batches() == [] and tables.table("done") is None
    S.unit_sink(spark, root, lambda df: df.withColumn("failed", F.lit(None).cast("boolean")))(units(spark, ("A", 1), ("B", 2)), 0)
    assert of(tables, "done", "site") == [("A",), ("B",)]


def test_tables_of_a_batch_are_published_together(spark):
    tables = Published(spark, new_folder(spark, "storms"))
    cells, families = spark.createDataFrame([(1, 2.5)], "cell int, dbz float"), spark.createDataFrame([("f",)], "family string")
    with pytest.raises(Exception, match="dies here"):
        tables.commit(0, {"cells": cells, "families": families.withColumn("n", F.raise_error(F.lit("dies here")))})
    assert tables.table("cells") is None and tables.table("families") is None
    assert tables.commit(0, {"cells": cells, "families": families}) and not tables.commit(0, {"cells": cells.limit(0), "families": families})
    # A column is added and two are widened; both batches stay readable, a change of kind is refused.
    tables.commit(1, {"cells": spark.createDataFrame([(2**40, 3.25, "x")], "cell bigint, dbz double, note string"), "families": families})
    with pytest.raises(TypeError, match="can't change"):
        tables.commit(2, {"cells": spark.createDataFrame([("a",)], "cell string")})
    out = tables.table("cells")
    assert out.dtypes == [("cell", "bigint"), ("dbz", "double"), ("note", "string")]
    assert sorted(map(tuple, out.collect())) == [(1, 2.5, None), (2**40, 3.25, "x")]
    tables.merged()
    assert tables.batches() == [0, 1] and len(tables._files()) == 1 and tables.table("families").count() == 2


def test_metrics_equal_the_rows(spark):
    from galeframe.streaming import metrics as M

    table, root = new_folder(spark, "unit-files"), new_folder(spark, "units")
    rows = [(json.dumps({"site": f"S{i}", "volume_epoch": i, "vcp": 12}) if i % 7 else "{oops",) for i in range(60)]
    spark.createDataFrame(rows, "body string").repartition(3).write.parquet(table)
    stream = spark.readStream.schema("body string").option("maxFilesPerTrigger", 1).parquet(table)
    with M.recorded(spark) as seen:
        finished(M.observed(stream, "units", {"malformed": F.col("body").startswith("{oops")}), S.unit_sink(spark, root, lambda df: df.withColumn("failed", F.lit(False))), "append", root)
    got = {(r["name"], r["le"]): r["value"] for r in seen.rows()}
    assert got["units_rows_total", None] == 60 and got["units_malformed_total", None] == 9 and got["batches_total", None] == 3
    assert got["batch_seconds_bucket", float("inf")] == got["batch_seconds_count", None] == 3
    steps = [v for (n, le), v in sorted(got.items(), key=str) if n == "batch_seconds_bucket"]
    assert max(steps) == 3
    where = new_folder(spark, "metrics")
    seen.write(where)
    assert spark.read.parquet(where).count() == len(seen.rows())


def test_hazards_by_event_time_hold_little(spark):
    """Out of order within the delay, ended by the watermark; what is left as state is what is active or not yet due."""
    from galeframe.streaming import hazards as H

    table, where = new_folder(spark, "segments"), new_folder(spark, "events")
    schema = "key string, seq bigint, pos int, action string, ugc string, ring string, at timestamp, ends timestamp"
    at = lambda m: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    first = [("a", 2, 0, "CON", "Z2", None, at(5), at(60)), ("a", 1, 0, "NEW", "Z1", "R1", at(1), at(60)), ("b", 3, 0, "NEW", "Z3", None, at(6), None), ("c", 4, 0, "NEW", "Z4", None, at(7), at(20))]
    then = [("clock", 9, 0, "NEW", "Z", None, at(120), at(500)), ("a", 8, 0, "CAN", "Z1", None, at(30), at(60)), ("c", 7, 0, "CON", "Z4", "R4", at(25), at(40))]
    last = [("clock", 10, 0, "CON", "Z", None, at(240), at(500)), ("b", 5, 0, "CAN", "Z3", None, at(10), None)]  # the second is far too late
    for rows in (first, then, last):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(table)
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(table)
    with H.state_in_rocksdb(spark):
        finished(H.hazards_by_time(stream, "30 minutes"), put_batch(where), "append", where)
    got = sorted((r.key, r.seq, r.kind, r.ugc, r.ring) for r in spark.read.parquet(where).collect())
    assert got == sorted([("a", 1, "new", "Z1", "R1"), ("a", 2, "update", "Z2", "R1"), ("a", 8, "removed", "Z2", "R1"), ("b", 3, "new", "Z3", None), ("c", 4, "new", "Z4", None), ("c", 4, "expired", "Z4", None), ("c", 7, "update", "Z4", "R4"), ("c", 7, "expired", "Z4", "R4"), ("clock", 9, "new", "Z", None)])


def test_hazards_expire_by_the_clock(spark):
    table, where = new_folder(spark, "segments"), new_folder(spark, "events")
    schema = "key string, seq bigint, pos int, action string, ugc string, ring string, ends double"
    now = time.time()
    rows = [("past", 1, 0, "NEW", "A", None, now - 60), ("soon", 2, 0, "NEW", "B", None, now + 8), ("open", 3, 0, "NEW", "C", None, None), ("gone", 4, 0, "NEW", "D", None, now + 3), ("gone", 5, 0, "CAN", "D", None, now + 3)]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(table)
    stream = spark.readStream.schema(schema).parquet(table).withColumn("ends", F.timestamp_seconds("ends"))
    q = S.hazard_events(stream, expire=True).writeStream.foreachBatch(put_batch(where)).option("checkpointLocation", where + "-c").trigger(processingTime="1 second").start()
    seen = lambda: sorted((r.key, r.kind) for r in S.last_events(spark.read.parquet(where)).collect())
    want = sorted([("past", "new"), ("past", "expired"), ("soon", "new"), ("soon", "expired"), ("open", "new"), ("gone", "new"), ("gone", "removed")])
    try:
        for _ in range(60):
            time.sleep(1)
            if q.lastProgress and q.lastProgress["batchId"] > 1 and seen() == want:
                break
    finally:
        q.stop()
    assert seen() == want


def test_announcement_and_settings(spark):
    df = spark.createDataFrame([(1, 0.0, i, 0.0, 0.0, float(i)) for i in range(9)], "site int, t double, cell_id long, x double, y double, dbz double")
    body = json.loads(S.announcement(df, 3).first().body)
    assert body["n"] == 9 and [c["cell_id"] for c in body["cells"]] == [8, 7, 6]
    assert S.settings_hash({"b": 1, "a": 2}) == S.settings_hash({"a": 2, "b": 1}) and len(S.settings_hash({})) == 16


def test_volumes_stream_past_their_site_in_order(spark):
    from galeframe.operators.ordered import by_volume

    rows = [(s, float(t), c) for s in (1, 2, None) for t in range(40) for c in range(3)] + [(1, None, 7), (2, float("nan"), 7)]
    table = spark.createDataFrame(rows, "site long, t double, cell_id long").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def feed(seen, pdf):
        seen += pdf["t"].drop_duplicates().tolist()
        assert seen == sorted(seen) and (pdf.groupby("t").size() == 3).all()
        return pdf[["t"]].assign(n=len(seen)).drop_duplicates("t")

    for size in (7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = by_volume(table, list, feed, "t double, n long", 100.0).collect()
        assert sorted((str(r.site), r.t) for r in got) == sorted((str(s), float(t)) for s in (1, 2, None) for t in range(40))
        assert {(str(r.site), r.n) for r in got if r.t == 39} == {("1", 40), ("2", 40), ("None", 40)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert by_volume(table.limit(0), list, feed, "t double, n long", 100.0).collect() == []


def test_episodes_track_like_one_history(spark):
    """A site's episodes run apart and get the numbers that one pass over its whole history gives."""
    from galeframe.operators import overlap as O
    from galeframe.operators.tracker import run_volumes, track

    rnd, rows = random.Random(7), []
    for site in ("a", "b", None):
        t = 0.0
        for _ in range(60):
            t += rnd.choice((300.0, 300.0, 300.0, 600.0, 4000.0, 9000.0))
            for i in range(rnd.randint(1, 5)):
                y, x = rnd.randint(0, 20), rnd.randint(0, 20)
                rows.append((site, t, i, 8000.0 * x + rnd.uniform(0, 500), 8000.0 * y, rnd.uniform(4, 40), 50.0 + i, [y, y + 1], [x, x]))
    rows += [("a", None, 1, 0.0, 0.0, 1.0, 1.0, [0], [0]), ("a", 300.0, None, 0.0, 0.0, 1.0, 1.0, [0], [0])]
    schema = "site string, t double, cell_id long, x double, y double, area double, dbz double, pix_y array<long>, pix_x array<long>"
    cells = spark.createDataFrame(rows, schema).repartition(5)
    pdf = cells.toPandas().sort_values(["t", "cell_id"])
    plain = lambda v: None if v is None or v != v else v
    want, moved = set(), set()
    for site in ("a", "b", None):
        own = pdf[pdf["site"].isna() if site is None else pdf["site"] == site].dropna(subset=["t"])
        want |= {(site, r["t"], r["cell_id"], r["cell_uid"], r["family_uid"], plain(r["split_from"])) for r in run_volumes(Tracker(TrackerParams()), own.drop(columns="site"))}
        o, last = O.OverlapTracker(), None
        for t, volume in own.groupby("t"):
            if last is not None and t - last > 3600:
                o.active = {}
            last = t
            moved |= {(site, *r[:5]) for r in O.run_volumes(o, volume)[0]}
    names = ("site", "t", "cell_id", "cell_uid", "family_uid", "split_from")
    assert {tuple(r[c] for c in names) for r in track(cells).collect()} == want
    assert {(r.site, r.t, r.cell_id, r.track_id, r.lineage_id, r.split_from) for r in O.overlap_tracks(cells).collect()} == moved
    from galeframe.operators.ordered import with_episodes

    assert with_episodes(cells.filter("t IS NOT NULL"), 3600.0).select("site", "episode").distinct().count() > 20
    births = O.overlap_tracks(cells, events=True).filter("kind = 'birth'").count()
    assert births == len({(m[0], m[4]) for m in moved})  # a birth for each lineage
    assert track(cells.limit(0)).count() == 0 and O.overlap_tracks(cells.limit(0)).count() == 0
