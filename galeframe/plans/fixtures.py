"""Weather-shaped views over the test tables. Each column is one expression that both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from galeframe.sources.shared import spread

#: view -> (table, columns)
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "gate": ("lineitem", {
        "site": "l_suppkey % 2", "vol": "l_orderkey % 12", "sweep": "l_linenumber",
        "el_deg": "0.48e0 + 0.70e0 * (l_linenumber - 1)", "az_deg": "((l_partkey * 7 + l_orderkey) % 360) + 0.5e0",
        "range_m": "2125e0 + 250e0 * ((l_orderkey * 13 + l_linenumber * 101) % 590)", "dbz": "l_quantity + 15e0"}),
    "flash": ("events", {
        "flash_id": "event_id", "flash_time": "ts", "satellite": "CASE WHEN event_id % 2 = 0 THEN 'G19' ELSE 'G18' END",
        "lat": "25e0 + ((event_id * 7919) % 13000) / 1000e0", "lon": "-95e0 + ((event_id * 104729) % 17000) / 1000e0", "energy": "value"}),
    "obs": ("events", {
        "obs_id": "event_id", "site": "CAST(floor(user_id / 40) AS BIGINT) % 2", "track_id": "user_id % 40", "family_id": "user_id % 8", "vol": "event_id % 240",
        "seed_x": "-120000e0 + (user_id % 40) * 3000e0 + (event_id % 240) * 1500e0 + ((event_id * 7919) % 4000)",
        "seed_y": "-60000e0 + (user_id % 40) * 1500e0 + (event_id % 240) * 500e0 + ((event_id * 104729) % 4000)",
        "area": "4e0 + value", "dbz": "30e0 + event_id % 41", "top": "3e0 + (event_id % 21) / 2e0",
        "split_from": "CASE WHEN event_id % 11 = 0 THEN (user_id + 1) % 40 END"}),
    "report": ("orders", {
        "report_id": "o_orderkey", "site": "CAST(floor(o_orderkey / 3) AS BIGINT) % 2", "vol": "o_orderkey % 240", "x": "-120000e0 + ((o_orderkey * 6007) % 500000)",
        "y": "-60000e0 + ((o_orderkey * 3001) % 250000)", "kind": "substr('THGDWX', CAST(o_orderkey % 6 + 1 AS INT), 1)"}),
    "metric": ("events", {
        "metric_id": "event_id", "name": "event_type", "ts": "ts", "site": "user_id % 3", "value": "value",
        "counter": "(row_number() OVER (PARTITION BY event_type ORDER BY event_id) * 3) % 500"}),
    "pixel": ("lineitem", {
        "frame": "l_orderkey % 120", "band": "7 + 3 * (l_orderkey % 3)", "row_no": "(l_partkey * 31 + l_orderkey * 17) % 64", "col_no": "(l_suppkey * 29 + l_orderkey * 7 + l_linenumber) % 64",
        "level": "(l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 256"}),
    "unit": ("events", {
        "unit_id": "event_id",
        "body": "CASE WHEN event_id % 97 = 0 THEN '{\"site\": ' ELSE concat('{\"site\":\"K', CAST(user_id % 20 AS VARCHAR(9)), '\",\"volume_epoch\":', CAST(1704067200 + event_id * 300 AS VARCHAR(20)), ',\"vcp\":', CAST(CASE event_id % 4 WHEN 0 THEN 35 WHEN 1 THEN 12 WHEN 2 THEN 212 ELSE 215 END AS VARCHAR(5)), '}') END"}),
    "chunk": ("lineitem", {
        "volume": "l_orderkey", "chunk_no": "l_linenumber", "kind": "CASE l_linenumber WHEN 1 THEN 'S' WHEN 7 THEN 'E' ELSE 'I' END", "vcp": "CASE l_orderkey % 4 WHEN 0 THEN 35 WHEN 1 THEN 12 WHEN 2 THEN 212 ELSE 215 END"}),
    "bulletin": ("orders", {
        "bulletin_id": "o_orderkey",
        "text": "concat('FLZ201>206-ALZ051-0', CAST(52 + o_orderkey % 30 AS VARCHAR(3)), '-GAC00', CAST(1 + o_orderkey % 9 AS VARCHAR(3)), '-072000-', chr(10), '/O.', "
                "CASE o_orderkey % 7 WHEN 0 THEN 'NEW' WHEN 1 THEN 'CON' WHEN 2 THEN 'CAN' WHEN 3 THEN 'EXP' WHEN 4 THEN 'EXT' WHEN 5 THEN 'NEW' ELSE 'UPG' END, '.', "
                "CASE o_orderkey % 3 WHEN 0 THEN 'KMOB' WHEN 1 THEN 'KTAE' ELSE 'KJAN' END, '.', "
                "CASE o_orderkey % 5 WHEN 0 THEN 'TO' WHEN 1 THEN 'SV' WHEN 2 THEN 'FF' WHEN 3 THEN 'MA' ELSE 'WI' END, '.', "
                "CASE floor(o_orderkey / 5) % 3 WHEN 0 THEN 'W' WHEN 1 THEN 'A' ELSE 'Y' END, '.', lpad(CAST(o_orderkey % 400 + 1 AS VARCHAR(5)), 4, '0'), '.2401', lpad(CAST(1 + CAST(floor(o_orderkey / 1440) AS BIGINT) % 28 AS VARCHAR(12)), 2, '0'), 'T', lpad(CAST(o_orderkey % 24 AS VARCHAR(3)), 2, '0'), lpad(CAST(o_orderkey % 60 AS VARCHAR(3)), 2, '0'), 'Z-2401', lpad(CAST(2 + CAST(floor(o_orderkey / 1440) AS BIGINT) % 28 AS VARCHAR(12)), 2, '0'), 'T', lpad(CAST((o_orderkey * 7) % 24 AS VARCHAR(3)), 2, '0'), '00Z/', chr(10), "
                "CASE WHEN o_orderkey % 4 = 0 THEN 'no polygon' ELSE concat('LAT...LON ', CAST(3000 + o_orderkey % 400 AS VARCHAR(5)), ' ', CAST(8600 + o_orderkey % 300 AS VARCHAR(5)), ' ', CAST(3030 + o_orderkey % 400 AS VARCHAR(5)), ' ', CAST(8600 + o_orderkey % 300 AS VARCHAR(5)), ' ', CAST(3030 + o_orderkey % 400 AS VARCHAR(5)), ' ', CAST(8650 + o_orderkey % 300 AS VARCHAR(5)), chr(10), "
                "CASE WHEN o_orderkey % 8 = 5 THEN 'no motion' ELSE concat('TIME...MOT...LOC 0041Z ', CAST(o_orderkey % 360 AS VARCHAR(4)), 'DEG ', CAST(5 + o_orderkey % 40 AS VARCHAR(4)), 'KT ', CAST(3010 + o_orderkey % 400 AS VARCHAR(5)), ' ', CAST(8620 + o_orderkey % 300 AS VARCHAR(5))) END) END, chr(10))"}),
}


def columns_sql(view: str) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in VIEWS[view][1].items())


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = VIEWS[name]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    rows = spread(rows) if name == "bulletin" else rows  # parsing costs far more than a row
    return rows.selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def with_views(*names: str) -> str:
    """The head of a query, with the views as CTEs; further CTEs may follow a comma."""
    return "WITH " + ", ".join(f"{n} AS (SELECT {columns_sql(n)} FROM {VIEWS[n][0]})" for n in names)
