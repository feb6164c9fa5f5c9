"""Binary messages made from the events table, and layers written and read back."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundlake.checks.base import check, micros, r, raster, table
from soundlake.checks.cubes import RANKED, TID, ranked
from soundlake.operators import cube as C
from soundlake.operators import raster as RA
from soundlake.operators.lineage import cut, scratch
from soundlake.plans import jobs
from soundlake.sources import sonar, text


def message(kind: int, subsys: int, channel: int, payload: bytes) -> bytes:
    return struct.pack("<HHHBBBBHI", 0x1601, 0, kind, 0, subsys, channel, 0, 0, len(payload)) + payload


def sonar_payload(us: int, value: float, i: int, n: int, fmt: int) -> bytes:
    p = bytearray(240)

    def put(name: str, v) -> None:
        off, f = sonar.SONAR_FIELDS[name]
        struct.pack_into(f, p, off, v)

    put("sec", us // 1_000_000)
    put("usec", us % 1_000_000)
    put("validity", i % 1024)
    put("weight", i % 3)
    put("ns", 20480)
    put("start10", 200 + i % 50)
    put("end10", 900 + i % 50)
    put("msb", (i % 5) * 16 + i % 3)
    put("lsb2", (i * 37) % 65536)
    put("sweep", 10 + i % 4)
    put("centre", 0.0 if i % 4 == 0 else 230000.0)
    put("raw_x", 0 if i % 6 == 0 else 72_480_000 + i)
    put("raw_y", 13_290_000 + i)
    put("units", 1 + i % 2)
    put("depth_mm", int(value * 100))
    put("alt_mm", int(value * 50) - 900)
    put("heave", 0.25 * (i % 8))
    put("data_format", fmt)
    return bytes(p) + (np.arange(n) * 3 + i % 100).astype("<u2").tobytes()


def record(us: int, value: float, i: int, kind: str) -> bytes:
    if kind == "view":
        return message(80, 20 + i % 2, i % 2, sonar_payload(us, value, i, 4 + i % 3, 0))
    if kind == "click":
        return message(80, 0, 0, sonar_payload(us, value, i, 4 + 2 * (i % 2), (0, 1, 9)[i % 3]))
    when = struct.pack("<II", us // 1_000_000, us % 1_000_000 // 1000)
    if kind == "error":
        body = bytearray(40)
        body[:8] = when
        struct.pack_into("<hhxxxxhHi", body, 24, i % 2000 - 1000, i % 500, i % 300 - 150, i % 36000, (i % 4) << 6)
        return message(2020, 0, 0, bytes(body))
    mm = f"{2200 + (i % 600) / 10:.4f}"
    line = f"$GPGGA,120000,{mm},{'N' if i % 2 else 'S'},12042.5000,E,1,08" if kind == "signup" else f"$GPRMC,120000,A,{mm},N,12042.5000,W,5.0,90,010124"
    return message(2002, 0, 0, when + b"\0" * 4 + line.encode() + b"\r\n")


def blobs(spark, d, days=3):
    """Per line and so many days: a byte stream of messages with garbage before every seventh one."""
    e = table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("line"), micros("ts").alias("us"), "value", F.col("event_type").alias("kind"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for i, us, v, k in zip(p["id"], p["us"], p["value"], p["kind"]):
                junk = b"\x01junk\x16\x01" if i % 7 == 0 else b""
                out.append(junk + record(int(us), float(v), int(i), k))
            yield pd.DataFrame({"id": p["id"], "line": p["line"], "us": p["us"], "b": out})

    m = e.mapInPandas(pack, "id long, line long, us long, b binary")
    parts = F.array_sort(F.collect_list(F.struct("id", "b")))
    g = m.groupBy("line", F.floor(F.col("us") / (days * 86400 * 1000000)).alias("slot")).agg(parts.alias("p"))
    hexes = F.array_join(F.transform("p", lambda x: F.hex(x["b"])), "")
    return g.select(F.concat_ws("/", "line", "slot").alias("name"), F.unhex(hexes).alias("blob"))


def messages(spark, d):
    return sonar.scan_blobs(blobs(spark, d), "name", "blob")


def files(spark, d, days=3):
    """The same streams as files in the shared folder: (path, length)."""
    folder = scratch(spark, "jsf")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for p in batches:
            for name, blob in zip(p["name"], p["blob"]):
                uri = sonar.arrow_uri(f"{folder}/{name}.jsf")
                system, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
                system.create_dir(path.rpartition("/")[0])
                with system.open_output_stream(path) as f:
                    f.write(blob)
            yield pd.DataFrame({"path": [f"{folder}/{n}.jsf" for n in p["name"]], "length": [len(b) for b in p["blob"]]})

    return cut(blobs(spark, d, days).mapInPandas(put, "path string, length long"), "files")


def indexed(spark, d):
    return cut(sonar.index_files(files(spark, d)), "index")


def name():
    """The file's stream, without folder and ending."""
    return F.regexp_extract("file", "([^/]+/[^/]+)[.]jsf$", 1).alias("file")


SLOT = "user_id || '/' || CAST(floor(epoch_us(ts) / (3 * 86400 * 1000000.0)) AS BIGINT) AS file"
EV = f"""ev AS (SELECT event_id AS i, epoch_us(ts) AS us, value AS v, event_type AS kind, {SLOT}, row_number() OVER (PARTITION BY user_id, floor(epoch_us(ts) / (3 * 86400 * 1000000.0)) ORDER BY event_id) - 1 AS seq FROM events)"""


@check("s3_message_scan", "", f"""WITH {EV} SELECT file, seq, CASE WHEN kind IN ('view', 'click') THEN 80 WHEN kind = 'error' THEN 2020 ELSE 2002 END AS msg_type,
    CASE WHEN kind = 'view' THEN CAST(20 + i % 2 AS INTEGER) ELSE 0 END AS subsys, CASE WHEN kind = 'view' THEN CAST(i % 2 AS INTEGER) ELSE 0 END AS channel FROM ev""")
def _(spark, d):
    return messages(spark, d).select("file", "seq", "msg_type", "subsys", "channel")


@check("s3_file_index", "", f"""WITH {EV} SELECT file, seq, CASE WHEN kind IN ('view', 'click') THEN 80 WHEN kind = 'error' THEN 2020 ELSE 2002 END AS msg_type,
    CASE WHEN kind = 'view' THEN CAST(20 + i % 2 AS INTEGER) ELSE 0 END AS subsys, CASE WHEN kind = 'view' THEN CAST(i % 2 AS INTEGER) ELSE 0 END AS channel FROM ev""")
def _(spark, d):
    return indexed(spark, d).select(name(), "seq", "msg_type", "subsys", "channel")


@check("s3_split_index", "", """SELECT user_id || '/' || CAST(floor(epoch_us(ts) / (3000 * 86400 * 1000000.0)) AS BIGINT) AS file, row_number() OVER (PARTITION BY user_id, floor(epoch_us(ts) / (3000 * 86400 * 1000000.0)) ORDER BY event_id) - 1 AS seq,
    CASE WHEN event_type IN ('view', 'click') THEN 80 WHEN event_type = 'error' THEN 2020 ELSE 2002 END AS msg_type, CASE WHEN event_type = 'view' THEN CAST(20 + event_id % 2 AS INTEGER) ELSE 0 END AS subsys FROM events""")
def _(spark, d):
    """Long files, each cut into ranges of 4 kB."""
    return sonar.index_files(files(spark, d, 3000), span=4096).select(name(), "seq", "msg_type", "subsys")


BIT = "((i % 1024) >> {b}) & 1 = 1"


@check("s4_sidescan_pings", "", f"""WITH {EV} SELECT file, seq, CASE WHEN i % 2 = 0 THEN 'LF_port' ELSE 'HF_stbd' END AS channel, us / 1e6 AS t, ROUND(1489.073 * 20480 * 1e-9 / 2, 9) AS pix_m,
    CASE WHEN i % 4 = 0 THEN ((200 + i % 50) * 10 + (900 + i % 50) * 10) / 2 ELSE 230000.0 END::DOUBLE AS center_freq_hz, CASE WHEN {BIT.format(b=4)} THEN CAST(trunc(v * 100) AS INT) / 1000 ELSE 0 END AS depth_m,
    CASE WHEN {BIT.format(b=7)} THEN 0.25 * (i % 8) ELSE 0 END::DOUBLE AS heave_m, CASE WHEN {BIT.format(b=0)} AND i % 6 <> 0 THEN ROUND((13290000 + i) / CASE WHEN i % 2 = 1 THEN 600000.0 ELSE 1000.0 END::DOUBLE, 9) END AS lat,
    CASE WHEN {BIT.format(b=0)} AND i % 6 <> 0 THEN ROUND((72480000 + i) / CASE WHEN i % 2 = 1 THEN 600000.0 ELSE 1000.0 END::DOUBLE, 9) END AS lon, CAST(4 + i % 3 AS INTEGER) AS n,
    ROUND(list_sum(list_transform(range(4 + i % 3), lambda k: k * 3 + i % 100)) * pow(2, -(i % 3)), 6) AS amp_sum FROM ev WHERE kind = 'view'""")
def _(spark, d):
    p = sonar.sss_pings(indexed(spark, d))
    total = F.aggregate("amps", F.lit(0.0), lambda a, x: a + x)
    return p.select(name(), "seq", "channel", "t", r("pix_m", 9).alias("pix_m"), "center_freq_hz", "depth_m", "heave_m", r("lat", 9).alias("lat"), r("lon", 9).alias("lon"), F.size("amps").alias("n"), r(total).alias("amp_sum"))


@check("s5_subbottom_pings", "", f"""WITH {EV}, a AS (SELECT *, CASE WHEN {BIT.format(b=9)} THEN CAST(trunc(v * 100) AS INT) / 1000 ELSE 0 END::DOUBLE AS depth_m,
      CASE WHEN {BIT.format(b=6)} AND CAST(trunc(v * 50) AS INT) - 900 > 0 THEN (CAST(trunc(v * 50) AS INT) - 900) / 1000 END::DOUBLE AS altitude_m FROM ev WHERE kind = 'click')
    SELECT file, seq, us / 1e6 AS t, CAST((((i % 3) << 16) | (200 + i % 50)) * 10 AS INTEGER) AS start_freq_hz, CAST((((i % 5) << 16) | (900 + i % 50)) * 10 AS INTEGER) AS end_freq_hz, ROUND(10 + i % 4 + ((((i * 37) % 65536) >> 4) & 1023) / 1000, 6) AS sweep_ms,
    CAST(CASE WHEN i % 3 = 0 THEN 4 + 2 * (i % 2) ELSE (4 + 2 * (i % 2)) // 2 END AS INTEGER) AS n_samples, depth_m, altitude_m, ROUND(depth_m + altitude_m, 9) AS water_depth_m FROM a""")
def _(spark, d):
    p = sonar.sbp_pings(indexed(spark, d))
    return p.select(name(), "seq", "t", "start_freq_hz", "end_freq_hz", r("sweep_ms").alias("sweep_ms"), "n_samples", "depth_m", "altitude_m", r("water_depth_m", 9).alias("water_depth_m"))


@check("s6_attitude", "", f"""WITH {EV} SELECT file, us // 1000000 + (us % 1000000) // 1000 / 1000 AS t, ROUND((i % 2000 - 1000) * 180.0::DOUBLE / 32768, 9) AS pitch, ROUND((i % 500) * 180.0::DOUBLE / 32768, 9) AS roll,
    (i % 300 - 150) / 1000 AS heave_m, (i % 36000) / 100 AS heading FROM ev WHERE kind = 'error' AND i % 4 = 3""")
def _(spark, d):
    a = sonar.attitude(indexed(spark, d))
    return a.select(name(), "t", r("pitch", 9).alias("pitch"), r("roll", 9).alias("roll"), "heave_m", "heading")


@check("s7_navigation", "", f"""WITH {EV} SELECT file, us // 1000000 + (us % 1000000) // 1000 / 1000 AS t, ROUND(CASE WHEN kind = 'signup' AND i % 2 = 0 THEN -1 ELSE 1 END * (22 + (i % 600) / 600), 9) AS lat,
    ROUND(CASE WHEN kind = 'signup' THEN 1 ELSE -1 END * (120 + 42.5::DOUBLE / 60), 9) AS lon FROM ev WHERE kind IN ('signup', 'purchase')""")
def _(spark, d):
    n = sonar.navigation(indexed(spark, d))
    return n.select(name(), "t", r("lat", 9).alias("lat"), r("lon", 9).alias("lon"))


@check("s_georeferenced_pings")
def _(spark, d):
    m = cut(messages(spark, d), "messages")
    p = cut(sonar.sss_pings(m), "pings")
    g = sonar.georeferenced(p, sonar.attitude(m), sonar.navigation(m), F.floor(F.col("t") / 86400))
    return g.select("file", "seq", "channel", "pos_source", *[r(c).alias(c) for c in ("t", "pitch", "roll", "heading", "lat", "lon")])


# --- layers and lists, written and read back ----------------------------------------------------------------


@check("s10_layer_round_trip", "raster", """SELECT "row", col, CAST("row" // 256 AS INTEGER) AS tile_row, CASE WHEN col % 5 = 0 THEN -9999.0 ELSE z END::DOUBLE AS z FROM raster""")
def _(spark, d):
    path = scratch(spark, "layers")
    g = raster(spark, d)
    RA.write_layer(g.select("row", "col", F.when(F.col("col") % 5 != 0, F.col("z")).alias("value")), "depth", path)
    RA.write_layer(g.select("row", "col", (F.col("z") * 2).alias("value")), "other", path)
    back = RA.read_layer(spark, path, "depth")
    return back.select("row", "col", "tile_row", RA.with_sentinel(F.col("value"), "float32").alias("z"))


@check("s11_cube", "raster", """SELECT "row", col, 10 + (col + 0.5)::DOUBLE AS x, 200 - ("row" + 0.5)::DOUBLE AS y, z AS depth, CASE WHEN col % 3 <> 0 THEN CAST(floor(z) AS INTEGER)::DOUBLE END AS cls FROM raster""")
def _(spark, d):
    g = raster(spark, d)
    a = g.select(F.lit("depth").alias("layer"), "row", "col", F.col("z").alias("value"))
    b = g.select(F.lit("cls").alias("layer"), "row", "col", F.when(F.col("col") % 3 == 0, -1.0).otherwise(F.floor("z")).cast("double").alias("value"))
    dim = spark.createDataFrame([("depth", "m", "float32", "continuous", ""), ("gone", "", "float32", "continuous", ""), ("cls", "", "int8", "categorical", "")], C.LAYER_SCHEMA)
    path = scratch(spark, "cube")
    C.write(jobs.build_cube(a.unionByName(b), dim, RA.Grid(10.0, 200.0, 1.0, 200, 100)), path)
    return C.read(spark, path)


BITS = 3  # parts of 8 x 8 cells
BOXES = [(12.4, 190.2, 31.0, 120.0), (-5.0, 300.0, 22.0, 195.5), (40.5, 170.5, 41.4, 169.6), (95.0, 60.0, 500.0, -80.0), (300.0, 10.0, 400.0, 0.0)]
BOX_ROWS = ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for i, (a, b, c, d) in enumerate(BOXES))


def stored_cube(spark, d):
    path = scratch(spark, "cube")
    g = raster(spark, d).withColumnRenamed("z", "depth")
    C.write(g, path, BITS)
    return path, RA.Grid(10.0, 200.0, 1.0, 10**6, 100)


@check("s11_cube_box", "raster", f"""WITH b(box, x0, y0, x1, y1) AS (VALUES {BOX_ROWS}) SELECT box::INTEGER AS box, "row", col, z AS depth FROM raster JOIN b ON 10 + (col + 0.5)::DOUBLE BETWEEN x0 AND x1 AND 200 - ("row" + 0.5)::DOUBLE BETWEEN y1 AND y0""")
def _(spark, d):
    path, grid = stored_cube(spark, d)
    found = [C.read_box(spark, path, grid, b, BITS).select(F.lit(i).alias("box"), "row", "col", "depth") for i, b in enumerate(BOXES)]
    return reduce(DataFrame.unionByName, found)


@check("s11_cube_pruning", "raster", f"""WITH b(box, x0, y0, x1, y1) AS (VALUES {BOX_ROWS}), p AS (SELECT DISTINCT "row" // 8 AS r, col // 8 AS c FROM raster),
    h AS (SELECT box, count(*) AS n FROM b JOIN p ON (r * 8 + 7) >= ceil(200 - y0 - 0.5) AND r * 8 <= floor(200 - y1 - 0.5) AND (c * 8 + 7) >= ceil(x0 - 10 - 0.5) AND c * 8 <= floor(x1 - 10 - 0.5) GROUP BY box)
    SELECT box::INTEGER AS box, coalesce(n, 0)::BIGINT AS files_read, (SELECT count(*) FROM p) AS files_present FROM b LEFT JOIN h USING (box)""")
def _(spark, d):
    """Files that a box reads, as the scan itself counts them, next to those present: one file a part."""
    path, grid = stored_cube(spark, d)
    present = C.stored_files(spark, path).where("rows > 0").count()
    return spark.createDataFrame([(i, files_read(C.read_box(spark, path, grid, b, BITS)), present) for i, b in enumerate(BOXES)], "box int, files_read long, files_present long")


def files_read(df) -> int:
    """Files that the scans of a query opened when it ran."""
    df = df.select("*")  # a plan of its own: a scan counts its files once
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).nodeName().startswith("Scan parquet")]
    return sum(s.metrics().apply("numFiles").value() for s in scans)


@check("s14_targets_round_trip", "spot", f"""WITH {RANKED} SELECT {TID} AS target_id, CAST(printf('%.2f', x + 0.001) AS DOUBLE) AS x_m, CAST(printf('%.2f', y + 0.001) AS DOUBLE) AS y_m, CAST(printf('%.6f', 120.7 + x / 1e5) AS DOUBLE) AS lon,
    CAST(printf('%.6f', 22.1 + y / 1e5) AS DOUBLE) AS lat, CAST(printf('%+.1f', v + 0.001) AS DOUBLE) AS "anomaly_nT", CASE WHEN v > 0 THEN '+' ELSE '-' END AS polarity FROM rk""")
def _(spark, d):
    path = scratch(spark, "targets")
    text.write_targets(C.target_rows(ranked(spark, d)), path)
    return text.read_targets(spark, path)


