import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from soundlake.checks.files import message
from soundlake.functions import acoustic as A
from soundlake.operators.along import Track, numbered
from soundlake.operators.lineage import cut, shared_dir
from soundlake.sources import sonar, text


def ping(sec, samples, fmt=0, weight=0, validity=1, units=2, x=72_480_000, y=13_290_000):
    p = bytearray(240)
    for name, v in {
        "sec": sec, "validity": validity, "weight": weight, "units": units, "raw_x": x, "raw_y": y, "ns": 20480,
        "data_format": fmt, "depth_mm": 2500, "alt_mm": 9000, "centre": 400000.0, "start10": 200, "end10": 1200,
        "msb": 0x21, "lsb2": 0x1F40, "sweep": 20,
    }.items():
        off, f = sonar.SONAR_FIELDS[name]
        struct.pack_into(f, p, off, v)
    return bytes(p) + np.asarray(samples, "<i2").tobytes()


def att(sec, pitch, heading, ok=True):
    b = bytearray(40)
    struct.pack_into("<II", b, 0, sec, 500)
    struct.pack_into("<hhxxxxhHi", b, 24, pitch, 0, 100, heading, (3 << 6) if ok else 64)
    return bytes(b)


def nav(sec, body):
    return struct.pack("<IIi", sec, 0, 0) + body


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("jsf")
    sss = (
        b"junk\x16\x01no" + message(80, 21, 1, ping(10, [1, -2, 3, 4], weight=1))
        + message(2020, 0, 0, att(9, 1000, 35000)) + message(2020, 0, 0, att(11, 3000, 1000)) + message(2020, 0, 0, att(12, 0, 0, ok=False))
        + message(2002, 0, 0, nav(8, b"$GPGGA,1,2208.0000,N,12046.0000,E,1\r\n")) + message(2002, 0, 0, nav(14, b"$GPRMC,1,A,2209.0000,N,12047.0000,E,0,0,1"))
        + message(2002, 0, 0, nav(15, b"$GPGGA,1,,N,,E,1"))
        + message(80, 21, 1, ping(11, [9, 9], validity=0)) + message(80, 20, 0, ping(30, [5], validity=1 + 16, x=0)) + b"\x01\x16\x00"
    )
    (d / "a.jsf").write_bytes(sss)
    sbp = (
        message(80, 0, 0, ping(0, [3, 4, -6, 8], fmt=1, weight=1, validity=1 + (1 << 6) + (1 << 9)))
        + message(80, 0, 0, ping(0, [-3, 4, 5], fmt=9)) + message(80, 0, 0, ping(50, [-3, 4], fmt=0, units=1, x=120000, y=22000))
    )
    (d / "b.jsf").write_bytes(sbp)
    return str(d)


@pytest.fixture(scope="module")
def messages(spark, files):
    return cut(sonar.index_files(text.survey_files(spark, [files], "*.jsf")))


def test_scan_resyncs_and_stops_at_a_short_header(messages):
    got = messages.where(F.col("file").endswith("a.jsf")).orderBy("seq").select("msg_type", "subsys").collect()
    assert [tuple(r) for r in got] == [
        (80, 21), (2020, 0), (2020, 0), (2020, 0), (2002, 0), (2002, 0), (2002, 0), (80, 21), (80, 20)]


def test_sidescan_decoding(messages):
    p = sonar.sss_pings(messages).orderBy("seq").collect()
    assert [r["channel"] for r in p] == ["HF_stbd", "HF_stbd", "LF_port"]
    assert p[0]["amps"] == [0.5, 32767.0, 1.5, 2.0]  # unsigned words, times 2^-1
    assert p[0]["lon"] == pytest.approx(120.8) and p[1]["lon"] is None and p[2]["lon"] is None
    assert p[0]["depth_m"] == 0 and p[2]["depth_m"] == 2.5
    assert p[0]["pix_m"] == pytest.approx(1489.073 * 20480e-9 / 2)


def test_subbottom_decoding(messages):
    t = Track(("file",), ("seq",), numbered())
    p = sonar.untimed_to_counter(sonar.sbp_pings(messages), t).orderBy("seq").collect()
    assert p[0]["amps"] == [2.5, 5.0] and p[1]["amps"] == [3.0, 4.0, 5.0] and p[2]["amps"] == [3.0, 4.0]
    assert [r["t"] for r in p] == [0.0, 1.0, 50.0]
    assert p[0]["start_freq_hz"] == ((1 << 16) | 200) * 10 and p[0]["end_freq_hz"] == ((2 << 16) | 1200) * 10
    assert p[0]["sweep_ms"] == pytest.approx(20 + 0.5)
    assert (p[0]["altitude_m"], p[0]["water_depth_m"]) == (9.0, 11.5) and p[1]["altitude_m"] is None
    assert p[2]["lon"] == 120.0


def test_georeferencing(messages):
    pings = cut(sonar.sss_pings(messages))
    g = sonar.georeferenced(pings, sonar.attitude(messages), sonar.navigation(messages), F.floor(F.col("t") / 3)).orderBy("seq").collect()
    assert g[0]["lat"] == pytest.approx(22.15) and g[1]["lat"] == pytest.approx(22 + 8.5 / 60) and g[2]["lat"] is None
    assert [r["pos_source"] for r in g] == [0, 0, 255]
    k = 180 / 32768
    assert g[0]["pitch"] == pytest.approx((1000 + 2000 * 0.25) * k) and g[2]["pitch"] is None
    assert g[2]["heading"] == pytest.approx(10.0) and (g[0]["heading"] > 350 or g[0]["heading"] < 10)


def test_mag_files(spark, tmp_path):
    rec = "*24.001/12:00:0{i}.0 F:44000.5 S:10 D:+1.5m A:3.2m L:0 Q:99 X:1.0 Y:2.0 x:{lon:.6f} y:22.100000 <{kind}>"
    lines = [rec.format(i=i, lon=120.7 + i * 1e-4, kind="INTERP" if i == 2 else "REAL") for i in range(6)]
    (tmp_path / "l1.mag").write_bytes("\n".join(lines[:3] + ["broken"] + lines[3:]).encode() + b"\n\xff\xfe")
    (tmp_path / "l2.mag").write_text(lines[0])
    m = text.read_mag(spark, str(tmp_path)).orderBy("file", "block", "seq").collect()
    assert [r["time"] for r in m] == ["12:00:00.0", "12:00:01.0", "12:00:03.0", "12:00:04.0", "12:00:05.0", "12:00:00.0"]
    raw = text.read_mag(spark, str(tmp_path), layback=False).orderBy("file", "block", "seq").collect()
    assert raw[1]["x"] - m[1]["x"] == pytest.approx(10.0, abs=0.01) and m[5]["x"] == raw[5]["x"]


def test_xyz_and_targets(spark, tmp_path):
    (tmp_path / "s.txt").write_text(" 1.0   2.0 -3.5\n\n4 5 6\n")
    assert [tuple(r) for r in text.read_xyz(spark, str(tmp_path / "s.txt")).orderBy("x").collect()] == [(1, 2, -3.5), (4, 5, 6)]
    assert text.read_targets(spark, str(tmp_path / "none")).count() == 0


def test_nmea_edge_cases(spark):
    rows = ["$GPGGA,1,4807.038,S,01131.000,W", "$GPGGA,1,4807.038,N", "$GPRMC,1,A,4807.038,N,01131.000,E", "", "$GPGGA,1,abc,N,1,E"]
    lat, lon = A.nmea_position(F.col("s"))
    got = spark.createDataFrame([(s,) for s in rows], "s string").select(lat.alias("a"), lon.alias("o")).collect()
    assert got[0]["a"] == pytest.approx(-48.1173) and got[0]["o"] == pytest.approx(-11.516667, abs=1e-6)
    assert got[1]["a"] is None and got[2]["a"] is None and got[3]["a"] is None and got[4]["a"] is None


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_channel_dispatch(spark):
    assert A.channels_for("hf") == ["HF_port", "HF_stbd"]
    with pytest.raises(ValueError):
        A.channels_for("XX")
    mixed = spark.createDataFrame([(["HF_port", "LF_port"],)], "c array<string>")
    with pytest.raises(Exception, match="mixed"):
        mixed.select(A.frequency_of(F.col("c"))).collect()
    assert spark.createDataFrame([(["LF_port"],)], "c array<string>").select(A.frequency_of(F.col("c"))).first()[0] == "LF"


def test_paths_as_listed_open_in_arrow():
    assert sonar.arrow_uri("/a/b.jsf") == "/a/b.jsf"
    assert sonar.arrow_uri("file:/a/b") == sonar.arrow_uri("file:///a/b") == "file:///a/b"
    assert sonar.arrow_uri("s3a://bucket/k") == "s3://bucket/k"
    assert sonar.arrow_uri("wasbs://c@x/k") == "abfss://c@x/k"
    assert sonar.arrow_uri("hdfs://n:9000/k") == "hdfs://n:9000/k"


def test_reading_ahead_gives_the_same_bytes():
    data = bytes(range(256)) * 50
    calls = []

    def read_at(pos, n):
        calls.append(n)
        return data[pos : pos + n]

    get = sonar.read_ahead(read_at, len(data), 1000)
    for pos, n in ((0, 16), (16, 16), (990, 20), (5000, 3000), (7990, 10), (12_790, 10), (0, 1)):
        assert get(pos, n) == data[pos : pos + n]
    assert len(calls) == 5


def test_short_payloads_leave_their_later_fields_null(spark):
    rows = [("f", 0, 0, 0, 240, bytes(240)), ("f", 1, 0, 0, 100, b"\x05" * 100)]
    df = spark.createDataFrame(rows, "file string, seq long, subsys int, channel int, size long, payload binary")
    got = sonar.raw_fields(df, sonar.SONAR_FIELDS).orderBy("seq").collect()
    assert got[0]["usec"] == 0 and got[1]["sec"] == 0x05050505 and got[1]["usec"] is None and got[1]["raw_x"] == 0x05050505


def stream(seed, n=400):
    """Messages with payloads full of false headers, garbage between them, empty and very long ones."""
    rng = np.random.default_rng(seed)
    out = b""
    for i in range(n):
        body = rng.integers(0, 256, int(rng.choice([0, 3, 40, 300, 5000]))).astype("u1").tobytes()
        if i % 3 == 0:  # a false header that leads into the middle of what follows, or far away
            body += message(80, 20, 1, b"x" * 40)[: int(rng.integers(2, 50))] + struct.pack("<HHHBBBBHI", 0x1601, 0, 9, 0, 9, 9, 0, 0, int(rng.choice([0, 7, 900, 10**6])))
        if i % 5 == 0:
            out += rng.integers(0, 256, int(rng.integers(0, 60))).astype("u1").tobytes() + b"\x01"
        out += message(80 + i % 4, i % 7, i % 3, body)
    return out + message(1, 1, 1, b"cut off")[:-4] + b"\x01\x16" * (seed % 3)


def test_split_files_give_the_walk_from_the_start(spark, tmp_path):
    streams = {f"{k}.jsf": stream(k) for k in range(3)} | {"short.jsf": stream(9, 2), "none.jsf": b"", "junk.jsf": b"\x01\x00" * 3000, "one.jsf": message(80, 1, 1, b"\x01\x16" * 4000)}
    for k, b in streams.items():
        (tmp_path / k).write_bytes(b)
    rows = spark.createDataFrame([(str(tmp_path / k), len(b)) for k, b in streams.items()], "path string, length long")
    want = sorted((k, i, *m) for k, b in streams.items() for i, m in enumerate(sonar.walk(lambda p, n, b=b: b[p : p + n], len(b))))
    for span in (700, 9000):
        got = sonar.index_files(rows, span).select(F.element_at(F.split("file", "/"), -1), "seq", "offset", "size", "msg_type", "subsys", "channel")
        assert sorted(map(tuple, got.collect())) == want


def test_exits_of_a_range_are_those_of_walks_from_any_place():
    b = stream(4, 60)
    read = lambda p, n: b[p : p + n]
    for begin, end in ((0, 3000), (1500, 1600), (2000, len(b)), (len(b) - 10, len(b))):
        upto, out = sonar.exits(read, len(b), begin, end)
        for p in range(begin, end, 7):
            steps = [o + s for o, s, *_ in sonar.walk(read, len(b), p, end)]
            k = np.searchsorted(upto, p)
            assert (out[k] if k < len(upto) else None) == (steps[-1] if steps else None)


def test_short_files_leave_a_task_together(tmp_path):
    one = message(80, 20, 0, b"abc") + message(2002, 0, 0, b"")
    rows = []
    for i in range(40):
        (tmp_path / f"{i}.jsf").write_bytes(one)
        rows.append((str(tmp_path / f"{i}.jsf"), len(one), 0, len(one), 0))
    files = pd.DataFrame(rows, columns=["path", "length", "begin", "end", "entry"])
    frames = list(sonar._walked(iter([files[:25], files[25:]])))
    assert [len(f) for f in frames] == [80]
    assert frames[0]["seq"].tolist() == [0, 1] * 40 and frames[0]["file"].tolist() == [p for p, *_ in rows for _ in range(2)]


def test_chains_are_composed_across_batches_and_files():
    r = pd.DataFrame({"path": ["a", "a", "a", "b"], "length": [30, 30, 30, 9], "begin": [0, 10, 20, 0], "end": [10, 20, 30, 9],
                      "upto": [np.array([3]), np.array([14]), np.array([21, 26]), np.array([5])], "exit": [np.array([22]), np.array([25]), np.array([27, 31]), np.array([9])]})
    for cuts in ([0, 4], [0, 1, 4], [0, 1, 2, 3, 4]):
        found = pd.concat(sonar._composed(r[a:b] for a, b in zip(cuts, cuts[1:])))
        assert found[["path", "begin", "entry"]].values.tolist() == [["a", 0, 0], ["a", 20, 22], ["b", 0, 0]]


def test_scanned_payloads_leave_by_their_bytes(monkeypatch):
    monkeypatch.setattr(sonar, "SCAN_BYTES", 100)
    blob = b"".join(message(80, 20, 0, bytes([i]) * 60) for i in range(7))
    batch = pa.RecordBatch.from_pydict({"name": ["a", "b", "c"], "blob": pa.array([blob, None, blob[:30]], pa.binary())})
    out = list(sonar._scanned(iter([batch])))
    assert max(b.num_rows for b in out) == 2
    rows = pa.Table.from_batches(out).to_pylist()
    assert [(r["file"], r["seq"], r["payload"][:1]) for r in rows] == [("a", i, bytes([i])) for i in range(7)] + [("c", 0, b"\0")]
    assert [len(r["payload"]) for r in rows] == [60] * 7 + [14]
