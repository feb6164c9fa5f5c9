"""Binary sonar files: index the messages, then decode payload ranges in parallel.

A file is a chain of 16-byte headers and payloads, so where message n+1 starts is known only after
message n. The index pass walks headers and skips payloads (16 bytes per message). A huge file is cut
into ranges that are parsed on speculation: each tells for any place where the chain may come in where
it would go out, and the true chain is put together from range to range. The decode pass reads payload
ranges of any file in any task.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.functions import acoustic as A
from soundlake.operators.along import Track, fill_position, heading_back, heading_parts, interpolate
from soundlake.operators.lineage import cut

# Message header and payload layout (little endian).
MAGIC = b"\x01\x16"
HEADER = 16
SAMPLES_AT = 240
SONAR, ATTITUDE, NAVIGATION = 80, 2020, 2002
SONAR_FIELDS = {
    "sec": (0, "<I"), "msb": (16, "<H"), "lsb2": (20, "<H"), "validity": (30, "<H"), "data_format": (34, "<h"),
    "heave": (48, "<f"), "raw_x": (80, "<i"), "raw_y": (84, "<i"), "units": (88, "<h"), "ns": (116, "<I"),
    "start10": (126, "<H"), "end10": (128, "<H"), "sweep": (130, "<H"), "depth_mm": (136, "<i"),
    "alt_mm": (144, "<i"), "centre": (152, "<f"), "weight": (168, "<h"), "usec": (200, "<I"),
}
ATTITUDE_FIELDS = {
    "sec": (0, "<I"), "msec": (4, "<I"), "pitch_raw": (24, "<h"), "roll_raw": (26, "<h"), "heave_mm": (32, "<h"),
    "heading100": (34, "<H"), "validity": (36, "<i"),
}
NAVIGATION_FIELDS = {"sec": (0, "<I"), "msec": (4, "<I")}
SPARK_TYPE = {"I": "long", "H": "int", "h": "int", "i": "int", "f": "float"}

INDEX_SCHEMA = "file string, seq long, offset long, size long, msg_type int, subsys int, channel int"


def walk(read_at, length: int, pos: int = 0, end: int | None = None) -> Iterator[tuple[int, int, int, int, int]]:
    """(offset, size, type, subsystem, channel) per message; ``read_at(pos, n)`` returns bytes.

    A position without the magic number moves on to the next one that has it. Only messages whose header
    starts from ``pos`` on and before ``end`` are given.
    """
    end = length if end is None else end
    while pos < end and pos + HEADER <= length:
        h = read_at(pos, HEADER)
        if h[:2] != MAGIC:
            pos = _next_magic(read_at, pos + 1, min(length, end + 1))
            continue
        size = struct.unpack_from("<I", h, 12)[0]
        yield pos + HEADER, size, struct.unpack_from("<H", h, 4)[0], h[7], h[8]
        pos += HEADER + size


def _next_magic(read_at, pos: int, length: int, step: int = 1 << 16) -> int:
    while pos < length:
        buf = read_at(pos, min(step, length - pos))
        i = buf.find(MAGIC)
        if i >= 0:
            return pos + i
        pos += max(1, len(buf) - 1)
    return length


#: Schemes of the listing that the Arrow build knows under another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
#: Bytes that the index pass reads ahead; bytes of a file that one task walks; short files that one task walks.
AHEAD, SPAN, FILES_PER_TASK = 1 << 23, 1 << 28, 5_000
#: Payload bytes of a scan that leave a task together.
SCAN_BYTES = 1 << 21


def arrow_uri(path: str) -> str:
    """A path as Spark's listing gives it, in the form that Arrow opens; plain paths stay as they are."""
    scheme, colon, rest = path.partition(":/")
    if not colon:
        return path
    if scheme == "file":
        return f"file:///{rest.lstrip('/')}"
    return f"{SCHEMES.get(scheme, scheme)}:/{rest}"


def _opener():
    """Random access to a path on any file system the Arrow build knows; a few files stay open."""
    from pyarrow import fs

    cache: dict[str, object] = {}

    def get(path: str):
        if path not in cache:
            if len(cache) > 8:
                cache.pop(next(iter(cache))).close()
            uri = arrow_uri(path)
            system, inner = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
            cache[path] = system.open_input_file(inner)
        return cache[path]

    return get


def read_ahead(read_at, length: int, block: int = AHEAD):
    """``read_at`` that answers from large blocks: headers lie close together, and a request each would cost a round trip."""
    at, held = 0, b""

    def get(pos: int, n: int) -> bytes:
        nonlocal at, held
        if not at <= pos <= pos + n <= at + len(held):
            at, held = pos, read_at(pos, min(max(n, block), length - pos))
        return held[pos - at : pos - at + n]

    return get


def index_files(files: DataFrame, span: int = SPAN) -> DataFrame:
    """Message index of files given as (path, length); files longer than ``span`` are parsed range by range, by many tasks."""
    files = files.select("path", "length")
    start = F.lit(0).cast("long")
    long = F.col("length") > span
    n, size, n_long = files.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.least("length", F.lit(span))), F.lit(0)), F.count_if(long)).first()
    tasks = max(1, -(-n // FILES_PER_TASK), -(-size // span))
    short = files.where(~long).repartition(tasks, "path").select("path", "length", start.alias("begin"), F.col("length").alias("end"), start.alias("entry"))
    short = _messages(short).drop("begin")
    if not n_long:
        return short
    ranges = files.where(long).withColumn("begin", F.explode(F.expr(f"sequence(0L, length - 1, {span}L)")))
    ranges = ranges.withColumn("end", F.least("length", F.col("begin") + span)).repartition("path", "begin")
    guesses = _speculated(ranges).repartition("path").sortWithinPartitions("path", "begin")
    entries = guesses.mapInPandas(_composed, "path string, length long, begin long, end long, entry long")
    found = cut(_messages(entries.repartition("path", "begin")), "index")
    count = found.groupBy("file", "begin").agg(F.count(F.lit(1)).alias("n"))
    # One row per range, not per message.
    before = F.sum("n").over(Window.partitionBy("file").orderBy("begin")) - F.col("n")
    found = found.join(count.select("file", "begin", before.alias("before")), ["file", "begin"])
    return short.unionByName(found.withColumn("seq", F.col("seq") + F.col("before")).drop("before", "begin"))


def _messages(ranges: DataFrame) -> DataFrame:
    """Index rows of ranges (path, length, begin, end, entry), counted from 0 in each."""
    return ranges.select("path", "length", "begin", "end", "entry").mapInPandas(_walked, INDEX_SCHEMA + ", begin long")


def _walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    get = _opener()
    rows = []  # of many short files: a frame for each would cost more than its walk
    for pdf in batches:
        for path, length, begin, end, entry in pdf.itertuples(index=False):
            f = get(path)
            read = read_ahead(lambda p, n, f=f: f.read_at(n, p), int(length))
            for i, (o, s, t, sub, ch) in enumerate(walk(read, int(length), int(entry), int(end))):
                rows.append((path, i, o, s, t, sub, ch, begin))
                if len(rows) == 50_000:
                    yield _frame(rows, "begin")
                    rows = []
    if rows:
        yield _frame(rows, "begin")


def exits(read_at, length: int, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(upto, exit): a chain that comes in at p leaves the range for the exit of the first ``upto`` >= p; beyond the last one it passes through.

    Every place with the magic number may be a header or bytes of a payload; all are followed at once by doubling their steps. Chains merge soon, so
    places with one exit in common are one entry.
    """
    found, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(begin, min(end, length - HEADER + 1), AHEAD):
        to = min(at + AHEAD, end, length - HEADER + 1)
        buf = np.frombuffer(read_at(at, min(to + HEADER, length) - at), np.uint8)
        head = np.flatnonzero((buf[: to - at] == MAGIC[0]) & (buf[1 : to - at + 1] == MAGIC[1]))
        found.append(head + at)
        sizes.append(sum(buf[head + 12 + k].astype(np.int64) << (8 * k) for k in range(4)))
    at = np.concatenate(found)
    out = at + HEADER + np.concatenate(sizes)
    step = np.searchsorted(at, out)
    for _ in range(len(at).bit_length()):
        inside = step < len(at)
        out[inside], step[inside] = out[step[inside]], step[step[inside]]
    last = np.append(out[1:] != out[:-1], True)[: len(at)]
    return at[last], out[last]


def _speculated(ranges: DataFrame) -> DataFrame:
    columns = ["path", "length", "begin", "end", "upto", "exit"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = _opener()
        rows, held = [], 0
        for pdf in batches:
            for path, length, begin, end in pdf.itertuples(index=False):
                f = get(path)
                upto, out = exits(lambda p, n, f=f: f.read_at(n, p), int(length), int(begin), int(end))
                rows.append((path, length, begin, end, upto, out))
                held += 1 + len(upto)
                if held >= 50_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return ranges.select("path", "length", "begin", "end").mapInPandas(run, "path string, length long, begin long, end long, upto array<long>, exit array<long>")


def _composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Where the chain of each file comes into each range that it stops in; ranges come file by file in order, a range is one row with a few exits."""
    at, pos = None, 0
    for pdf in batches:
        rows = []
        for path, length, begin, end, upto, out in pdf.itertuples(index=False):
            at, pos = path, max(pos if path == at else 0, begin)
            k = int(np.searchsorted(upto, pos))
            if pos < end and k < len(upto):
                rows.append((path, length, begin, end, pos))
                pos = int(out[k])
        if rows:
            yield pd.DataFrame(rows, columns=["path", "length", "begin", "end", "entry"])


def _frame(rows: list[tuple], *more: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[*(c.split()[0] for c in INDEX_SCHEMA.split(", ")), *more])


def scan_blobs(df: DataFrame, name: str, blob: str) -> DataFrame:
    """The same walk over binary cells, payloads included: for small pieces held in a table."""
    return df.select(F.col(name).cast("string"), blob).mapInArrow(_scanned, INDEX_SCHEMA + ", payload binary")


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells are walked where they lie in the batch; rows leave by count and by the bytes of their payloads."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = [*(c.split()[0] for c in INDEX_SCHEMA.split(", ")), "payload"]

    def block(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

    for batch in batches:
        rows, held = [], 0
        for key, cell in zip(batch.column(0), batch.column(1)):
            b = memoryview(cell.as_buffer()) if cell.is_valid else b""
            key = key.as_py()
            for i, (o, s, t, sub, ch) in enumerate(walk(lambda p, n, b=b: bytes(b[p : p + n]), len(b))):
                rows.append((key, i, o, s, t, sub, ch, bytes(b[o : o + s])))
                held += s
                if len(rows) == 10_000 or held > SCAN_BYTES:
                    yield block(rows)
                    rows, held = [], 0
        if rows:
            yield block(rows)


def spread(index: DataFrame, block: int = 2048) -> DataFrame:
    """Index rows dealt out in runs of neighbouring messages, so that a huge file is read by many tasks."""
    return index.repartition("file", F.floor(F.col("seq") / block)).sortWithinPartitions("file", "offset")


def _unpack(pay: list[bytes], fields: dict[str, tuple[int, str]]) -> pd.DataFrame:
    """Fields of all payloads at once, through one structured view of their heads; NULL where a payload ends before the field does."""
    ends = {n: o + struct.calcsize(f) for n, (o, f) in fields.items()}
    width = max(ends.values())
    kind = np.dtype({"names": list(fields), "formats": [f for _, f in fields.values()], "offsets": [o for o, _ in fields.values()], "itemsize": width})
    heads = np.frombuffer(b"".join(bytes(p[:width]).ljust(width, b"\0") for p in pay), kind)
    size = np.array([len(p) for p in pay], dtype="int64")
    out = pd.DataFrame({n: heads[n].astype(heads[n].dtype.newbyteorder("=")) for n in fields})
    for n, end in ends.items():
        if (size < end).any():
            out[n] = out[n].astype(object).where(size >= end, None)
    return out


def raw_fields(messages: DataFrame, fields: dict[str, tuple[int, str]], samples: str | None = None) -> DataFrame:
    """(file, seq, channel, subsys, size, <raw integers>[, amps | text]); no arithmetic yet.

    ``messages`` is an index (payload ranges are read where they are decoded and never pass through the
    JVM) or a table that holds payloads. ``samples``: 'sss' scales unsigned words, 'sbp' signed words or
    I/Q pairs, 'text' is the navigation sentence.
    """
    base = ["file", "seq", "subsys", "channel", "size"]
    schema = "file string, seq long, subsys int, channel int, size long, " + ", ".join(
        f"{n} {SPARK_TYPE[f[1]]}" for n, (_, f) in fields.items()
    )
    extra = {"sss": ", amps array<float>", "sbp": ", amps array<float>", "text": ", sentence string"}.get(samples, "")
    stored = "payload" in messages.columns
    src = messages.select(*base, "payload") if stored else spread(messages).select(*base, "offset")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = _opener()
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512].reset_index(drop=True)
                if stored:
                    pay = list(part["payload"])
                else:
                    pay = [get(f).read_at(int(n), int(o)) for f, n, o in zip(part["file"], part["size"], part["offset"])]
                yield _decode(part[base], pay, fields, samples)

    return src.mapInPandas(run, schema + extra)


def _decode(out: pd.DataFrame, pay: list[bytes], fields: dict, samples: str | None) -> pd.DataFrame:
    got = _unpack(pay, fields)
    out = pd.concat([out, got], axis=1)
    if samples == "text":
        out["sentence"] = [bytes(p[12:]).decode("ascii", errors="ignore").strip() for p in pay]
    elif samples:
        scale = _unsigned if samples == "sss" else _envelope
        out["amps"] = [scale(bytes(p[SAMPLES_AT:]), w or 0, f or 0) for p, w, f in zip(pay, got["weight"], got["data_format"])]
    return out


def _unsigned(b: bytes, weight: int, _fmt: int) -> np.ndarray:
    return np.frombuffer(b[: len(b) // 2 * 2], "<u2").astype("float32") * np.float32(2.0**-weight)


def _envelope(b: bytes, weight: int, fmt: int) -> np.ndarray:
    w = np.frombuffer(b[: len(b) // 2 * 2], "<i2").astype("float64")
    if fmt in (1, 9) and len(w) % 2 == 0:
        return np.hypot(w[0::2] * 2.0**-weight, w[1::2] * 2.0**-weight).astype("float32")
    return (np.abs(w) * 2.0**-weight).astype("float32")


def _time(fraction: str, unit: float) -> Column:
    return F.col("sec") + F.col(fraction) / unit


def sss_pings(messages: DataFrame, sound_speed: float = K.SOUND_SPEED) -> DataFrame:
    """Side-scan pings with their own position only; attitude is never in this message."""
    m = messages.where((F.col("msg_type") == SONAR) & F.col("subsys").isin(20, 21) & (F.col("size") >= SAMPLES_AT))
    r = raw_fields(m, SONAR_FIELDS, "sss")
    v = F.col("validity")
    lon, lat = A.raw_longitude_latitude(F.col("raw_x"), F.col("raw_y"), F.col("units"), A.has_bit(v, 0))
    side = F.when(F.col("channel") == 0, "_port").otherwise("_stbd")
    return r.select(
        "file",
        F.concat(F.when(F.col("subsys") == 20, "LF").otherwise("HF"), side).alias("channel"),
        "seq",
        _time("usec", 1e6).alias("t"),
        "amps",
        (F.lit(sound_speed) * F.col("ns") * 1e-9 / 2).alias("pix_m"),
        A.centre_frequency(F.col("centre"), F.col("start10"), F.col("end10")).alias("center_freq_hz"),
        F.when(A.has_bit(v, 4), F.col("depth_mm") / 1000.0).otherwise(0.0).alias("depth_m"),
        F.when(A.has_bit(v, 7), F.col("heave").cast("double")).otherwise(0.0).alias("heave_m"),
        lat.alias("lat"),
        lon.alias("lon"),
    )


def sbp_pings(messages: DataFrame) -> DataFrame:
    """Sub-bottom pings with their own position only."""
    m = messages.where((F.col("msg_type") == SONAR) & (F.col("subsys") == 0) & (F.col("size") >= SAMPLES_AT))
    r = raw_fields(m, SONAR_FIELDS, "sbp")
    v = F.col("validity")
    lon, lat = A.raw_longitude_latitude(F.col("raw_x"), F.col("raw_y"), F.col("units"), A.has_bit(v, 0))
    depth = F.when(A.has_bit(v, 9), F.col("depth_mm") / 1000.0).otherwise(0.0)
    alt = F.when(A.has_bit(v, 6) & (F.col("alt_mm") > 0), F.col("alt_mm") / 1000.0)
    return r.select(
        "file",
        "seq",
        _time("usec", 1e6).alias("t"),
        "amps",
        F.size("amps").alias("n_samples"),
        A.chirp_frequency(F.col("msb"), F.col("start10"), 0).alias("start_freq_hz"),
        A.chirp_frequency(F.col("msb"), F.col("end10"), 1).alias("end_freq_hz"),
        A.sweep_millis(F.col("sweep"), F.col("lsb2")).alias("sweep_ms"),
        "data_format",
        F.col("ns").alias("ns_per_sample"),
        F.when(A.has_bit(v, 7), F.col("heave").cast("double")).otherwise(0.0).alias("heave_m"),
        depth.alias("depth_m"),
        alt.alias("altitude_m"),
        A.water_depth(depth, alt).alias("water_depth_m"),
        F.when(lat != 0, lat).alias("lat"),
        F.when(lon != 0, lon).alias("lon"),
    )


def untimed_to_counter(pings: DataFrame, track: Track) -> DataFrame:
    """Pings without a time take their 0-based number in the file."""
    from soundlake.operators.along import ordinals

    p = ordinals(pings, track, "_no")
    t = F.when(F.col("t") > 0, F.col("t")).otherwise((F.col("_no") - 1).cast("double"))
    return p.withColumn("t", t).drop("_no")


def attitude(messages: DataFrame) -> DataFrame:
    m = messages.where((F.col("msg_type") == ATTITUDE) & (F.col("size") >= 40))
    r = raw_fields(m, ATTITUDE_FIELDS)
    r = r.where(A.has_bit(F.col("validity"), 6) & A.has_bit(F.col("validity"), 7))
    return r.select(
        "file",
        _time("msec", 1e3).alias("t"),
        (F.col("pitch_raw") * (180.0 / 32768.0)).alias("pitch"),
        (F.col("roll_raw") * (180.0 / 32768.0)).alias("roll"),
        (F.col("heave_mm") / 1000.0).alias("heave_m"),
        (F.col("heading100") / 100.0).alias("heading"),
    )


def navigation(messages: DataFrame) -> DataFrame:
    m = messages.where((F.col("msg_type") == NAVIGATION) & (F.col("size") > 12))
    r = raw_fields(m, NAVIGATION_FIELDS, "text")
    lat, lon = A.nmea_position(F.col("sentence"))
    return r.select("file", _time("msec", 1e3).alias("t"), lat.alias("lat"), lon.alias("lon")).where("lat is not null")


def georeferenced(pings: DataFrame, att: DataFrame, nav: DataFrame, stretch: Column) -> DataFrame:
    """Pings with interpolated attitude and with position gaps filled from navigation.

    ``pings`` should be a stored table (decode once, ``cut``): the interpolation runs on its distinct
    (file, t) only, both results are joined back, and the traces are read a single time.
    """
    times = pings.select("file", "t").distinct()
    a = att.select("file", "t", "pitch", "roll", *heading_parts("heading"))
    modes = {"pitch": "null", "roll": "null", "_s": "clamp", "_c": "clamp"}
    a = interpolate(times, a, ["file"], "t", list(modes), stretch, modes)
    n = nav.select("file", "t", F.col("lat").alias("lat_nav"), F.col("lon").alias("lon_nav"))
    n = interpolate(times, n, ["file"], "t", ["lat_nav", "lon_nav"], stretch)
    both = a.join(n, ["file", "t"]).withColumn("heading", heading_back()).drop("_s", "_c")
    return fill_position(pings.join(both, ["file", "t"]), ("lat", "lon"), ("lat_nav", "lon_nav"))
