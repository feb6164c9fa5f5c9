"""Text sources: soundings, magnetometer records, target lists, surveys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.functions.geo import project
from soundlake.operators.along import Track, shift_back

# The fields of a magnetometer record line are ``key:value``; depth and height carry a unit.
MAG_FIELDS = {"F_nT": "F", "depth_m": "D", "alt_m": "A", "quality": "Q", "lon": "x", "lat": "y"}

TARGET_SCHEMA = (
    "target_id string, x_m double, y_m double, lon double, lat double, anomaly_nT double, polarity string"
)


def parse_xyz(df: DataFrame, value: str = "value") -> DataFrame:
    """Whitespace-separated x y z; blank lines dropped."""
    p = F.split(F.trim(value), r"\s+")
    return df.where(F.trim(value) != "").select(
        *[c for c in df.columns if c != value],
        *[F.get(p, F.lit(i)).try_cast("double").alias(n) for i, n in enumerate("xyz")],
    )


def read_xyz(spark: SparkSession, path: str) -> DataFrame:
    return parse_xyz(spark.read.text(path))


def parse_mag(df: DataFrame, value: str = "value") -> DataFrame:
    """REAL records only; lines that lack a field or hold something else in it are dropped.

    A line is cut at blanks once; fields are then read by their keys, wherever they stand. The first one is ``*date/time``, the last one the
    kind in angle brackets; the depth has a sign.
    """
    words = F.split(F.trim(value), r"\s+")
    kept = [c for c in df.columns if c != value]
    d = df.select(*kept, words.alias("_w"))

    def field(key: str) -> Column:
        return F.substring_index(F.get(F.filter("_w", lambda w: w.startswith(f"{key}:")), F.lit(0)), ":", -1)

    date, time = F.substring_index(F.get("_w", F.lit(0)), "/", 1), F.substring_index(F.get("_w", F.lit(0)), "/", -1)
    d = d.withColumns({f"_{n}": field(k) for n, k in MAG_FIELDS.items()}).withColumns({"_date": date, "_time": time})
    number = [F.regexp_replace(F.col(f"_{n}"), "m$", "").try_cast("double").alias(n) for n in ("F_nT", "depth_m", "alt_m")]
    place = [F.col(f"_{n}").try_cast("double").alias(n) for n in ("lon", "lat")]
    d = d.select(*kept, "_w", "_date", F.col("_time").alias("time"), *number, F.col("_quality").try_cast("int").alias("quality"), *place, "_depth_m")
    real = F.array_contains("_w", "<REAL>")
    dated = F.startswith("_date", F.lit("*")) & F.contains("time", F.lit(":")) & F.contains("time", F.lit("."))
    signed = F.substring("_depth_m", 1, 1).isin("+", "-")
    whole = [F.col(n).isNotNull() for n in ("F_nT", "depth_m", "alt_m", "quality", "lon", "lat")]
    return d.where(reduce(and_, [real, dated, signed, *whole])).drop("_w", "_date", "_depth_m")


def read_mag(spark: SparkSession, path: str, layback: bool = True, distance: float = K.LAYBACK_M) -> DataFrame:
    """Magnetometer files to (file, block, seq, ..., x, y).

    Files are read in splits. Within a split the row id grows with the position, and splits are ordered
    by their start offset, so (block, seq) is the line order in a file without reading it as a whole;
    the split doubles as the stretch of the track.
    """
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.mag")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    x, y = project(F.col("lon"), F.col("lat"))
    m = parse_mag(raw).withColumn("x", x).withColumn("y", y)
    return shift_back(m, mag_track(), "x", "y", distance) if layback else m


def mag_track() -> Track:
    return Track(("file",), ("block", "seq"), F.col("block"))


def list_surveys(files: DataFrame, survey_dim: DataFrame) -> DataFrame:
    """Files (path, name) of the survey folders in folder order, then name order, with ``line_id``.

    ``survey_dim`` is (dir_order, dir, ...attributes). Runs on the file list only.
    """
    j = files.join(survey_dim, "dir")
    w = Window.orderBy("dir_order", "name")  # one row per file
    return j.withColumn("line_id", (F.row_number().over(w) - 1).cast("int"))


def survey_files(spark: SparkSession, dirs: list[str], pattern: str) -> DataFrame:
    """(dir, name, path, length) of matching files; contents are not read."""
    parts = []
    for d in dirs:
        f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(d)
        parts.append(f.select(F.lit(d).alias("dir"), F.substring_index("path", "/", -1).alias("name"), "path", "length"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_targets(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Target list back from CSV; an absent path is an empty list."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], TARGET_SCHEMA)
    return spark.read.schema(TARGET_SCHEMA).option("header", True).csv(path)


def write_features(df: DataFrame, column: str, path: str) -> None:
    """One JSON feature per line."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
