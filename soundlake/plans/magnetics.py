"""Magnetic layers and targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.functions.geo import unproject
from soundlake.operators.along import Track, median_zero, ordinals
from soundlake.operators.knn import around, confidence, idw, nearest, weighted
from soundlake.operators.lineage import cut
from soundlake.operators.raster import Grid, blur, extrema, residual
from soundlake.operators.stats import attach
from soundlake.operators.targets import greedy_thin, rank_targets


def big_lines(df: DataFrame, line: list[str], least: int) -> DataFrame:
    """Rows of lines with at least ``least`` rows; the counts are pre-aggregated and joined back."""
    n = df.groupBy(*line).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return df.join(cut(n.drop("_n"), "lines"), line, "left_semi")


def quality_filter(
    df: DataFrame, survey: DataFrame, keys: list[str], field: str, quality: str,
    min_quality: int = K.MAG_QUALITY, tolerance: float = K.MAG_TOLERANCE,
) -> DataFrame:
    """Quality flag high enough, and the field within 10 % of the survey's reference ``f_ref``."""
    j = df.join(survey, keys)
    f = F.col(field)
    return j.where(
        (F.col(quality) >= min_quality)
        & f.between(F.col("f_ref") * (1 - tolerance), F.col("f_ref") * (1 + tolerance))
    )


def drop_outliers(df: DataFrame, value: str, sigmas: float = 2.0) -> DataFrame:
    """|v| below two population standard deviations, not centred on the mean."""
    s = df.agg(F.stddev_pop(value).alias("_std"))
    return attach(df, s, []).where(F.abs(value) < sigmas * F.col("_std")).drop("_std")


def filtered_lines(
    records: DataFrame, survey: DataFrame, keys: list[str], track: Track, window_bg: int = K.MAG_BG_WINDOW,
    window_anom: int = K.MAG_ANOM_WINDOW,
) -> DataFrame:
    """Records with ``background`` and ``anomaly`` from two along-track median filters."""
    line = list(track.line)
    d = big_lines(records, line, window_bg)
    d = cut(quality_filter(d, survey, keys, "F_nT", "quality"), "records")
    d = cut(big_lines(d, line, window_bg).withColumn("raw", F.col("F_nT") - F.col("f_ref")), "records")
    d = ordinals(d, track, "ord", "n")
    d = median_zero(d, line, "raw", window_bg, "background")
    return median_zero(d, line, "raw", window_anom, "anomaly")


def layers(
    points: DataFrame, pid: list[str], depth: DataFrame, grid: Grid, reach: float = 50.0, k: int = 12,
    sigma_m: float = 200.0, leaf: float = 2.0,
) -> DataFrame:
    """Anomaly, smoothed background, residual and confidence per cell: (row, col, ...)."""
    points = cut(points, "points")
    bg = drop_outliers(points, "background").select(*pid, F.col("x").alias("px"), F.col("y").alias("py"), "background")
    an = points.select(*pid, F.col("x").alias("px"), F.col("y").alias("py"), "anomaly")
    cells = grid.centres(depth.select("row", "col"), "qx", "qy")
    cell = ["row", "col"]
    # The search for the background gives the distance mask as well, so only cells that are out of reach for sure are left out before.
    found = weighted(nearest(around(cells, bg, reach), bg, cell, pid, k, None, leaf), cell, "background", floor_distance=True)
    b = cut(found.where(F.col("d2") <= reach * reach), "background")
    near = grid.centres(b.select(*cell), "qx", "qy")
    a = cut(idw(near, an, cell, pid, "anomaly", k, None, leaf, floor_distance=True), "anomaly")
    smooth = blur(b, grid, "background", sigma_m / grid.res)
    smooth = smooth.join(b.select(*cell), cell, "left_semi")
    res = residual(a, smooth, "anomaly", "smooth").select(*cell, "residual")
    out = a.select(*cell, "anomaly", confidence(F.col("nearest"), grid.res).alias("confidence"))
    return out.join(smooth, cell, "left").join(res, cell, "left").withColumnRenamed("smooth", "background")


def targets(
    anomaly: DataFrame, grid: Grid, value: str = "anomaly", threshold: float = 100.0, size: int = 20, radius: float = 15.0
) -> DataFrame:
    """Ranked targets: (target_id, x_m, y_m, lon, lat, anomaly_nT, polarity)."""
    peaks = grid.centres(extrema(anomaly, grid, value, threshold, size), "x_m", "y_m")
    kept = greedy_thin(peaks.select("row", "col", "x_m", "y_m", value), ["row", "col"], "x_m", "y_m", value, radius)
    lon, lat = unproject(F.col("x_m"), F.col("y_m"))
    ranked = rank_targets(kept, value, ["row", "col"]).withColumn("lon", lon).withColumn("lat", lat)
    return ranked.select("target_id", "x_m", "y_m", "lon", "lat", F.col(value).alias("anomaly_nT"), "polarity")
