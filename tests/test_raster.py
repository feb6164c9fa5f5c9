import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from soundlake.functions.geo import project, unproject
from soundlake.operators import raster as R
from soundlake.operators.raster import Grid

GRID = Grid(0.0, 20.0, 1.0, 20, 24)


def layer(spark, a):
    r, c = np.nonzero(np.isfinite(a))
    return spark.createDataFrame(pd.DataFrame({"row": r.astype("int32"), "col": c.astype("int32"), "z": a[r, c]}), "row int, col int, z double")


def dense(df, name):
    a = np.full((20, 24), np.nan)
    for x in df.collect():
        a[x["row"], x["col"]] = x[name] if x[name] is not None else np.nan
    return a


def surface(seed=0, holes=0.05):
    rng = np.random.default_rng(seed)
    a = rng.normal(10, 3, (20, 24))
    a[rng.random(a.shape) < holes] = np.nan
    return a


def test_erosion_of_full_grid_only_trims_the_edge(spark):
    out = dense(R.erode(layer(spark, surface(holes=0)), GRID, "z", 3), "z")
    assert np.isfinite(out).sum() == 14 * 18 and np.isfinite(out[3:17, 3:21]).all()


def blur_numpy(a, sigma):
    k = R.gaussian_kernel(sigma)

    def one(v):
        return np.convolve(np.pad(v, len(k) // 2, mode="symmetric"), k, mode="valid")

    def both(x):
        return np.apply_along_axis(one, 0, np.apply_along_axis(one, 1, x))

    return both(np.nan_to_num(a)) / both(np.isfinite(a).astype(float))


def test_blur_matches_numpy_for_narrow_and_very_wide_kernels(spark):
    a = surface(1, 0.2)
    for sigma in (1.0, 3.0, 40.0):
        out = dense(R.blur(layer(spark, a), GRID, "z", sigma), "smooth")
        want = blur_numpy(a, sigma)
        ok = np.isfinite(out)
        assert ok.mean() > 0.9 and np.allclose(out[ok], want[ok])


def test_blur_keeps_a_constant(spark):
    a = np.where(np.isfinite(surface(2, 0.3)), 7.0, np.nan)
    out = dense(R.blur(layer(spark, a), GRID, "z", 2.0), "smooth")
    assert np.allclose(out[np.isfinite(out)], 7.0)


def test_terrain_of_a_plane(spark):
    r, c = np.mgrid[0:20, 0:24]
    t = R.terrain(layer(spark, 2.0 * c + 0.0 * r), GRID, "z", outer=4).toPandas()
    assert len(t) == 12 * 16
    assert np.allclose(t["slope"], np.degrees(np.arctan(2.0))) and np.allclose(t["vrm"], 0) and np.allclose(t["bpi"], 0)


def test_extrema_keep_plateaus_and_even_boxes(spark):
    a = np.full((20, 24), 1.0)
    a[5, 5] = a[5, 6] = 300.0
    a[15, 15] = -400.0
    got = {(x["row"], x["col"]) for x in R.extrema(layer(spark, a), GRID, "z", 100.0, 20).collect()}
    mag = np.abs(a)
    want = {
        (i, j)
        for i, j in zip(*np.nonzero(mag > 100))
        if mag[i, j] == mag[max(0, i - 10) : i + 10, max(0, j - 10) : j + 10].max()
    }
    assert got == want


def test_contours_of_a_ramp(spark):
    r, c = np.mgrid[0:20, 0:24]
    s = R.contour_segments(layer(spark, c + 0.25 + 0.0 * r), GRID, "z").toPandas()
    assert set(s["depth_m"]) == {5, 10, 15, 20} and (s.groupby("depth_m").size() == 19).all()
    assert np.allclose(s["x1"], s["depth_m"] - 0.25 + 0.5) and np.allclose(s["x1"], s["x2"])
    assert set(s.loc[s["kind"] == "major", "depth_m"]) == {10, 20}


def test_contour_levels():
    assert R.contour_levels(31.0) == [5, 10, 15, 20, 25, 30, 35]


def test_bilinear_of_a_plane_is_exact(spark):
    r, c = np.mgrid[0:20, 0:24]
    out = R.resample_bilinear(layer(spark, 3.0 * c - r), GRID, Grid(2.3, 17.1, 0.7, 15, 18), "z").toPandas()
    u = 2.3 + (out["col"] + 0.5) * 0.7 - 0.5
    v = 20 - (17.1 - (out["row"] + 0.5) * 0.7) - 0.5
    assert len(out) == 270 and np.allclose(out["z"], 3 * u - v)


def test_projection_round_trip_below_a_millimetre(spark):
    p = spark.range(400).select((F.lit(119.0) + F.col("id") % 20 * 0.2).alias("lon"), (F.lit(21.5) + F.floor(F.col("id") / 20) * 0.2).alias("lat"))
    x, y = project(F.col("lon"), F.col("lat"))
    p = p.withColumn("x", x).withColumn("y", y)
    lon, lat = unproject(F.col("x"), F.col("y"))
    err = p.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(err) * 111_000 < 1e-3


def test_projection_known_scale(spark):
    x, y = project(F.lit(121.0), F.lit(0.0))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(row["x"] - 250000) < 1e-6 and abs(row["y"]) < 1e-6


def test_layers_round_trip_and_prune(spark, tmp_path):
    a = layer(spark, surface(4)).withColumnRenamed("z", "value")
    R.write_layer(a, "depth", str(tmp_path / "cells"))
    R.write_layer(a.where("row < 5"), "other", str(tmp_path / "cells"))
    back = R.read_layer(spark, str(tmp_path / "cells"), "depth")
    assert back.count() == a.count()
    assert "PartitionFilters: [isnotnull(layer" in back._jdf.queryExecution().executedPlan().toString()
