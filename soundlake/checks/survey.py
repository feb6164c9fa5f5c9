"""Whole jobs on survey-like tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.checks.base import BLANK, along, by_seq, check, holed, r, r5, raster, raster_grid, trace, track
from soundlake.checks.neighbours import THICK
from soundlake.checks.rasters import HOLED, ROWS, blur_sql, box_sql, terrain_sql
from soundlake.checks.traces import BOTTOM, LOUD, SPEED, WIDE_SAMPLE, cal_sql, loud, pick_sql
from soundlake.operators import radiometry
from soundlake.operators.raster import Grid
from soundlake.plans import jobs, magnetics


@check("job_magnetic_layers")
def _(spark, d):
    t = track(spark, d).select(
        "line", "t", "seq", (F.col("line") % 13 * 8 + F.col("v") / 10).alias("x"), (F.col("line") % 11 * 9 + F.col("roll") + 6).alias("y"),
        (44000 + F.col("v")).alias("F_nT"), F.lit(95).alias("quality"))
    dim = t.select("line").distinct().withColumn("f_ref", F.lit(44000.0))
    rec = magnetics.filtered_lines(t, dim, ["line"], along())
    out = magnetics.layers(rec.select("line", "seq", "x", "y", "background", "anomaly"), ["line", "seq"], raster(spark, d), raster_grid(spark, d), reach=6.0, sigma_m=5.0, leaf=2.0)
    return out.select("row", "col", "confidence", *[r(c, 4).alias(c) for c in ("anomaly", "background", "residual")])


@check("job_magnetic_targets")
def _(spark, d):
    g = raster_grid(spark, d, 1.0)
    t = magnetics.targets(raster(spark, d).withColumn("z", F.col("z") * 10), g, "z", 100.0, 8, 9.0)
    return t.select("target_id", "polarity", *[r(c).alias(c) for c in ("x_m", "y_m", "lon", "lat", "anomaly_nT")])


@check("job_sediment_layers")
def _(spark, d):
    s = F.col("seq")
    p = trace(spark, d).withColumn("x", (s * 37 % 100).cast("double")).withColumn("y", (s * 53 % 100).cast("double"))
    out = jobs.sediment_layers(p, by_seq(), 2.0, raster(spark, d), raster_grid(spark, d), gap=9.0, k=12, sigma=2.0, blanking=BLANK, min_samples=60)
    return out.select("row", "col", r("rl", 4).alias("rl"), "sediment_class", "confidence")


CALIBRATE = f"""{BOTTOM}, rn AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY seq) - 1 AS i, seq % 10 / 10 < 0.85 AS good FROM bt),
    rr AS (SELECT *, CAST(sum(CASE WHEN good THEN 0 ELSE 1 END) OVER (PARTITION BY line ORDER BY seq) AS BIGINT) AS run FROM rn),
    sg AS (SELECT line, run, min(i) AS "start", count(*) AS length, stddev_pop(amp_b) / avg(amp_b) AS amp_cv FROM rr WHERE good GROUP BY line, run HAVING count(*) >= 2 AND min(i) >= 1 AND stddev_pop(amp_b) / avg(amp_b) <= 0.9),
    sel AS (SELECT line, run, amps FROM rr SEMI JOIN sg USING (line, run) WHERE good), {cal_sql('sel', 'line, run', 2)}"""


@check("job_calibration", "trace", f"WITH {CALIBRATE} SELECT line, run, \"start\", length, ROUND(amp_cv, 6) AS amp_cv, ROUND(cc, 9) AS cc, ROUND(20 * log10(cc), 6) AS cc_db FROM sg JOIN cc USING (line, run) WHERE cc > 0")
def _(spark, d):
    s = F.col("seq")
    p = trace(spark, d).withColumn("vrm", s % 10 / 10.0).withColumn("slope", F.lit(1.0)).withColumn("bpi", F.lit(0.1)).withColumn("depth", F.lit(20.0))
    c = jobs.calibration_segments(p, by_seq(), 0.85, 2, 1, 0.5, 0.9, BLANK, min_pings=2, min_samples=60, min_window=1)
    return c.select("line", "run", "start", "length", r("amp_cv").alias("amp_cv"), r("cc", 9).alias("cc"), r("cc_db").alias("cc_db"))


@check("job_survey_constant", "trace", f"""WITH {CALIBRATE}, v AS (SELECT 20 * log10(cc) AS v, row_number() OVER (ORDER BY line, run) - 1 AS i, count(*) OVER () AS n FROM sg JOIN cc USING (line, run) WHERE cc > 0),
    dr AS (SELECT r, (((r * 2000003 + v.i * 7919 + 42) % 2147483647 * 48271 % 2147483647) * 48271 + 12345) % 2147483647 % n AS i FROM v, (SELECT unnest(range(2000)) AS r)),
    md AS (SELECT r, median(v.v) AS m FROM dr JOIN v ON dr.i = v.i GROUP BY r)
    SELECT (SELECT count(*) FROM v) AS segments, (SELECT ROUND(median(v), 6) FROM v) AS cc_db, (SELECT ROUND(pow(10, median(v) / 20), 9) FROM v) AS cc, (SELECT ROUND(stddev_pop(v), 6) FROM v) AS cc_std,
      ROUND(quantile_cont(m, 0.025), 6) AS ci_lo, ROUND(quantile_cont(m, 0.975), 6) AS ci_hi FROM md""")
def _(spark, d):
    """From traces to the survey's constant with its interval."""
    s = F.col("seq")
    p = trace(spark, d).withColumn("vrm", s % 10 / 10.0).withColumn("slope", F.lit(1.0)).withColumn("bpi", F.lit(0.1)).withColumn("depth", F.lit(20.0))
    c = jobs.calibration_segments(p, by_seq(), 0.85, 2, 1, 0.5, 0.9, BLANK, min_pings=2, min_samples=60, min_window=1)
    out = jobs.survey_constant(c, "line")
    return out.select("segments", r("cc_db").alias("cc_db"), r("cc", 9).alias("cc"), *[r(x).alias(x) for x in ("cc_std", "ci_lo", "ci_hi")])


PICKED = THICK[: THICK.index("pk AS (SELECT id")] + "ps AS (SELECT seq AS id, seq * 37 % 100 + 0.25 AS x, seq * 53 % 149 + 0.75 AS y, thickness AS t FROM pk WHERE thickness BETWEEN {lo} AND {hi}),\n" + THICK[THICK.index("    pr AS (") :].replace("JOIN pk ON", "JOIN ps ON").replace("    pr AS (", "    pz AS (").replace("FROM pr ", "FROM pz ").replace("    me AS (", "    mz AS (").replace("me.t", "mz.t").replace("LEFT JOIN me ", "LEFT JOIN mz ")


@check("job_isopach", "raster trace", f"WITH {LOUD.format(least=2)}, {pick_sql(False, SPEED)}, " + PICKED.format(lo=K.THICK_MIN, hi=K.THICK_MAX) + ", " + blur_sql(2, 8, ROWS).replace("{src}", "hy") + """ SELECT "row", col, ROUND(s, 5) AS isopach, source FROM bl JOIN hy USING ("row", col)""")
def _(spark, d):
    """From traces to the thickness layer."""
    s = F.col("seq")
    t = loud(spark, d).withColumn("x", s * 37 % 100 + 0.25).withColumn("y", s * 53 % 149 + 0.75)
    classes = raster(spark, d).select("row", "col", (F.floor("z") % 7).cast("int").alias("sediment_class"))
    out = jobs.isopach(t, ["seq"], 2.0e4, classes, raster_grid(spark, d), strict=False, blanking=2, min_samples=60, sample_ns=WIDE_SAMPLE, least=1, gap=6.0, sigma=2.0)
    return out.select("row", "col", r("isopach", 5).alias("isopach"), "source")


@check("job_sidescan_mosaic")
def _(spark, d):
    s = F.col("seq")
    lat, lon = F.lit(22.1398) + F.col("line") * 1e-4, F.lit(120.7792) + s * 1e-6
    p = trace(spark, d).select(
        "line", F.lit("HF_port").alias("channel"), "seq", s.cast("double").alias("t"), "amps", F.lit(0.5).alias("pix_m"), lat.alias("lat"), lon.alias("lon"),
        F.lit(90.0).alias("heading"), F.lit(0.0).alias("roll"), F.lit(1.0).alias("depth_m"), F.lit(15.0).alias("cable_length"), F.lit(0).alias("pos_source"))
    depth = raster(spark, d).withColumn("z", F.col("z") / 2)
    grid = Grid(227173.5, 2449210.5, 2.0, raster_grid(spark, d).nrows, 100)
    smp = jobs.sidescan_samples(p, by_seq(), depth, grid)
    smp = jobs.sidescan_pings_numbered(smp, ["line"])
    c = radiometry.normalise_gain(smp, ["line"], "bs_linear", "bs2")
    return c.select("line", "seq", "sample", "ping_ord", r("inc_angle").alias("inc_angle"), r("bs").alias("bs"), r("lat", 8).alias("lat"), r("lon", 8).alias("lon"))


@check("job_waterfalls")
def _(spark, d):
    t = trace(spark, d).withColumn("amps_stbd", F.reverse("amps")).withColumnRenamed("amps", "amps_port").withColumn("pix_m", F.lit(0.5))
    cells, layout, _ = jobs.waterfall_tables(t, by_seq(), ["line"], "HF", min_range=3.0, width=5)
    return cells.join(layout, "line").select("line", "seq", "side", "col", r("db", 4).alias("db"), "nadir_col")


@check("job_terrain", "raster", terrain_sql(10, 5))
def _(spark, d):
    g = raster_grid(spark, d)
    t = jobs.terrain_layers(raster(spark, d), g)
    return t.select("row", "col", r("slope", 5).alias("slope"), r("vrm", 5).alias("vrm"), r5("bpi", 5).alias("bpi"))




@check("job_sidescan_layers")
def _(spark, d):
    s = F.col("seq")
    lat, lon = F.lit(22.1398) + F.col("line") * 1e-4, F.lit(120.7792) + s * 1e-6
    p = trace(spark, d).select(
        "line", F.lit("HF_port").alias("channel"), "seq", s.cast("double").alias("t"), "amps", F.lit(0.5).alias("pix_m"), lat.alias("lat"), lon.alias("lon"),
        F.lit(90.0).alias("heading"), F.lit(0.0).alias("roll"), F.lit(1.0).alias("depth_m"), F.lit(15.0).alias("cable_length"), F.lit(0).alias("pos_source"))
    grid = Grid(227173.5, 2449210.5, 2.0, raster_grid(spark, d).nrows, 100)
    depth = grid.cells(spark).join(raster(spark, d).withColumn("z", F.col("z") / 2), ["row", "col"])
    samples = jobs.sidescan_pings_numbered(jobs.sidescan_samples(p, by_seq(), depth, grid), ["line"])
    out = jobs.sidescan_mosaic(samples, depth, grid, F.lit(65.0), k=3)
    return out.groupBy("label").agg(F.count("*").alias("cells"), F.count("db").alias("filled"), r(F.max("confidence")).alias("confidence"))


@check("job_depth_layer", "holed", f"""WITH {HOLED}, b AS ({box_sql(2, 'count(b.z) AS n')}) SELECT r AS "row", c AS col, ROUND(z, 6) AS z FROM b WHERE n = 25""")
def _(spark, d):
    g = raster_grid(spark, d, 0.5)
    xyz = holed(spark, d).where("z is not null").select((F.col("col") * 0.5).alias("x"), (F.lit(g.top) - F.col("row") * 0.5).alias("y"), (-F.col("z")).alias("z"))
    return jobs.depth_layer(xyz, 0.5, g, edge=2).select("row", "col", r("z").alias("z"))
