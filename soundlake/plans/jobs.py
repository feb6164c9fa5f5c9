"""Jobs that turn survey tables into layers. Each takes DataFrames and returns DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.functions import acoustic as A
from soundlake.functions.geo import offset_position, project, towfish_layback
from soundlake.operators import along, altitude, cube, lines, mosaic, radiometry, raster, trace
from soundlake.operators.along import Track
from soundlake.operators.knn import confidence, idw
from soundlake.operators.lineage import cut
from soundlake.operators.raster import Grid
from soundlake.operators.stats import attach, bootstrap_median, quantiles, unimodality
from soundlake.plans.magnetics import big_lines


def class_colours(classes: DataFrame, depth: DataFrame) -> DataFrame:
    """Three bands per cell: the class colour, white where there is no class or no depth."""
    pal = F.array(*[F.lit(c) for c in K.SEDIMENT_COLORS])
    known = F.col("class_id").between(0, len(K.SEDIMENT_COLORS) - 1)
    have = depth.select("row", "col", F.lit(True).alias("_have"))
    j = classes.join(have, ["row", "col"], "left")
    color = F.when(known & F.col("_have"), F.get(pal, F.col("class_id"))).otherwise(F.lit("#FFFFFF"))
    j = j.withColumn("_c", color)
    for i, band in enumerate(("red", "green", "blue")):
        j = j.withColumn(band, A.hex_channel(F.col("_c"), i))
    return j.drop("_c", "_have")


def depth_layer(xyz: DataFrame, res: float, grid: Grid, edge: int = 5) -> DataFrame:
    """Soundings to a depth raster with its ragged edge eroded."""
    g = raster.points_to_grid(xyz, res)
    return raster.erode(g.select("row", "col", "z"), grid, "z", edge)


def terrain_layers(depth: DataFrame, grid: Grid) -> DataFrame:
    return raster.terrain(depth, grid, "z")


def depth_contours(depth: DataFrame, grid: Grid, sigma: float = 10.0) -> DataFrame:
    s = raster.blur(depth, grid, "z", sigma)
    return raster.contour_segments(s, grid, "smooth")


def contour_features(depth: DataFrame, grid: Grid, sigma: float = 10.0) -> DataFrame:
    """A depth raster to contour lines as features, one LineString in lon/lat a row."""
    s = cut(raster.blur(depth, grid, "z", sigma), "smooth")
    return lines.contour_features(lines.contour_lines(s, grid, "smooth"), digits=7)


# --- side scan ------------------------------------------------------------------------------------------


def sidescan_samples(pings: DataFrame, track: Track, depth: DataFrame, grid: Grid, seq: str = "seq") -> DataFrame:
    """Pings to georeferenced samples: turn filter, layback, altitude, projection, gain.

    ``pings`` is a stored table of line columns, channel, seq, t, amps, pix_m, lat, lon, heading, roll,
    depth_m, cable_length, pos_source. Everything but the first return and the projection works on its
    narrow columns; the narrow results are stored so that traces are read twice in all.
    """
    line, order = list(track.line), list(track.order)
    p = along.turn_filter(pings.drop("amps"), track, "t", "heading", "roll", F.col("pos_source") != 255)
    back = towfish_layback(F.col("cable_length"), F.col("depth_m"))
    lat, lon = offset_position(F.col("lat"), F.col("lon"), F.col("heading") + 180, back)
    p = p.withColumn("_lat", lat).withColumn("_lon", lon).drop("lat", "lon")
    p = p.withColumnsRenamed({"_lat": "lat", "_lon": "lon"})
    x, y = project(F.col("lon"), F.col("lat"))
    p = grid.locate(p.withColumn("_x", x).withColumn("_y", y), "_x", "_y")
    p = p.join(depth.select("row", "col", F.col("z").alias("seabed")), ["row", "col"], "left").drop("row", "col", "_x", "_y")
    p = attach(p, depth.agg((F.max("z") * 1.15).alias("ceiling")), [])
    p = cut(p, "kept")
    key = list(dict.fromkeys([*line, *order]))
    traces = pings.select(*key, "amps")
    raw = trace.with_first_return(p.join(traces, key), "amps", "pix_m", F.col("ceiling"))
    alt = A.accept_altitude(F.col("first_return"), F.col("seabed"), F.col("depth_m"), F.col("ceiling"))
    raw = cut(raw.select(*key, alt.alias("raw_alt")), "altitude")
    smooth = altitude.smooth(raw, track, "raw_alt", out="altitude").drop("raw_alt")
    p = p.join(smooth, key).where("altitude is not null and lat is not null").join(traces, key)
    side = F.when(F.col("channel").contains("port"), -90.0).otherwise(90.0)
    keep = list(dict.fromkeys([*line, "channel", seq, "lat", "lon", "heading"]))
    s = trace.project_samples(p, "amps", "pix_m", "altitude", A.far_cutoff(F.col("channel")), keep, "heading", side)
    return radiometry.normalise_gain(cut(s, "samples"), line, "bs_linear", "bs")


def sidescan_pings_numbered(samples: DataFrame, line: list[str], seq: str = "seq") -> DataFrame:
    """Samples with a global ping ordinal that does not collide between lines."""
    t = Track(tuple(line), (seq,), F.floor(F.col(seq) / 100_000))
    ids = samples.select(*line, seq).distinct()
    ids = along.ordinals(ids, t, "_no").withColumn("_no", F.col("_no") - 1)
    ids = along.global_ping_ids(ids, t, line, "_no").drop("_no")
    return samples.join(ids, [*line, seq])


def sidescan_mosaic(samples: DataFrame, depth: DataFrame, grid: Grid, far: Column, k: int = 7) -> DataFrame:
    """Corrected samples to level, cluster and confidence layers at the grid's resolution."""
    c = cut(radiometry.correct(samples, "ping_ord", "bs", "altitude", "inc_angle", far, k))
    return mosaic_at(c, depth, grid)


def mosaic_at(corrected: DataFrame, depth: DataFrame, grid: Grid) -> DataFrame:
    x, y = project(F.col("lon"), F.col("lat"))
    p = grid.locate(corrected.withColumn("_x", x).withColumn("_y", y), "_x", "_y")
    return mosaic.mosaic(p, grid, depth, "bs_db", "inc_angle", "label", ["ping_ord", "sample"])


# --- sub-bottom ---------------------------------------------------------------------------------------------


def sediment_layers(
    pings: DataFrame, track: Track, cc: float, depth: DataFrame, grid: Grid, gap: float = 70.0, k: int = 12,
    sigma: float = 20.0, leaf: float = 2.0, blanking: int = K.BLANKING, min_samples: int = 100,
) -> DataFrame:
    """Reflection loss, sediment class and confidence per depth cell.

    ``pings``: line columns, order columns, amps, x, y. The smoothed loss bleeds past the coverage; only
    classes and confidence are kept to depth cells.
    """
    line = list(track.line)
    rl = cut(trace.reflection_loss(pings, cc, blanking, min_samples).drop("amps"), "rl")
    rl = cut(along.ordinals(rl, track, "ord", "n"), "rl")
    rl = along.despike(rl, line, "rl", "rl_clean").where("rl_clean is not null")
    pts = rl.select(*line, "ord", F.col("x").alias("px"), F.col("y").alias("py"), F.col("rl_clean").alias("rl"))
    cells = grid.centres(depth.select("row", "col"), "qx", "qy")
    got = idw(cells, cut(pts, "points"), ["row", "col"], [*line, "ord"], "rl", k, gap, leaf)
    got = cut(got.withColumn("rl", F.greatest(F.lit(K.RL_MIN), F.least(F.lit(K.RL_MAX), "rl"))), "gridded")
    soft = raster.blur(got, grid, "rl", sigma)
    out = soft.join(depth.select("row", "col", F.lit(True).alias("_d")), ["row", "col"], "left")
    out = out.join(got.select("row", "col", "nearest"), ["row", "col"], "left")
    on = F.col("_d")
    far_away = F.coalesce("nearest", F.lit(float("inf")))
    return out.select(
        "row",
        "col",
        F.col("smooth").alias("rl"),
        F.when(on, A.sediment_class(F.col("smooth"))).alias("sediment_class"),
        F.when(on, confidence(far_away, grid.res)).alias("confidence"),
    )


def thickness_layer(
    picks: DataFrame, pid: list[str], classes: DataFrame, grid: Grid, least: int = 30, gap: float = 70.0, k: int = 12,
    sigma: float = 8.0, leaf: float = 2.0,
) -> DataFrame:
    """Measured thickness where picks are near, modelled thickness elsewhere, smoothed, with its source.

    Fewer than ``least`` picks, or none within reach of a cell, give the modelled layer alone, unsmoothed.
    """
    spark = classes.sparkSession
    valid = classes.where("sediment_class is not null and sediment_class >= 0")
    model = valid.join(
        F.broadcast(A.sediment_table(spark).select(F.col("class_id").alias("sediment_class"), "thickness")),
        "sediment_class",
    ).select("row", "col", "thickness")
    picks = cut(picks, "picks")
    enough = len(picks.take(least)) >= least
    if not enough:
        return raster.hybrid(model.limit(0), model, "thickness").withColumnRenamed("thickness", "isopach")
    pts = picks.select(*pid, F.col("x").alias("px"), F.col("y").alias("py"), "thickness")
    cells = grid.centres(valid.select("row", "col"), "qx", "qy")
    measured = cut(idw(cells, pts, ["row", "col"], pid, "thickness", k, gap, leaf), "measured")
    if measured.isEmpty():
        return raster.hybrid(model.limit(0), model, "thickness").withColumnRenamed("thickness", "isopach")
    both = cut(raster.hybrid(measured, model, "thickness"), "hybrid")
    soft = raster.blur(both, grid, "thickness", sigma, out="isopach")
    return soft.join(both.select("row", "col", "source"), ["row", "col"])


def isopach(
    traces: DataFrame, pid: list[str], cc: float, classes: DataFrame, grid: Grid, strict: bool = True, blanking: int = K.BLANKING, min_samples: int = 100,
    sample_ns: float = K.SAMPLE_NS, **layer,
) -> DataFrame:
    """Thickness of the uppermost layer from sub-bottom traces (ids, x, y, amps) and the survey's constant to the smoothed raster layer with its source."""
    picks = trace.thickness_picks(traces, [*pid, "x", "y"], cc, strict, blanking, min_samples, sample_ns)
    return thickness_layer(picks.select(*pid, "x", "y", "thickness"), pid, classes, grid, **layer)


def calibration_segments(
    pings: DataFrame, track: Track, vrm_limit: float | None = None, least: int = 100, start: int = 50,
    depth_std: float = 0.5, amp_cv: float = 0.35, blanking: int = K.BLANKING, **cal,
) -> DataFrame:
    """Calibration segments: long runs of pings over flat, even ground, with their constant.

    ``pings``: line and order columns, amps, depth, vrm, slope, bpi. The ruggedness limit is the survey's
    20th percentile unless given. Lines with fewer than ``least`` pings are left out.
    """
    line = list(track.line)
    key = list(dict.fromkeys([*line, *track.order]))
    # The traces enter twice: once for the bottom amplitude, once for the accepted segments.
    p = cut(trace.bottom(pings, blanking=blanking).drop("amps", "idx_b"), "bottoms")
    if vrm_limit is None:
        p = attach(p, quantiles(p, [], "vrm", {"_vlim": 0.2}), [])
    else:
        p = p.withColumn("_vlim", F.lit(vrm_limit))
    tagged = cut(along.runs_tag(big_lines(p, line, least), track, good_ground()).where("_flag"), "runs")
    # An uneven depth or a start in the warm-up shows in the aggregates of the run.
    amp = F.when(F.col("amp_b") > 0, F.col("amp_b"))
    seg = tagged.groupBy(*line, "run").agg(
        (F.min("ord") - 1).alias("start"),
        F.count(F.lit(1)).alias("length"),
        F.avg("depth").alias("depth_mean"),
        F.stddev_pop("depth").alias("depth_std"),
        F.count(amp).alias("n_amp"),
        F.try_divide(F.stddev_pop(amp), F.avg(amp)).alias("amp_cv"),
    )
    seg = cut(seg.where(accept_segment(least, start, depth_std, amp_cv)), "segments")
    rows = tagged.join(seg.select(*line, "run"), [*line, "run"], "left_semi").select(*key, "run")
    cc = trace.calibration(rows.join(pings.select(*key, "amps"), key), [*line, "run"], blanking=blanking, **cal)
    out = seg.join(cc.select(*line, "run", "cc"), [*line, "run"]).where("cc > 0")
    return out.withColumn("cc_db", 20 * F.log10("cc"))


def survey_constant(segments: DataFrame, line: str, reps: int = 2000) -> DataFrame:
    """One row for the survey from its :func:`calibration_segments`: number of segments, constant in dB (their median), linear, its spread and the
    95 % interval of the median (NULL below three segments), modes of the constants and how far the median lies from the main one."""
    c = cut(segments.select(F.lit(0).alias("survey"), F.col(line).alias("line"), "run", "cc_db"), "constants")
    out = bootstrap_median(c, "cc_db", Track(("survey",), ("line", "run"), F.col("line")), reps)
    modes = unimodality(c, "cc_db").select("n_modes", "mode", "gap_db")
    out = attach(out, modes, [])
    return out.select(F.col("n").alias("segments"), F.col("median").alias("cc_db"), F.pow(F.lit(10.0), F.col("median") / 20).alias("cc"), F.col("std").alias("cc_std"), "ci_lo", "ci_hi", "n_modes", "mode", "gap_db")


def good_ground(slope: float = 6.0, bpi: float = 0.3) -> Column:
    """Flat, smooth ground with a depth; NULL anywhere is not good."""
    ok = (
        (F.col("vrm") < F.col("_vlim")) & (F.col("slope") < slope) & (F.abs("bpi") < bpi) & F.col("depth").isNotNull()
    )
    return F.coalesce(ok, F.lit(False))


def accept_segment(least: int = 100, start: int = 50, depth_std: float = 0.5, amp_cv: float = 0.35) -> Column:
    return (
        (F.col("length") >= least) & (F.col("start") >= start) & (F.col("depth_std") <= depth_std)
        & (F.col("n_amp") >= least // 2) & (F.col("amp_cv") <= amp_cv)
    )


def fixed_segments(
    pings: DataFrame, track: Track, size: int = 100, blanking: int = K.BLANKING, **cal
) -> DataFrame:
    """Constant and spread of log amplitude per full segment of ``size`` pings: (line, seg, cc, log_std)."""
    line = list(track.line)
    key = list(dict.fromkeys([*line, *track.order]))
    b = cut(trace.bottom(pings, blanking=blanking).where("amp_b > 0").select(*key, "amp_b"), "bottoms")
    b = along.ordinals(b, track, "ord", "n").withColumn("seg", along.segment_of(size))
    b = cut(b.where(F.col("seg") < F.floor(F.col("n") / size)), "segments")
    spread = b.groupBy(*line, "seg").agg(F.stddev_pop(F.log10(F.col("amp_b") + 1e-12)).alias("log_std"))
    rows = b.select(*key, "seg").join(pings.select(*key, "amps"), key)
    cc = trace.calibration(rows, [*line, "seg"], blanking=blanking, **cal)
    return spread.join(cc.select(*line, "seg", "cc"), [*line, "seg"])


def calibration_check(segments: DataFrame, amp_median: DataFrame, anchor_db: float = 14.6) -> DataFrame:
    """Compare segment constants with the anchor median * 10^(anchor/20): one row.

    ``amp_median`` has one row with ``median``. Stable segments are the 20 % with the least spread
    among the successful ones; their median needs more than five.
    """
    s = segments.withColumn("db", 20 * F.log10("cc"))
    ok = s.where("cc > 0")
    s2 = attach(ok, quantiles(ok, [], "log_std", {"lim": 0.2}), [])
    stable = s2.where("log_std <= lim")
    tot = s.agg(F.count(F.lit(1)).alias("n_segments"), F.count(F.when(F.col("cc") > 0, 1)).alias("n_ok"))
    all_ = quantiles(ok, [], "db", {"median_all": 0.5})
    few = quantiles(stable, [], "db", {"m": 0.5}, count="n_stable")
    out = attach(attach(attach(tot, all_, []), few, []), amp_median.select("median"), [])
    anchor = 20 * F.log10(F.col("median") * F.lit(10 ** (anchor_db / 20)))
    return out.select(
        "n_segments",
        "n_ok",
        "median_all",
        "n_stable",
        F.when(F.col("n_stable") > 5, F.col("m")).alias("median_stable"),
        anchor.alias("anchor_db"),
        (anchor - F.col("median_all")).alias("gap_db"),
    )


# --- waterfalls -------------------------------------------------------------------------------------------------


def waterfall_tables(pings: DataFrame, track: Track, keys: list[str], freq: str, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Slant-corrected two-sided waterfalls: (cells in dB, layout, per-file summary).

    ``pings``: keys, ord order columns, t, pix_m, amps_port, amps_stbd. Altitude comes from the port side
    and serves both.
    """
    p = trace.with_first_return(pings, "amps_port", "pix_m", **kw)
    alt = altitude.smooth(p, track, "first_return", carry=True, out="altitude").drop("first_return")
    p = cut(p.drop("first_return").join(alt, [*track.line, *track.order]), "pings")  # read several times for each side
    sides = None
    far = F.lit(K.FAR_CUTOFF[freq])
    for side in ("port", "stbd"):
        samples = p.select(*keys, F.explode(f"amps_{side}").alias("a"))
        ref = quantiles(samples, keys, "a", {"ref": 0.4}, where=F.col("a") > 0)
        q = p.join(ref, keys, "left")
        g = trace.to_ground_grid(q, f"amps_{side}", "pix_m", "altitude", far, [*keys, *track.order, "ref"])
        scaled = F.coalesce(F.col("value") / F.greatest("ref", F.lit(1e-6)), F.col("value"))
        g = g.withColumn("value", scaled).drop("ref").withColumn("side", F.lit(side))
        sides = g if sides is None else sides.unionByName(g)
    n = pings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pings")).where("n_pings >= 5")
    cells, layout = trace.merge_sides(sides.join(n.drop("n_pings"), keys, "left_semi"), keys, "side", n)
    cells = cells.withColumn("db", A.to_db(F.col("value")))
    return cells, layout, altitude_summary(p, keys, "altitude")


def altitude_summary(df: DataFrame, keys: list[str], alt: str) -> DataFrame:
    med = quantiles(df, keys, alt, {"alt_median": 0.5})
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pings"), F.min(alt).alias("alt_min"), F.max(alt).alias("alt_max")
    ).join(med, keys, "left")


# --- cube ---------------------------------------------------------------------------------------------------------


def build_cube(cells: DataFrame, layer_dim: DataFrame, grid: Grid) -> DataFrame:
    """All layers that exist, on the reference grid, categorical sentinels to NULL."""
    dim = layer_dim.collect()  # the layer registry: a handful of rows
    have = cube.present(cells, [r["var"] for r in dim])
    dtype = {r["var"]: r["dtype"] for r in dim if r["kind"] == "categorical"}
    wide = cube.build(cells, have, grid)
    for v in have:
        if v in dtype:
            wide = wide.withColumn(v, A.null_sentinel(F.col(v), dtype[v]))
    return wide
