"""The layered grid: one wide row per cell, and the point, region, profile and block queries."""

from __future__ import annotations

import math
import os
import shutil
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soundlake.functions import acoustic as A
from soundlake.functions.geo import nearest_centre, project, unproject
from soundlake.operators.lineage import cut, release
from soundlake.operators.raster import Grid
from soundlake.operators.stats import attach, quantiles, summary

LAYER_SCHEMA = "var string, units string, dtype string, kind string, desc string"


def build(cells: DataFrame, layers: list[str], grid: Grid | None = None) -> DataFrame:
    """Long cells ``(layer, row, col, value)`` to ``(row, col, <layer>...)``.

    One exchange for any number of layers. Layers without rows become all-NULL columns; pass only those
    that exist to skip them. With a grid, cell-centre ``x, y`` are added.
    """
    wide = cells.where(F.col("layer").isin(layers)).groupBy("row", "col").agg(
        *[F.max(F.when(F.col("layer") == v, F.col("value"))).alias(v) for v in layers]
    )
    return wide if grid is None else grid.centres(wide)


def present(cells: DataFrame, layers: list[str]) -> list[str]:
    """Those of ``layers`` that have cells, in the given order."""
    have = {r[0] for r in cells.where(F.col("layer").isin(layers)).select("layer").distinct().collect()}
    return [v for v in layers if v in have]


def melt(df: DataFrame, keys: list[str], layers: list[str]) -> DataFrame:
    """Wide to (keys, layer, value)."""
    return df.select(*keys, *[F.col(v).cast("double").alias(v) for v in layers]).unpivot(keys, layers, "layer", "value")


def layer_statistics(cube: DataFrame, layers: list[str], total: int) -> DataFrame:
    """Min, median, max, coverage per layer."""
    return summary(melt(cube, ["row", "col"], layers), ["layer"], "value", F.lit(total))


# Percentile pairs of the display ranges.
DISPLAY = {
    "default": (0.02, 0.98),
    "trace": (0.02, 0.95),
    "depth": (0.01, 0.99),
    "thickness": (0.10, 0.90),
}


def display_range(df: DataFrame, keys: list[str], value: str, kind: str = "default") -> DataFrame:
    """Percentile range; ``signed`` and ``bpi`` give a bound symmetric about zero."""
    if kind in ("signed", "bpi"):
        d = df.withColumn("_a", F.abs(value))
        return quantiles(d, keys, "_a", {"hi": 0.98}).select(*keys, (-F.col("hi")).alias("lo"), "hi")
    lo, hi = DISPLAY[kind]
    return quantiles(df, keys, value, {"lo": lo, "hi": hi})


def catalogue(cube: DataFrame, layers: list[str], layer_dim: DataFrame, grid: Grid) -> DataFrame:
    """One row per layer: description, display range, extent, and whether thickness is available."""
    rng = display_range(melt(cube, ["row", "col"], layers), ["layer"], "value")
    lon0, lat0 = unproject(F.lit(grid.left), F.lit(grid.top - grid.nrows * grid.res))
    lon1, lat1 = unproject(F.lit(grid.left + grid.ncols * grid.res), F.lit(grid.top))
    return layer_dim.withColumnRenamed("var", "layer").join(rng, "layer").select(
        "layer",
        "units",
        "kind",
        "desc",
        F.col("lo").alias("vmin"),
        F.col("hi").alias("vmax"),
        lon0.alias("west"),
        lat0.alias("south"),
        lon1.alias("east"),
        lat1.alias("north"),
        F.lit("isopach" in layers).alias("has_thickness"),
    )


def _at_points(points: DataFrame, cube: DataFrame, grid: Grid, layers: list[str], clamp: bool) -> DataFrame:
    x0, y0 = grid.left + grid.res / 2, grid.top - grid.res / 2
    x1, y1 = x0 + (grid.ncols - 1) * grid.res, y0 - (grid.nrows - 1) * grid.res
    p = points.withColumn("col", nearest_centre(F.col("x"), x0, grid.res, grid.ncols)).withColumn(
        "row", nearest_centre(-F.col("y"), -y0, grid.res, grid.nrows)
    )
    p = p.withColumn("outside", ~(F.col("x").between(x0, x1) & F.col("y").between(y1, y0)))
    if not clamp:
        p = p.withColumn("row", F.when(~F.col("outside"), F.col("row"))).withColumn(
            "col", F.when(~F.col("outside"), F.col("col"))
        )
    return p.join(cube.select("row", "col", *layers), ["row", "col"], "left")


def point_query(
    points: DataFrame, cube: DataFrame, grid: Grid, layers: list[str], class_layer: str | None = None,
    projected: bool = False,
) -> DataFrame:
    """All layers at the nearest cell of every point: (id, x, y, outside, layer, value, class_label).

    ``points`` has ``id`` and lon/lat (or x/y when ``projected``). Values are rounded half-even to four
    decimals; the class layer carries its label. Points beyond the outermost cell centres are flagged.
    """
    p = points
    if not projected:
        x, y = project(F.col("lon"), F.col("lat"))
        p = p.withColumn("x", x).withColumn("y", y)
    hit = _at_points(p, cube, grid, layers, clamp=False)
    long = melt(hit, ["id", "x", "y", "outside"], layers)
    is_class = F.col("layer") == F.lit(class_layer) if class_layer else F.lit(False)
    cls = F.when(is_class, F.col("value").cast("int"))
    return long.select(
        "id",
        F.bround("x", 1).alias("x"),
        F.bround("y", 1).alias("y"),
        "outside",
        "layer",
        F.bround("value", 4).alias("value"),
        F.when(cls.isNotNull(), A.class_label(cls)).alias("class_label"),
    )


def cells_in_boxes(cube: DataFrame, boxes: DataFrame, grid: Grid, layers: list[str], tile: int) -> DataFrame:
    """Cells x boxes that contain them, by an equi join on tiles of the grid."""
    b = boxes.select(
        "box",
        F.least("x0", "x1").alias("bx0"),
        F.greatest("x0", "x1").alias("bx1"),
        F.least("y0", "y1").alias("by0"),
        F.greatest("y0", "y1").alias("by1"),
    )
    c0 = F.greatest(F.lit(0), F.floor((F.col("bx0") - grid.left) / grid.res))
    c1 = F.least(F.lit(grid.ncols - 1), F.ceil((F.col("bx1") - grid.left) / grid.res))
    r0 = F.greatest(F.lit(0), F.floor((grid.top - F.col("by1")) / grid.res))
    r1 = F.least(F.lit(grid.nrows - 1), F.ceil((grid.top - F.col("by0")) / grid.res))
    b = b.where((c0 <= c1) & (r0 <= r1))
    b = b.withColumn("tc", F.explode(F.sequence(F.floor(c0 / tile), F.floor(c1 / tile))))
    b = b.withColumn("tr", F.explode(F.sequence(F.floor(r0 / tile), F.floor(r1 / tile))))
    cells = grid.centres(cube.select("row", "col", *layers))
    cells = cells.withColumn("tc", F.floor(F.col("col") / tile)).withColumn("tr", F.floor(F.col("row") / tile))
    j = cells.join(b, ["tc", "tr"])
    return j.where(F.col("x").between(F.col("bx0"), F.col("bx1")) & F.col("y").between(F.col("by0"), F.col("by1")))


def tile_sums(cells: DataFrame, keys: list[str], layers: list[str], class_layer: str | None) -> DataFrame:
    """(keys, layer, c, n, vmin, vmax, vsum): sums that merge; the class layer has a row per class ``c``."""
    long = melt(cells, keys, layers).where(F.col("value").isNotNull())
    c = F.when(F.col("layer") == F.lit(class_layer or ""), F.col("value").cast("int"))
    return long.groupBy(*keys, "layer", c.alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("vmin"), F.max("value").alias("vmax"), F.sum("value").alias("vsum")
    )


def merged_sums(sums: DataFrame, keys: list[str]) -> DataFrame:
    return sums.groupBy(*keys, "layer", "c").agg(F.sum("n").alias("n"), F.min("vmin").alias("vmin"), F.max("vmax").alias("vmax"), F.sum("vsum").alias("vsum"))


@dataclass(frozen=True)
class Pyramid:
    """Sums of a cube's layers over tiles of ``side`` cells, over tiles of FAN x FAN of those, and so on up to one tile.

    ``sums`` is (level, tr, tc, layer, c, n, vmin, vmax, vsum), a table that is stored once and answers any box.
    """

    sums: DataFrame
    side: int
    levels: int
    layers: tuple[str, ...]
    class_layer: str | None


#: Tiles of one level along a side of a tile of the next.
FAN = 4


def pyramid(cube: DataFrame, grid: Grid, layers: list[str], class_layer: str | None = None, side: int = 64) -> Pyramid:
    """One pass over the cells for the smallest tiles; every further level reads the level below."""
    levels = 1
    while side * FAN ** (levels - 1) < max(grid.nrows, grid.ncols):
        levels += 1
    tiles = cube.withColumn("tr", F.floor(F.col("row") / side)).withColumn("tc", F.floor(F.col("col") / side))
    below = cut(tile_sums(tiles, ["tr", "tc"], layers, class_layer), "pyramid")
    parts = [below.withColumn("level", F.lit(0))]
    for i in range(1, levels):
        up = below.withColumn("tr", F.floor(F.col("tr") / FAN)).withColumn("tc", F.floor(F.col("tc") / FAN))
        below = merged_sums(up, ["tr", "tc"])
        parts.append(below.withColumn("level", F.lit(i)))
    sums = cut(reduce(DataFrame.unionByName, parts), "pyramid")
    release(parts[0])
    return Pyramid(sums, side, levels, tuple(layers), class_layer)


def _covering(boxes: DataFrame, grid: Grid, side: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """(tiles of any level that lie inside a box and in no larger such tile, smallest tiles that its rim cuts); arithmetic on the boxes alone."""
    lo_x, hi_x, lo_y, hi_y = F.least("x0", "x1"), F.greatest("x0", "x1"), F.least("y0", "y1"), F.greatest("y0", "y1")
    west, east = (lo_x - grid.left) / grid.res, (hi_x - grid.left) / grid.res
    north, south = (grid.top - hi_y) / grid.res, (grid.top - lo_y) / grid.res
    b = boxes.select(
        "box",
        F.greatest(F.floor(north), F.lit(0)).alias("r0"), F.least(F.floor(south), F.lit(grid.nrows - 1)).alias("r1"),
        F.greatest(F.floor(west), F.lit(0)).alias("c0"), F.least(F.floor(east), F.lit(grid.ncols - 1)).alias("c1"),
        # Whole cells inside, with half a cell to spare around their centres; beyond the grid's edge there is nothing to miss.
        F.when(north <= 0, F.lit(0)).otherwise(F.ceil(north)).alias("i0"), F.when(south >= grid.nrows, F.lit(10**9)).otherwise(F.floor(south) - 1).alias("i1"),
        F.when(west <= 0, F.lit(0)).otherwise(F.ceil(west)).alias("j0"), F.when(east >= grid.ncols, F.lit(10**9)).otherwise(F.floor(east) - 1).alias("j1"),
    )
    steps = F.explode(F.expr(f"flatten(transform(sequence(0, {FAN - 1}), a -> transform(sequence(0, {FAN - 1}), b -> named_struct('a', a, 'b', b))))"))
    zero = F.lit(0).cast("long")
    part, inner = b.where("r0 <= r1 and c0 <= c1").withColumns({"tr": zero, "tc": zero}), []
    for level in reversed(range(levels)):
        size = side * FAN**level
        if level < levels - 1:
            part = part.withColumn("_d", steps).withColumns({"tr": F.col("tr") * FAN + F.col("_d.a"), "tc": F.col("tc") * FAN + F.col("_d.b")}).drop("_d")
            part = part.where(f"tr * {size} <= r1 and (tr + 1) * {size} > r0 and tc * {size} <= c1 and (tc + 1) * {size} > c0")
        whole = F.expr(f"tr * {size} >= i0 and least((tr + 1) * {size}, {grid.nrows}) - 1 <= i1 and tc * {size} >= j0 and least((tc + 1) * {size}, {grid.ncols}) - 1 <= j1")
        inner.append(part.where(whole).select("box", F.lit(level).alias("level"), "tr", "tc"))
        part = part.where(~whole)
    return reduce(DataFrame.unionByName, inner), part.select("box", "tr", "tc")


def rim_cells(boxes: DataFrame, cube: DataFrame, grid: Grid, summed: Pyramid) -> DataFrame:
    """The cells that a region query reads: those in a box and in a smallest tile that its rim cuts, so their number grows with the boxes' edges."""
    _, rim = _covering(boxes, grid, summed.side, summed.levels)
    size = summed.side
    cells = grid.centres(cube.select("row", "col", *summed.layers)).withColumn("tr", F.floor(F.col("row") / size)).withColumn("tc", F.floor(F.col("col") / size))
    b = boxes.select("box", "x0", "x1", "y0", "y1").join(rim, "box")
    j = cells.join(b, ["tr", "tc"])
    return j.where(F.col("x").between(F.least("x0", "x1"), F.greatest("x0", "x1")) & F.col("y").between(F.least("y0", "y1"), F.greatest("y0", "y1")))


def region_query(
    boxes: DataFrame, cube: DataFrame, grid: Grid, layers: list[str], class_layer: str | None = None, tile: int = 64, summed: Pyramid | None = None
) -> DataFrame:
    """Per (box, layer): min, max, mean, or dominant class and its purity.

    ``boxes`` is (box, x0, y0, x1, y1) with corners in any order. With a stored :func:`pyramid` of these layers, tiles inside a box are answered
    from it and only the tiles at its rim from cells; without, all cells inside are aggregated straight after the tile join, map-side first.
    """
    if summed is None:
        sums = tile_sums(cells_in_boxes(cube, boxes, grid, layers, tile), ["box"], layers, class_layer)
    else:
        inner, _ = _covering(boxes, grid, summed.side, summed.levels)
        inner = inner.join(summed.sums, ["level", "tr", "tc"]).drop("level", "tr", "tc")
        sums = merged_sums(inner.unionByName(tile_sums(rim_cells(boxes, cube, grid, summed), ["box"], list(summed.layers), class_layer)), ["box"])
        sums = sums.where(F.col("layer").isin(layers))
    out = sums.where(F.col("layer") != F.lit(class_layer or "")).select(
        "box",
        "layer",
        F.bround("vmin", 4).alias("vmin"),
        F.bround("vmax", 4).alias("vmax"),
        F.bround(F.col("vsum") / F.col("n"), 4).alias("vmean"),
        F.lit(None).cast("string").alias("dominant"),
        F.lit(None).cast("double").alias("purity"),
    )
    if class_layer:
        dom = sums.where(F.col("layer") == class_layer).groupBy("box", "layer").agg(
            F.max_by("c", F.struct("n", -F.col("c"))).alias("c"),
            F.bround(100.0 * F.max("n") / F.sum("n"), 1).alias("purity"),
        )
        out = out.unionByName(
            dom.select("box", "layer", A.class_label(F.col("c")).alias("dominant"), "purity"), allowMissingColumns=True
        )
    box_layers = boxes.select(
        "box",
        F.bround(F.abs(F.col("x1") - F.col("x0")), 1).alias("width_m"),
        F.bround(F.abs(F.col("y1") - F.col("y0")), 1).alias("height_m"),
        *_corners(),
    ).withColumn("layer", F.explode(F.array(*[F.lit(v) for v in layers])))
    return box_layers.join(out, ["box", "layer"], "left")


def _corners() -> list[Column]:
    lon0, lat0 = unproject(F.col("x0"), F.col("y0"))
    lon1, lat1 = unproject(F.col("x1"), F.col("y1"))
    return [
        F.bround(F.least(lat0, lat1), 6).alias("south"),
        F.bround(F.least(lon0, lon1), 6).alias("west"),
        F.bround(F.greatest(lat0, lat1), 6).alias("north"),
        F.bround(F.greatest(lon0, lon1), 6).alias("east"),
    ]


def profile_query(
    paths: DataFrame, cube: DataFrame, grid: Grid, layers: list[str], depth: str = "bathymetry",
    thickness: str | None = None, projected: bool = False,
) -> DataFrame:
    """Layers along polylines given as text: (path, i, <layers>, sub_bottom).

    ``paths`` is (path, coords) with coords 'lon,lat;lon,lat;...'. A pair that does not parse keeps
    its place with NULLs; points off the grid take the edge cell.
    """
    p = paths.select("path", F.posexplode(F.split("coords", ";")).alias("i", "pair"))
    parts = F.split("pair", ",")
    ok = F.size(parts) == 2
    a = F.when(ok, F.trim(F.get(parts, F.lit(0))).try_cast("double"))
    b = F.when(ok, F.trim(F.get(parts, F.lit(1))).try_cast("double"))
    p = p.withColumn("lon", a).withColumn("lat", b)
    x, y = (F.col("lon"), F.col("lat")) if projected else project(F.col("lon"), F.col("lat"))
    both = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    p = p.withColumn("x", F.when(both, x)).withColumn("y", F.when(both, y))
    hit = _at_points(p, cube, grid, layers, clamp=True)
    # Spark's greatest/least skip NULLs, so a bad pair would land on an edge cell: blank it.
    cols = [F.when(both, F.bround(F.col(v).cast("double"), 4)).alias(v) for v in layers]
    out = hit.select("path", "i", *cols)
    sub = F.col(depth) + F.col(thickness) if thickness else F.lit(None).cast("double")
    return out.withColumn("sub_bottom", sub)


def block_query(
    cube: DataFrame, grid: Grid, box: tuple[float, float, float, float], depth: str, thickness: str | None = None,
    max_side: int = 150,
) -> DataFrame:
    """Strided block of at most ``max_side`` cells a side: (i, j, depth, bedrock), row-major from the north.

    The stride comes from the box and the grid alone. Missing depth takes the block's mean; bedrock is
    depth plus thickness (0 if missing).
    """
    x0, x1 = sorted((box[0], box[2]))
    y0, y1 = sorted((box[1], box[3]))

    def span(lo: float, hi: float, n: int) -> tuple[int, int]:
        a = max(0, math.ceil(lo / grid.res - 0.5 - 1e-9))
        b = min(n - 1, math.floor(hi / grid.res - 0.5 + 1e-9))
        return a, b

    c0, c1 = span(x0 - grid.left, x1 - grid.left, grid.ncols)
    r0, r1 = span(grid.top - y1, grid.top - y0, grid.nrows)
    step = max(1, math.ceil(max(c1 - c0 + 1, r1 - r0 + 1) / max_side))
    rows, cols = range(r0, r1 + 1, step), range(c0, c1 + 1, step)
    # At most max_side of each: the frame is made of them alone, and the cube's files are asked for nothing else.
    ids = cube.sparkSession.range(len(rows) * len(cols))
    frame = ids.select(*[F.expr(f"CAST({a} + {step} * {at} AS INT)").alias(n) for n, a, at in (("row", r0, f"(id div {max(1, len(cols))})"), ("col", c0, f"(id % {max(1, len(cols))})"))])
    take = ["row", "col", depth] + ([thickness] if thickness else [])
    near = cube.where(F.col("row").isin(list(rows)) & F.col("col").isin(list(cols))).select(*take)
    d = frame.join(near, ["row", "col"], "left")
    mean = d.agg(F.avg(depth).alias("_mean"))
    d = attach(d, mean, [])
    z = F.coalesce(F.col(depth), F.col("_mean"))
    rock = z + F.coalesce(F.col(thickness), F.lit(0.0)) if thickness else F.lit(None).cast("double")
    return d.select(
        ((F.col("row") - r0) / step).cast("int").alias("i"),
        ((F.col("col") - c0) / step).cast("int").alias("j"),
        z.alias("depth"),
        rock.alias("bedrock"),
    )


def block_texture(layer: DataFrame, value: str, rows: int) -> DataFrame:
    """Texture bytes of a block with its rows reversed: nodata counts as 0, min-max to 0..255."""
    v = layer.withColumn("_v", F.coalesce(F.col(value), F.lit(0.0)))
    lim = v.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    out = attach(v, lim, [])
    return out.select(
        (F.lit(rows - 1) - F.col("i")).alias("i"), "j", A.to_byte(F.col("_v"), F.col("_lo"), F.col("_hi")).alias("byte")
    )


# --- tracklines and features -------------------------------------------------------------------------

# Channel preference for a line's track.
CHANNEL_ORDER = ["HF_stbd", "LF_stbd", "HF_port", "LF_port"]


def preferred_channel(df: DataFrame, line: list[str], channel: str = "channel") -> DataFrame:
    """Rows of the first present channel of each line, whatever its number of fixes."""
    order = F.create_map(*[x for i, c in enumerate(CHANNEL_ORDER) for x in (F.lit(c), F.lit(i))])
    rank = order[F.col(channel)]
    best = df.where(rank.isNotNull()).groupBy(*line).agg(F.min(rank).alias("_best"))
    return df.join(best, line).where(rank == F.col("_best")).drop("_best")


def trackline_features(thinned: DataFrame, line: list[str], instrument: str) -> DataFrame:
    """One line feature per file from at most a few hundred thinned fixes with ``ord``, ``n``, lon, lat."""
    pts = F.array_sort(F.collect_list(F.struct("ord", "lon", "lat")))
    coords = F.transform(pts, lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    return thinned.where("n >= 2").groupBy(*line).agg(
        F.lit(instrument).alias("instrument"), F.max("n").alias("pings"), coords.alias("coords")
    )


def line_geojson(coords: Column, properties: Column) -> Column:
    pairs = F.transform(coords, lambda p: F.array(p["lon"], p["lat"]))
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            properties.alias("properties"),
            F.struct(F.lit("LineString").alias("type"), pairs.alias("coordinates")).alias("geometry"),
        )
    )


def point_geojson(lon: Column, lat: Column, properties: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
            properties.alias("properties"),
        )
    )


def target_rows(df: DataFrame) -> DataFrame:
    """Targets as the text a CSV holds: 2, 6 and 1 decimals, explicit sign."""
    return df.select(
        "target_id",
        F.format_string("%.2f", "x_m").alias("x_m"),
        F.format_string("%.2f", "y_m").alias("y_m"),
        F.format_string("%.6f", "lon").alias("lon"),
        F.format_string("%.6f", "lat").alias("lat"),
        F.format_string("%+.1f", "anomaly_nT").alias("anomaly_nT"),
        "polarity",
    )


#: Bits of row and column within one part of the space-filling curve: 2048 x 2048 cells.
PART_BITS = 11
#: Cells of a row group, and up to one Arrow batch more.
GROUP_ROWS = 1 << 18
#: Parts of a box that are looked up one by one; beyond, the whole table is listed.
FEW_PARTS = 1024


def curve_code(row: Column, col: Column) -> Column:
    """Place of a cell on the Z-order curve: bits of row and column by turns, so that near places are mostly near cells."""

    def spread(v: Column) -> Column:
        v = v.cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(row), 1).bitwiseOR(spread(col))


def curve_ranges(r0: int, r1: int, c0: int, c1: int, bits: int = PART_BITS, most: int = 64) -> list[tuple[int, int]]:
    """Parts of the curve that rows r0..r1 and columns c0..c1 touch, as at most ``most`` ranges; where there are more, those with the smallest gaps are joined.

    Quadrants that lie inside are one range each, so the work grows with the edge of the box and not with its area.
    """
    if r0 > r1 or c0 > c1:
        return []
    r0, r1, c0, c1 = (max(v, 0) >> bits for v in (r0, r1, c0, c1))
    level = max(r1, c1).bit_length()
    found, part = [], [(0, 0, 0)]  # ranges, and quadrants that the edge cuts: row, column, code
    while part:
        size, cut_by_edge = 1 << level, []
        for row, col, code in part:
            if row > r1 or row + size <= r0 or col > c1 or col + size <= c0:
                continue
            inside = row >= r0 and row + size - 1 <= r1 and col >= c0 and col + size - 1 <= c1
            if inside or len(part) > 4 * most:  # finer ones would only be joined again
                found.append((code, code + size * size - 1))
            else:
                cut_by_edge.append((row, col, code))
        level, half = level - 1, size >> 1
        part = [(row + a * half, col + b * half, code + (2 * a + b) * half * half) for row, col, code in cut_by_edge for a in (0, 1) for b in (0, 1)]
    found.sort()
    gaps = sorted(range(1, len(found)), key=lambda i: found[i - 1][1] - found[i][0])  # the widest first
    cuts = sorted(i for i in gaps[: most - 1] if found[i][0] > found[i - 1][1] + 1)
    return [(found[a][0], found[b - 1][1]) for a, b in zip([0, *cuts], [*cuts, len(found)])]


def on_curve(cells: DataFrame, bits: int = PART_BITS) -> DataFrame:
    """Cells dealt out by parts of the curve and in its order within them, with the part as ``curve``: ready to be written partitioned by it.

    Parts of a few cells cost a file each, not their bytes, so the planner is not left to join partitions by bytes.
    """
    c = cells.withColumn("_z", curve_code(F.col("row"), F.col("col")))
    c = c.withColumn("curve", F.shiftright("_z", 2 * bits))
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return c.repartition(tasks, "curve").sortWithinPartitions("curve", "_z").drop("_z")


def _mounted(spark: SparkSession, path: str) -> str | None:
    """A path on a local or mounted file system as the operating system knows it, else None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


class _Part:
    """The file of one part: appears under its name when it is whole, so that an attempt that broke off leaves nothing that is read and a second one replaces the first."""

    def __init__(self, folder: str, name: str, schema: pa.Schema, codec: str, metadata: dict[str, str]) -> None:
        try:
            os.mkdir(folder)
        except FileExistsError:  # by an earlier attempt
            pass
        self.path, self.half = f"{folder}/{name}", f"{folder}/.{name}.{TaskContext.get().taskAttemptId()}"
        self.file, self.held, self.rows = pq.ParquetWriter(self.half, schema, compression=codec, store_schema=False), [], 0
        self.file.add_key_value_metadata(metadata)

    def add(self, cells: pa.RecordBatch) -> None:
        self.held.append(cells)
        self.rows += cells.num_rows
        if self.rows >= GROUP_ROWS:
            self._group()

    def _group(self) -> None:
        self.file.write_table(pa.Table.from_batches(self.held), row_group_size=self.rows)
        self.held, self.rows = [], 0

    def close(self) -> None:
        if self.held:
            self._group()
        self.file.close()
        os.replace(self.half, self.path)

    def drop(self) -> None:
        self.file.close()
        os.remove(self.half)


def _parts_to(folder: str, codec: str, metadata: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes cells in the order of :func:`on_curve` to a folder per part, as ``partitionBy("curve")`` names them; gives the number of parts of a task."""
    codec = {"uncompressed": "none", "lz4_raw": "lz4"}.get(codec.lower(), codec.lower())

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, key, part, parts = f"part-{TaskContext.get().partitionId():05d}.parquet", None, None, 0
        try:
            for batch in batches:
                at, code = batch.schema.get_field_index("curve"), batch.column("curve")
                cells = batch.select([i for i in range(batch.num_columns) if i != at])
                codes, gone = code.fill_null(0).to_numpy(zero_copy_only=False), code.is_null().to_numpy(zero_copy_only=False)
                borders = np.flatnonzero((codes[1:] != codes[:-1]) | (gone[1:] != gone[:-1])) + 1
                for a, b in zip([0, *borders], [*borders, len(codes)]):
                    if a == b:
                        continue
                    here = "__HIVE_DEFAULT_PARTITION__" if gone[a] else str(codes[a])
                    if here != key:
                        if part:
                            part.close()
                        part, key, parts = None, here, parts + 1
                        part = _Part(f"{folder}/curve={here}", name, cells.schema, codec, metadata)
                    part.add(cells.slice(a, b - a))
            if part:
                part.close()
            part = None
        finally:
            if part:
                part.drop()
        yield pa.RecordBatch.from_pydict({"parts": pa.array([parts], pa.int64())})

    return put


def write(cube: DataFrame, path: str, bits: int = PART_BITS) -> None:
    """Wide cells as Parquet along the curve: a folder for each part, cells in curve order in its file, so that row groups are small blocks of the grid.

    On a local or mounted file system the tasks write the files themselves, into a folder that takes its place when all are there: Hadoop starts processes for every
    file there and moves the folders one by one, which is nearly all the time of parts of a few cells. Elsewhere Spark's writer does it.
    """
    spark, cells = cube.sparkSession, on_curve(cube, bits)
    to = _mounted(spark, path)
    if to is None:
        cells.write.mode("overwrite").partitionBy("curve").parquet(path)
        return
    half = f"{os.path.dirname(to)}/.{os.path.basename(to)}-{uuid.uuid4().hex}"
    metadata = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": cells.drop("curve").schema.json()}
    os.makedirs(half)
    try:
        put = _parts_to(half, spark.conf.get("spark.sql.parquet.compression.codec"), metadata)
        cells.mapInArrow(put, "parts long").write.format("noop").mode("overwrite").save()
        open(f"{half}/_SUCCESS", "w").close()
    except BaseException:
        shutil.rmtree(half, ignore_errors=True)
        raise
    if os.path.isdir(to) and not os.path.islink(to):
        shutil.rmtree(to)
    elif os.path.lexists(to):
        os.remove(to)
    os.rename(half, to)
    spark.catalog.refreshByPath(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("curve")


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a stored cube with the rows that each says it holds: (file, rows).

    On a local or mounted file system each task lists the parts whose names fall to it and opens their files, so no task, nor the driver, holds all names.
    """
    root, tasks = _mounted(spark, path), spark.sparkContext.defaultParallelism  # each reads all names of parts, so no more than run at once
    if root is None:
        return spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in (k for batch in batches for k in batch.column(0).to_pylist()):
            found = []
            with os.scandir(root) as parts:
                for part in parts:
                    if not part.name.startswith("curve=") or zlib.crc32(os.fsencode(part.name)) % tasks != k:
                        continue
                    with os.scandir(part.path) as files:
                        found += [(f.path, pq.read_metadata(f.path).num_rows) for f in files if not f.name.startswith((".", "_"))]
                    if len(found) >= 4096:
                        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*found))], ["file", "rows"])
                        found = []
            if found:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*found))], ["file", "rows"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(look, "file string, rows long")


def within(cells: DataFrame, r0: int, r1: int, c0: int, c1: int, bits: int = PART_BITS) -> DataFrame:
    """Cells of a box, of a stored table with ``curve``: only folders in the box's ranges are read, and in their files only row groups that meet it."""
    part = reduce(lambda a, b: a | b, [F.col("curve").between(a, b) for a, b in curve_ranges(r0, r1, c0, c1, bits)], F.lit(False))
    return cells.where(part & F.col("row").between(r0, r1) & F.col("col").between(c0, c1))


def _some_part(spark: SparkSession, path: str) -> list[str]:
    """The folder of the first part that the listing of a stored table gives, without the rest of that listing."""
    root, hadoop = _mounted(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    if root is not None:  # Hadoop would take the whole folder and ask for the state of every part
        with os.scandir(root) as parts:
            return next(([p.name] for p in parts if p.name.startswith("curve=")), [])
    listing = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()).listStatusIterator(hadoop(path))
    while listing.hasNext():
        name = listing.next().getPath().getName()
        if name.startswith("curve="):
            return [name]
    return []


def _folders(spark: SparkSession, path: str, r0: int, r1: int, c0: int, c1: int, bits: int) -> DataFrame:
    """The stored table, listed in the folders of a box only: one by one where it has few parts. A box without any gives a table of some other part."""
    high, wide = max(0, (r1 >> bits) - (r0 >> bits) + 1), max(0, (c1 >> bits) - (c0 >> bits) + 1)
    if high * wide > FEW_PARTS:
        return spark.read.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    places = [f"{path}/curve={p}" for a, b in curve_ranges(r0, r1, c0, c1, bits, max(1, high * wide)) for p in range(a, b + 1)]
    found = [p for p in places if files.exists(hadoop(p))] or [f"{path}/{p}" for p in _some_part(spark, path)]
    return spark.read.option("basePath", path).parquet(*found) if found else spark.read.parquet(path)


def read_box(spark: SparkSession, path: str, grid: Grid, box: tuple[float, float, float, float], bits: int = PART_BITS) -> DataFrame:
    """Cells of a stored cube whose centres lie in the box (x0, y0, x1, y1); corners in any order."""
    x0, x1 = sorted((box[0], box[2]))
    y0, y1 = sorted((box[1], box[3]))
    c0, c1 = math.ceil((x0 - grid.left) / grid.res - 0.5 - 1e-9), math.floor((x1 - grid.left) / grid.res - 0.5 + 1e-9)
    r0, r1 = math.ceil((grid.top - y1) / grid.res - 0.5 - 1e-9), math.floor((grid.top - y0) / grid.res - 0.5 + 1e-9)
    r0, r1, c0, c1 = max(r0, 0), min(r1, grid.nrows - 1), max(c0, 0), min(c1, grid.ncols - 1)
    return within(_folders(spark, path, r0, r1, c0, c1, bits), r0, r1, c0, c1, bits).drop("curve")
