"""Rasters as ``(row, col, value)`` cells: a missing row or a NULL value is nodata.

Neighbourhood filters are separable: one window per raster row, one per raster column, each bounded by
the grid's geometry. Several filters share the two exchanges by asking for all their sums at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from soundlake.functions.geo import cell_of, centre_x, centre_y
from soundlake.operators.knn import idw, nearest


@dataclass(frozen=True)
class Grid:
    """North-up grid: ``left``/``top`` are the outer edges."""

    left: float
    top: float
    res: float
    nrows: int
    ncols: int

    @classmethod
    def from_bounds(cls, left: float, right: float, bottom: float, top: float, res: float) -> "Grid":
        return cls(left, top, res, round((top - bottom) / res), round((right - left) / res))

    def cells(self, spark: SparkSession) -> DataFrame:
        """Every (row, col), generated where it is used."""
        ids = spark.range(self.nrows * self.ncols)
        return ids.select(
            F.floor(F.col("id") / self.ncols).cast("int").alias("row"),
            (F.col("id") % self.ncols).cast("int").alias("col"),
        )

    def inside(self, row: Column, col: Column) -> Column:
        return row.between(0, self.nrows - 1) & col.between(0, self.ncols - 1)

    def locate(self, df: DataFrame, x: str, y: str) -> DataFrame:
        """Add (row, col) of the containing cell."""
        row, col = cell_of(F.col(x), F.col(y), self.left, self.top, self.res)
        return df.withColumn("row", row).withColumn("col", col)

    def centres(self, df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
        return df.withColumn(x, centre_x(F.col("col"), self.left, self.res)).withColumn(
            y, centre_y(F.col("row"), self.top, self.res)
        )


def bounds_of(df: DataFrame, res: float) -> Grid:
    """Grid spanned by the cells of a layer stored with projected centres ``x, y``."""
    b = df.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    h = res / 2
    return Grid.from_bounds(b[0] - h, b[1] + h, b[2] - h, b[3] + h, res)


#: Side of the tiles in which holes are filled, in cells.
FILL = 64


def dense(df: DataFrame, grid: Grid, rim: int, like: DataFrame | None = None) -> DataFrame:
    """The layer with NULL in its holes, as far as windows of ``rim`` cells can tell: in the tiles that hold data and those within reach.

    A survey that covers a hundredth of its bounding box stays about as large as it is. ``like`` names the occupied cells where ``df`` is costly.
    """
    near = F.sequence(F.lit(-math.ceil(rim / FILL)), F.lit(math.ceil(rim / FILL)))
    step = F.sequence(F.lit(0), F.lit(FILL - 1))
    tiles = (df if like is None else like).select(F.floor(F.col("row") / FILL).cast("int").alias("_tr"), F.floor(F.col("col") / FILL).cast("int").alias("_tc")).distinct()
    tiles = tiles.withColumn("_a", F.explode(near)).withColumn("_b", F.explode(near))
    tiles = tiles.select((F.col("_tr") + F.col("_a")).alias("_tr"), (F.col("_tc") + F.col("_b")).alias("_tc")).distinct()
    cells = tiles.withColumn("_i", F.explode(step)).withColumn("_j", F.explode(step))
    cells = cells.select((F.col("_tr") * FILL + F.col("_i")).alias("row"), (F.col("_tc") * FILL + F.col("_j")).alias("col"))
    return cells.where(grid.inside(F.col("row"), F.col("col"))).join(df, ["row", "col"], "left")


def _along_cols(half_lo: int, half_hi: int):
    return Window.partitionBy("row").orderBy("col").rangeBetween(-half_lo, half_hi)


def _along_rows(half_lo: int, half_hi: int):
    return Window.partitionBy("col").orderBy("row").rangeBetween(-half_lo, half_hi)


def box(df: DataFrame, specs: dict[str, tuple[str, Column, int, int]]) -> DataFrame:
    """Box statistics of a *dense* raster, all in two exchanges.

    ``specs``: name -> (``sum`` or ``max``, expression, offsets before, offsets after).
    """
    fn = {"sum": F.sum, "max": F.max}
    out = df
    for name, (how, expr, _, _) in specs.items():
        out = out.withColumn(f"_b_{name}", expr)
    for name, (how, _, lo, hi) in specs.items():
        out = out.withColumn(f"_c_{name}", fn[how](f"_b_{name}").over(_along_cols(lo, hi)))
    for name, (how, _, lo, hi) in specs.items():
        out = out.withColumn(name, fn[how](f"_c_{name}").over(_along_rows(lo, hi)))
    return out.select(*df.columns, *specs)


def _valid(value: str) -> Column:
    return F.col(value).isNotNull().cast("int")


def erode(df: DataFrame, grid: Grid, value: str, cells: int) -> DataFrame:
    """Keep valid cells whose whole (2n+1)^2 neighbourhood is valid; beyond the grid is invalid."""
    d = box(dense(df, grid, cells), {"_ok": ("sum", _valid(value), cells, cells)})
    return d.where(F.col("_ok") == (2 * cells + 1) ** 2).drop("_ok")


def gradient(df: DataFrame, value: str, res: float) -> DataFrame:
    """Central differences ``zx, zy`` where both neighbours exist, else NULL."""

    def ends(w, lo: int):
        return F.max(value).over(w.rangeBetween(lo, lo))

    across = Window.partitionBy("row").orderBy("col")
    down = Window.partitionBy("col").orderBy("row")
    return (
        df.withColumn("zx", (ends(across, 1) - ends(across, -1)) / (2 * res))
        .withColumn("zy", (ends(down, 1) - ends(down, -1)) / (2 * res))
    )


def slope(df: DataFrame, value: str, res: float) -> DataFrame:
    """Slope in degrees."""
    g = gradient(df, value, res)
    s = F.degrees(F.atan(F.sqrt(F.col("zx") * F.col("zx") + F.col("zy") * F.col("zy"))))
    return g.withColumn("slope", F.when(F.col(value).isNotNull(), s))


def ruggedness(df: DataFrame, grid: Grid, value: str, half: int = 2) -> DataFrame:
    """Vector ruggedness: 1 - |mean unit normal| over the box; NULL unless the box is complete."""
    g = slope(df, value, grid.res)
    s = F.radians("slope")
    flat = F.sqrt(F.col("zx") * F.col("zx") + F.col("zy") * F.col("zy"))
    unit = F.when(flat > 0, F.sin(s) / flat).when(flat == 0, F.lit(0.0))
    have = F.col("slope").isNotNull().cast("int")
    d = box(
        dense(g, grid, half, df),
        {
            "_nx": ("sum", unit * F.col("zx"), half, half),
            "_ny": ("sum", unit * F.col("zy"), half, half),
            "_nz": ("sum", F.cos(s), half, half),
            "_nn": ("sum", have, half, half),
        },
    )
    n = (2 * half + 1) ** 2
    r = F.sqrt(F.col("_nx") * F.col("_nx") + F.col("_ny") * F.col("_ny") + F.col("_nz") * F.col("_nz"))
    return d.withColumn("vrm", F.when(F.col("_nn") == n, 1 - r / n)).drop("_nx", "_ny", "_nz", "_nn")


def position_index(df: DataFrame, grid: Grid, value: str, inner: int = 1, outer: int = 10) -> DataFrame:
    """Value minus the mean of the box annulus, over the valid cells of the annulus."""
    d = box(
        dense(df, grid, outer),
        {
            "_so": ("sum", F.col(value), outer, outer),
            "_co": ("sum", _valid(value), outer, outer),
            "_si": ("sum", F.col(value), inner, inner),
            "_ci": ("sum", _valid(value), inner, inner),
        },
    )
    n = F.col("_co") - F.col("_ci")
    mean = F.when(n > 0, (F.col("_so") - F.col("_si")) / n)
    return d.where(F.col(value).isNotNull()).withColumn("bpi", F.col(value) - mean).drop("_so", "_co", "_si", "_ci")


def terrain(df: DataFrame, grid: Grid, value: str, inner: int = 1, outer: int = 10, half: int = 2) -> DataFrame:
    """Slope, ruggedness and position index on cells that survive erosion by ``outer`` cells."""
    r = ruggedness(df, grid, value, half)
    full = (2 * outer + 1) ** 2
    d = box(
        r,
        {
            "_so": ("sum", F.col(value), outer, outer),
            "_co": ("sum", _valid(value), outer, outer),
            "_si": ("sum", F.col(value), inner, inner),
        },
    )
    ring = full - (2 * inner + 1) ** 2
    return (
        d.where(F.col("_co") == full)
        .withColumn("bpi", F.col(value) - (F.col("_so") - F.col("_si")) / ring)
        .select("row", "col", value, "slope", "vrm", "bpi")
    )


def extrema(df: DataFrame, grid: Grid, value: str, threshold: float = 100.0, size: int = 20) -> DataFrame:
    """Cells above ``threshold`` that equal the largest magnitude of their box; plateaus are all kept.

    An even box reaches size/2 back and size/2 - 1 ahead.
    """
    lo, hi = size // 2, size - 1 - size // 2
    mag = F.coalesce(F.abs(value), F.lit(0.0))
    d = box(dense(df, grid, lo), {"_top": ("max", mag, lo, hi)})
    return d.where((F.abs(value) > threshold) & (F.abs(value) == F.col("_top"))).drop("_top")


# --- Gaussian blur ------------------------------------------------------------------------------


def gaussian_kernel(sigma: float) -> np.ndarray:
    """Kernel cut at four sigma and normalised."""
    r = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return k / k.sum()


def _convolved(lines: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Each line with the kernel, where that lies inside. Wide kernels go through the spectrum, so the cost does not grow with their width."""
    if len(kernel) <= 128:
        return np.stack([np.convolve(v, kernel, mode="valid") for v in lines])
    size = lines.shape[1] + len(kernel) - 1
    n = 1 << (size - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(lines, n) * np.fft.rfft(kernel, n), n)[:, len(kernel) - 1 : lines.shape[1]]


def _blur_lines(line: str, pos: str, length: int, sigma: float, keep_empty: bool):
    kernel = gaussian_kernel(sigma)
    r = len(kernel) // 2

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lines, at = np.unique(pdf[line].to_numpy(), return_inverse=True)
        p = pdf[pos].to_numpy()
        out = []
        for name in ("num", "den"):
            a = np.zeros((len(lines), length))
            a[at, p] = pdf[name].to_numpy()
            out.append(_convolved(np.pad(a, ((0, 0), (r, r)), mode="symmetric"), kernel))
        num, den = out
        keep = np.ones(den.shape, bool) if keep_empty else den > 0
        i, j = np.nonzero(keep)
        return pd.DataFrame({line: lines[i].astype("int32"), pos: j.astype("int32"), "num": num[i, j], "den": den[i, j]})

    return run


def blur(
    df: DataFrame, grid: Grid, value: str, sigma: float, floor: float = 0.1, lines: int = 8, out: str = "smooth"
) -> DataFrame:
    """Gaussian blur that ignores nodata: blur(v*m)/blur(m) where blur(m) exceeds ``floor``.

    Separable: bundles of raster rows, then bundles of raster columns, each one small dense matrix with
    mirrored ends. Two exchanges whatever the kernel's width; task memory is ``lines`` times the grid's
    side. Cells bleed past the valid area; join the result back to the input to re-mask it.
    """
    cells = df.where(F.col(value).isNotNull()).select(
        "row", "col", F.col(value).cast("double").alias("num"), F.lit(1.0).alias("den")
    )
    first = cells.groupBy(F.floor(F.col("row") / lines)).applyInPandas(
        _blur_lines("row", "col", grid.ncols, sigma, False), "row int, col int, num double, den double"
    )
    second = first.groupBy(F.floor(F.col("col") / lines)).applyInPandas(
        _blur_lines("col", "row", grid.nrows, sigma, False), "col int, row int, num double, den double"
    )
    return second.where(F.col("den") > floor).select("row", "col", (F.col("num") / F.col("den")).alias(out))


# --- contours -----------------------------------------------------------------------------------


def contour_levels(top: float, minor: int = 5, major: int = 10) -> list[int]:
    """Sorted union of the minor and major levels below ``top`` rounded up to a major level."""
    end = math.ceil(top / major) * major
    return sorted(set(range(minor, end, minor)) | set(range(major, end, major)))


# Which sides of a quad a level joins, by corner code (north-west 1, north-east 2, south-east 4,
# south-west 8); sides are numbered top, right, bottom, left. Entry 16 is a saddle cut the other way.
_SIDES = [
    [(0, 0)], [(3, 0)], [(0, 1)], [(3, 1)], [(1, 2)], [(3, 0), (1, 2)], [(0, 2)], [(2, 3)],
    [(2, 3)], [(0, 2)], [(3, 0), (1, 2)], [(1, 2)], [(3, 1)], [(0, 1)], [(3, 0)], [(0, 0)],
    [(0, 1), (2, 3)],
]


def crossed_quads(df: DataFrame, value: str, minor: int = 5) -> DataFrame:
    """Marching squares over 2x2 quads of cell centres: (row, col, lev, code, pt, k) for each segment.

    Levels are the multiples of ``minor`` that a quad spans, so no level list is needed. A quad with a
    missing corner has no segment; a saddle is split by the mean of its corners. ``code`` has a bit for
    each corner above the level, clockwise from north-west; ``pt`` the crossings of the four sides and
    ``k`` the two sides that the segment joins.
    """
    c = Window.partitionBy("row").orderBy("col").rangeBetween(1, 1)
    r = Window.partitionBy("col").orderBy("row").rangeBetween(1, 1)
    q = df.where(F.col(value).isNotNull()).select("row", "col", F.col(value).alias("a"))
    q = q.withColumn("b", F.max("a").over(c))
    q = q.withColumn("d", F.max("a").over(r)).withColumn("e", F.max("b").over(r))
    q = q.where("b is not null and d is not null and e is not null")
    lo, hi = F.least("a", "b", "d", "e"), F.greatest("a", "b", "d", "e")
    first = F.greatest(F.lit(1).cast("long"), F.floor(lo / minor) + 1)
    last = F.floor(hi / minor)
    q = q.where(first <= last).withColumn("lev", F.explode(F.sequence(first, last))).withColumn("lev", F.col("lev") * minor)
    # A corner on the level counts as above, so neighbouring quads agree.
    q = q.withColumn(
        "code",
        F.expr("CAST(a >= lev AS INT) + 2 * CAST(b >= lev AS INT) + 4 * CAST(e >= lev AS INT) + 8 * CAST(d >= lev AS INT)"),
    ).where("code NOT IN (0, 15)")
    # Crossing points on the top, right, bottom and left side of the quad.
    sides = F.expr(
        "array(struct(col + try_divide(lev - a, b - a) AS x, CAST(row AS DOUBLE) AS y), "
        "struct(col + 1D AS x, row + try_divide(lev - b, e - b) AS y), "
        "struct(col + try_divide(lev - d, e - d) AS x, row + 1D AS y), "
        "struct(CAST(col AS DOUBLE) AS x, row + try_divide(lev - a, d - a) AS y))"
    )
    pairs = ", ".join("array(" + ", ".join(f"struct({i} AS i, {j} AS j)" for i, j in p) + ")" for p in _SIDES)
    case = "CASE WHEN code IN (5, 10) AND (code = 5) = ((a + b + d + e) / 4 >= lev) THEN 16 ELSE code END"
    return q.select("row", "col", "lev", "code", sides.alias("pt"), F.expr(f"explode(array({pairs})[{case}]) AS k"))


def contour_segments(df: DataFrame, grid: Grid, value: str, minor: int = 5, major: int = 10) -> DataFrame:
    """Contours as loose segments, one row each; :func:`soundlake.operators.lines.contour_lines` joins them."""
    s = crossed_quads(df, value, minor).selectExpr("row", "col", "lev", "named_struct('p', pt[k.i], 'q', pt[k.j]) AS s")

    def gx(f: str) -> Column:
        return grid.left + (F.col(f) + 0.5) * grid.res

    def gy(f: str) -> Column:
        return grid.top - (F.col(f) + 0.5) * grid.res

    return s.select(
        "row",
        "col",
        F.col("lev").alias("depth_m"),
        F.when(F.col("lev") % major == 0, "major").otherwise("minor").alias("kind"),
        gx("s.p.x").alias("x1"),
        gy("s.p.y").alias("y1"),
        gx("s.q.x").alias("x2"),
        gy("s.q.y").alias("y2"),
    )


# --- lookups and layer algebra --------------------------------------------------------------------


def lookup(points: DataFrame, layer: DataFrame, grid: Grid, x: str, y: str, values: list[str]) -> DataFrame:
    """Layer values under each point (NULL off the grid or on nodata)."""
    return grid.locate(points, x, y).join(layer.select("row", "col", *values), ["row", "col"], "left")


def masked(df: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells that exist in the mask layer."""
    return df.join(mask.select("row", "col"), ["row", "col"], "left_semi")


def residual(a: DataFrame, b: DataFrame, va: str, vb: str, out: str = "residual") -> DataFrame:
    """a - b where both have a value."""
    j = a.select("row", "col", va).join(b.select("row", "col", vb), ["row", "col"])
    return j.withColumn(out, F.col(va) - F.col(vb)).where(F.col(out).isNotNull())


def hybrid(measured: DataFrame, modelled: DataFrame, value: str) -> DataFrame:
    """Measured value first, modelled second, with ``source`` 1, 0 or NULL."""
    m = measured.select("row", "col", F.col(value).alias("_m"))
    d = modelled.select("row", "col", F.col(value).alias("_d"))
    j = m.join(d, ["row", "col"], "full")
    src = F.when(F.col("_m").isNotNull(), 1).when(F.col("_d").isNotNull(), 0)
    return j.select("row", "col", F.coalesce("_m", "_d").alias(value), src.alias("source"))


def holes(mask: DataFrame, layer: DataFrame) -> DataFrame:
    """Cells valid in the mask that have no value in the layer."""
    return mask.select("row", "col").join(layer.select("row", "col"), ["row", "col"], "left_anti")


def fill_holes(
    layer: DataFrame, mask: DataFrame, value: str, label: str, res: float, k: int = 4, radius: float = 1.5
) -> DataFrame:
    """Fill masked holes by IDW of the k nearest cells; labels from the nearest within 1.5 radii.

    Works in cell units. Filled cells keep confidence 0 (``filled`` is TRUE).
    """
    r = radius / res
    known = masked(layer.where(F.col(value).isNotNull()), mask)
    pts = known.select(
        F.col("row").alias("prow"), F.col("col").alias("pcol"), F.col("col").cast("double").alias("px"),
        F.col("row").cast("double").alias("py"), value, label,
    )
    q = holes(mask, known).select(
        "row", "col", F.col("col").cast("double").alias("qx"), F.col("row").cast("double").alias("qy")
    )
    leaf = max(1.0, r / 4)
    got = idw(q, pts, ["row", "col"], ["prow", "pcol"], value, k, r, leaf).select("row", "col", value)
    lab = nearest(q, pts, ["row", "col"], ["prow", "pcol"], 1, r * 1.5, leaf).select("row", "col", label)
    filled = lab.join(got, ["row", "col"], "full").select("row", "col", value, label, F.lit(True).alias("filled"))
    return known.select("row", "col", value, label, F.lit(False).alias("filled")).unionByName(filled)


def resample_nearest(layer: DataFrame, src: Grid, dst: Grid, value: str) -> DataFrame:
    """Nearest source cell at every destination centre (same projection)."""
    c = dst.centres(dst.cells(layer.sparkSession))
    c = c.withColumnsRenamed({"row": "drow", "col": "dcol"})
    s = src.locate(c, "x", "y").join(layer.select("row", "col", value), ["row", "col"])
    return s.where(F.col(value).isNotNull()).select(F.col("drow").alias("row"), F.col("dcol").alias("col"), value)


def resample_bilinear(layer: DataFrame, src: Grid, dst: Grid, value: str) -> DataFrame:
    """Four-neighbour weights at every destination centre, renormalised over valid neighbours."""
    c = dst.centres(dst.cells(layer.sparkSession))
    u = (F.col("x") - src.left) / src.res - 0.5
    v = (src.top - F.col("y")) / src.res - 0.5
    c = c.withColumn("u", u).withColumn("v", v).withColumn("c0", F.floor("u")).withColumn("r0", F.floor("v"))
    fu, fv = F.col("u") - F.col("c0"), F.col("v") - F.col("r0")
    parts = F.array(
        *[
            F.struct(
                (F.col("r0") + a).cast("int").alias("r"),
                (F.col("c0") + b).cast("int").alias("c"),
                ((fv if a else 1 - fv) * (fu if b else 1 - fu)).alias("w"),
            )
            for a in (0, 1)
            for b in (0, 1)
        ]
    )
    inside = F.col("x").between(src.left, src.left + src.ncols * src.res) & F.col("y").between(
        src.top - src.nrows * src.res, src.top
    )
    e = c.where(inside).withColumn("p", F.explode(parts)).where("p.w > 0")
    e = e.select(
        F.col("row").alias("drow"), F.col("col").alias("dcol"), F.col("p.r").alias("row"), F.col("p.c").alias("col"),
        F.col("p.w").alias("w"),
    )
    j = e.join(layer.where(F.col(value).isNotNull()).select("row", "col", value), ["row", "col"])
    return j.groupBy(F.col("drow").alias("row"), F.col("dcol").alias("col")).agg(
        (F.sum(F.col("w") * F.col(value)) / F.sum("w")).alias(value)
    )


def points_to_grid(df: DataFrame, res: float) -> DataFrame:
    """Gridded soundings: x, y rounded to mm, |z|, averaged per cell with the number of points.

    The smallest x and the largest y are the raster's corner.
    """
    d = df.select(F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.abs("z").alias("z"))
    corner = d.agg(F.min("x").alias("x0"), F.max("y").alias("y0"))
    from soundlake.operators.stats import attach

    return (
        attach(d, corner, [])
        .groupBy(
            F.round((F.col("y0") - F.col("y")) / res).cast("int").alias("row"),
            F.round((F.col("x") - F.col("x0")) / res).cast("int").alias("col"),
        )
        .agg(F.avg("z").alias("z"), F.count(F.lit(1)).alias("n"))
    )


def label_median(df: DataFrame, label: str = "label") -> DataFrame:
    """3x3 median of labels over (row, bin); cells beyond the image count as 0, unlabelled as -1.

    Unlabelled cells stay unlabelled. Input is dense within the image (NULL is unlabelled).
    """
    lab = df.withColumn("_l", F.coalesce(F.col(label), F.lit(-1)))
    # Three bins of a row side by side; each such strip then votes in three rows. No window spans all rows.
    side = Window.partitionBy("row").orderBy("bin").rangeBetween(-1, 1)
    strips = lab.select("row", "bin", F.collect_list("_l").over(side).alias("_three")).withColumn("_d", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    votes = strips.groupBy((F.col("row") + F.col("_d")).alias("row"), "bin").agg(F.flatten(F.collect_list("_three")).alias("_w"))
    padded = F.array_sort(F.concat("_w", F.array_repeat(F.lit(0), 9 - F.size("_w"))))
    out = lab.where("_l >= 0").join(votes, ["row", "bin"])
    return out.withColumn("smoothed", F.get(padded, F.lit(4))).drop("_l", "_w")


def write_layer(df: DataFrame, layer: str, path: str, tile_rows: int = 256, mode: str = "append") -> None:
    """Cells as Parquet, partitioned by layer and by parts of a space-filling curve; NULL instead of a sentinel.

    Boxes of a layer are read with :func:`soundlake.operators.cube.within`.
    """
    from soundlake.operators.cube import on_curve

    tiled = on_curve(df.withColumn("tile_row", F.floor(F.col("row") / tile_rows).cast("int")))
    tiled.withColumn("layer", F.lit(layer)).write.mode(mode).partitionBy("layer", "curve").parquet(path)


def read_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Cells of one layer; only its partition is scanned."""
    return spark.read.parquet(path).where(F.col("layer") == layer)


def with_sentinel(value: Column, dtype: str) -> Column:
    """NULL to the on-disk nodata of a type."""
    return F.coalesce(value, F.lit({"float32": -9999.0, "uint8": 255, "int8": -1}[dtype]))
