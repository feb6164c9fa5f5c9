"""Contour lines: loose segments joined into ordered lines and rings.

Every crossing of a level with a grid edge has a key, and each segment runs from one crossing to another with the higher side on its right,
so a line is a linked list. Tiles first join the segments inside them, one task per tile and level; only the chains of tiles meet, by
pointer jumping in rounds that grow with the logarithm of the tiles a line passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundlake.functions.geo import unproject
from soundlake.operators.cube import line_geojson
from soundlake.operators.lineage import cut, release
from soundlake.operators.raster import Grid, crossed_quads

#: Side of a tile in cells; points of one feature, beyond which a line continues in another.
TILE, PART = 256, 100_000


def directed_segments(df: DataFrame, grid: Grid, value: str, minor: int = 5) -> DataFrame:
    """(lev, tile, a, b, ax, ay, bx, by): crossings ``a`` and ``b`` by key, in grid units, higher ground on the right.

    A key orders crossings by the row and column of their edge, edges along the row first.
    """
    s = crossed_quads(df, value, minor)
    # Clockwise round the quad a segment leaves where the ground falls below the level and comes in where it rises.
    falls = F.expr("(shiftright(code, k.i) & 1) > (shiftright(code, (k.i + 1) % 4) & 1)")
    s = s.withColumn("i", F.when(falls, F.col("k.i")).otherwise(F.col("k.j"))).withColumn("j", F.when(falls, F.col("k.j")).otherwise(F.col("k.i")))

    def key(side: str) -> Column:
        return F.expr(f"((row + CAST({side} = 2 AS BIGINT)) * {grid.ncols + 1} + col + CAST({side} = 1 AS BIGINT)) * 2 + CAST({side} IN (1, 3) AS BIGINT)")

    tile = F.floor(F.col("row") / TILE) * (grid.ncols // TILE + 1) + F.floor(F.col("col") / TILE)
    return s.select("lev", tile.alias("tile"), key("i").alias("a"), key("j").alias("b"), *[F.expr(f"pt[{e}].{c}").alias(f"{p}{c}") for p, e in (("a", "i"), ("b", "j")) for c in "xy"])


def ranks(before: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first element, steps from there, on a ring) in linked lists; ``before`` has each element's predecessor or -1.

    A ring starts at its element of the smallest ``low``.
    """
    n = len(before)
    own = np.arange(n)

    def jump(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        steps, least = (first != own).astype(np.int64), low.copy()
        for _ in range(n.bit_length()):
            least = np.minimum(least, least[first])
            steps, first = steps + steps[first], first[first]
        return first, steps, least

    start = np.where(before < 0, own, before)
    first, steps, least = jump(start)
    ring = steps[first] > 0
    if ring.any():
        first, steps, _ = jump(np.where(ring & (low == least), own, start))
    return first, steps, ring


def _chains(segments: pa.Table, ncols: int) -> pa.Table:
    """Segments of one level and tile as chains: the first and last crossing, the number of segments, the smallest crossing that one starts at, its place, and all points in order."""
    a, b, at, bt = (segments[c].to_numpy() for c in ("a", "b", "at", "bt"))
    by = np.argsort(b)
    prior = by[np.minimum(np.searchsorted(b[by], a), len(b) - 1)]
    first, place, _ = ranks(np.where(b[prior] == a, prior, -1), a)
    order = np.lexsort((place, a[first]))
    chain, a, b, at, bt = a[first][order], a[order], b[order], at[order], bt[order]
    start = np.flatnonzero(np.append(True, chain[1:] != chain[:-1]))
    size = np.diff(np.append(start, len(chain)))
    last = start + size - 1
    low = np.minimum.reduceat(a, start)
    is_low = np.flatnonzero(a == np.repeat(low, size))
    # All first crossings of a chain's segments, then the last one's second.
    key, along = np.insert(a, last + 1, b[last]), np.insert(at, last + 1, bt[last])
    upright, cell = (key & 1).astype(bool), key >> 1
    x, y = np.where(upright, cell % (ncols + 1), along), np.where(upright, along, cell // (ncols + 1))
    ends = np.append(0, np.cumsum(size + 1)).astype(np.int32)
    xs, ys = (pa.ListArray.from_arrays(ends, pa.array(v, pa.float64())) for v in (x, y))
    lev = np.full(len(start), segments["lev"][0].as_py(), np.int64)
    return pa.table({"lev": lev, "id": chain[start], "to": b[last], "n": size, "low": low, "low_place": is_low - start, "xs": xs, "ys": ys})


def _jump(state: DataFrame) -> DataFrame:
    """One doubling of (lev, id, first, steps, own_low, low): first leads twice as far back, over steps segments, low is the smallest seen."""
    there = state.select("lev", F.col("id").alias("first"), F.col("first").alias("_first"), F.col("steps").alias("_steps"), F.col("low").alias("_low"))
    return state.join(there, ["lev", "first"]).select("lev", "id", F.col("_first").alias("first"), (F.col("steps") + F.col("_steps")).alias("steps"), "own_low", F.least("low", "_low").alias("low"))


def _open(state: DataFrame) -> int:
    """Chains that do not lead to a first one yet."""
    ends = state.where("steps = 0").select("lev", "first")
    return state.join(ends, ["lev", "first"], "left_anti").count()


def _ranked(state: DataFrame) -> DataFrame:
    """All chains of ``state`` led to their first one; those of rings lead round them, with the ring's smallest low. Rounds: the logarithm of the chains in a line."""
    state, reach, left = cut(state, "jump"), 1, None
    while True:
        now = _open(state)
        if not now or (now == left and reach >= now):
            return state
        new = cut(_jump(state), "jump")
        release(state)
        state, reach, left = new, reach * 2, now


def contour_lines(df: DataFrame, grid: Grid, value: str, minor: int = 5, major: int = 10) -> DataFrame:
    """(depth_m, kind, line, ord, n, closed, x, y): the points of every contour line in order, in projected metres.

    ``line`` is the key of its first crossing, ``n`` the number of its points. A closed line starts at its smallest crossing and ends where it
    starts; an open one runs from the edge of the data with the higher side on its right. Points that fall on one corner of the grid stay apart.
    """
    # A key tells its edge, and so one coordinate; the place along the edge is the other.
    segments = directed_segments(df, grid, value, minor).selectExpr("lev", "tile", "a", "b", "IF(a % 2 = 1, ay, ax) AS at", "IF(b % 2 = 1, by, bx) AS bt")
    ncols = grid.ncols
    kinds = "lev long, id long, to long, n long, low long, low_place long, xs array<double>, ys array<double>"
    pieces = cut(segments.groupBy("lev", "tile").applyInArrow(lambda t: _chains(t, ncols), kinds), "chains")
    # A chain that ends at its own start is a ring within a tile, whole and in order already; only the others meet.
    alone, parts = pieces.where("to = id"), pieces.where("to <> id")
    chains = parts.select("lev", "id", "to", "n", "low", "low_place")
    before = chains.select("lev", F.col("to").alias("id"), F.col("id").alias("first"), F.col("n").alias("steps"))
    state = chains.select("lev", "id", "low").join(before, ["lev", "id"], "left")
    links = cut(state.select("lev", "id", F.coalesce("first", "id").alias("first"), F.coalesce("steps", F.lit(0)).cast("long").alias("steps"), F.col("low").alias("own_low"), "low"), "links")
    found = _ranked(links)
    ends = found.where("steps = 0").select("lev", "first")
    straight = found.join(ends, ["lev", "first"], "left_semi")
    rings = found.join(ends, ["lev", "first"], "left_anti").select("lev", "id", (F.col("own_low") == F.col("low")).alias("starts"))
    rings = links.drop("low").join(rings, ["lev", "id"])
    rings = rings.select("lev", "id", F.when(F.col("starts"), F.col("id")).otherwise(F.col("first")).alias("first"), F.when(F.col("starts"), F.lit(0)).otherwise(F.col("steps")).cast("long").alias("steps"),
                         "own_low", F.col("own_low").alias("low"))
    turned = _ranked(rings)
    shape = ["lev", "id", "first", "steps"]
    ordered = straight.select(*shape, F.lit(False).alias("closed")).unionByName(turned.select(*shape, F.lit(True).alias("closed")))
    ordered = chains.join(ordered, ["lev", "id"])
    head = F.col("id") == F.col("first")
    whole = ordered.groupBy("lev", "first").agg(F.sum("n").alias("size"), F.max(F.when(head, F.col("low"))).alias("low"), F.max(F.when(head, F.col("low_place"))).alias("turn"))
    ordered = ordered.select("lev", "id", "first", "steps", "closed").join(whole, ["lev", "first"])
    ordered = cut(ordered.select("lev", "id", "steps", "closed", "size", F.when(F.col("closed"), F.col("low")).otherwise(F.col("first")).alias("line"),
                                 F.when(F.col("closed"), F.col("turn")).otherwise(F.lit(0)).alias("turn")), "lines")
    release(found, turned, links)
    shape = ["lev", "n", "xs", "ys", "steps", "closed", "size", "line", "turn"]
    whole = alone.select("lev", "n", "xs", "ys", F.lit(0).cast("long").alias("steps"), F.lit(True).alias("closed"), F.col("n").alias("size"), F.col("low").alias("line"), F.col("low_place").alias("turn"))
    s = parts.join(ordered, ["lev", "id"]).select(*shape).unionByName(whole)
    n = F.col("n").cast("int")
    pairs = F.arrays_zip(*[F.slice(f"{c}s", F.lit(o), n).alias(f"{p}{c}") for p, o in (("a", 1), ("b", 2)) for c in "xy"])
    s = s.select("lev", "steps", "closed", "size", "line", "turn", F.posexplode(pairs).alias("place", "s"))
    place = F.pmod(F.col("steps") + F.col("place") - F.col("turn"), F.col("size"))
    s = s.select("lev", "line", "closed", "size", place.alias("ord"), "s.*")
    point = lambda p, o: F.struct(o.alias("ord"), F.col(f"{p}x").alias("px"), F.col(f"{p}y").alias("py"))
    both = F.when(F.col("ord") == F.col("size") - 1, F.array(point("a", F.col("ord")), point("b", F.col("size")))).otherwise(F.array(point("a", F.col("ord"))))
    s = s.select("lev", "line", "size", "closed", F.explode(both).alias("p"))
    return s.select(
        F.col("lev").alias("depth_m"),
        F.when(F.col("lev") % major == 0, "major").otherwise("minor").alias("kind"),
        "line",
        F.col("p.ord").alias("ord"),
        (F.col("size") + 1).alias("n"),
        "closed",
        (grid.left + (F.col("p.px") + 0.5) * grid.res).alias("x"),
        (grid.top - (F.col("p.py") + 0.5) * grid.res).alias("y"),
    )


def contour_features(points: DataFrame, digits: int = 7) -> DataFrame:
    """One LineString in lon/lat per line of :func:`contour_lines`: depth_m, kind, line, part, closed, n, feature.

    A line of more than ``PART`` segments becomes consecutive features that share the point between them, so that no row grows without bound.
    """
    lon, lat = unproject(F.col("x"), F.col("y"))
    tidy = lambda v: F.round(v + 1.23 * 10.0 ** -(digits + 3), digits)  # noqa: E731  off the ties of exact decimals
    p = points.select("depth_m", "kind", "line", "closed", "ord", tidy(lon).alias("lon"), tidy(lat).alias("lat"), F.floor(F.col("ord") / PART).alias("part"), "n")
    shared = (F.col("ord") % PART == 0) & (F.col("ord") > 0)
    last = F.col("ord") == F.col("n") - 1
    parts = F.when(shared & last, F.array(F.col("part") - 1)).when(shared, F.array(F.col("part") - 1, F.col("part"))).otherwise(F.array("part"))
    p = p.withColumn("part", F.explode(parts))
    g = p.groupBy("depth_m", "kind", "line", "closed", "part").agg(F.array_sort(F.collect_list(F.struct("ord", "lon", "lat"))).alias("coords"))
    properties = F.struct(F.col("depth_m").cast("double").alias("depth_m"), F.col("kind").alias("level"))
    return g.select("depth_m", "kind", "line", "part", "closed", F.size("coords").cast("long").alias("n"), line_geojson(F.col("coords"), properties).alias("feature"))
