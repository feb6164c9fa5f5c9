"""Nearest neighbours by a dual tree of nested tiles.

Queries and points are counted on the same nested tiles, each a quarter of the one above. Tiles of queries descend, not queries: the counts of
point tiles bound the k-th distance of every query in a tile, point tiles beyond the bound are dropped, and both sides split into their
occupied children. Where points crowd, the tiles in reach split on. In the end the queries of a tile meet the points of its few tiles in one
block, and only there distances are taken, so pairs are never formed for a whole group and a dense cluster costs no more than its rim.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundlake.operators.lineage import cut, release

SPLIT = 4
#: A query tile with more points in reach than this many times k (and than this) is crowded and splits on; levels below the aimed size at most.
CROWD, CROWD_LEAST, EXTRA = 256, 8192, 12
#: Queries of a tile aimed at, and most of one block; distances taken at once within it.
SOME, BLOCK, AT_ONCE = 256, 8192, 1 << 19
#: Points of a tile aimed at, at most; queries that are not split within a block any more.
FEW, FEWEST = 128, 32


def _there(x: str, y: str) -> Column:
    """Whether a row has a position."""
    return F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))


def _finest(d: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return d.withColumn("_tx", F.floor(F.col(x) / size).cast("long")).withColumn("_ty", F.floor(F.col(y) / size).cast("long"))


def _up(d: DataFrame, levels: int, tx: str = "_tx", ty: str = "_ty") -> DataFrame:
    """Tiles so many levels up: exact integer divisions, whatever the rounding of the finest ones."""
    f = SPLIT**levels
    return d if f == 1 else d.withColumns({c: F.floor(F.col(c) / f) for c in (tx, ty)})


def _reach(pairs: DataFrame, level: int, size: float, k: int, radius2: float | None) -> DataFrame:
    """Pairs of a query tile and a point tile of ``level`` that may hold one of the ``k`` nearest points of a query.

    Adds all points in reach (``_all``) and those no further than the query tile is wide (``_close``). Distances are taken in sides of point tiles, so tile
    borders are whole numbers. A point tile goes if nearer tiles with ``k`` points are nearer to the whole query tile; or if some tiles with ``k`` points are
    nearer to its four corners: the difference of two squared distances is linear in the query, so what holds at the corners holds inside. The second bound
    does not loosen with the query tile's width, so large tiles of far queries keep a thin rim of points only.
    """
    of = Window.partitionBy("_ql", "_qtx", "_qty")
    wide = F.pow(F.lit(float(SPLIT)), F.lit(level) - F.col("_ql"))
    lo = {a: F.col(f"_qt{a}") * wide for a in "xy"}
    hi = {a: (F.col(f"_qt{a}") + 1) * wide for a in "xy"}
    t = {a: F.col(f"_t{a}").cast("double") for a in "xy"}
    square = lambda f: f("x") * f("x") + f("y") * f("y")
    d = pairs.withColumn("_near", square(lambda a: F.greatest(t[a] - hi[a], lo[a] - t[a] - 1, F.lit(0.0))))
    d = d.withColumn("_far", square(lambda a: F.greatest(t[a] + 1 - lo[a], hi[a] - t[a])))
    limit = F.lit(float("inf") if radius2 is None else radius2 / (size * size))
    d = d.where(F.col("_near") <= limit * (1 + 1e-9))
    d = d.withColumn("_upto", F.sum("_n").over(of.orderBy("_far").rowsBetween(Window.unboundedPreceding, 0)))
    anchor, enough = F.col("_upto") - F.col("_n") < k, F.max("_upto").over(of) >= k
    some = F.lit(False)
    for x in (lo["x"], hi["x"]):
        for y in (lo["y"], hi["y"]):
            near = square(lambda a: F.greatest(t[a] - (x if a == "x" else y), (x if a == "x" else y) - t[a] - 1, F.lit(0.0)))
            far = square(lambda a: F.greatest(F.abs(t[a] - (x if a == "x" else y)), F.abs(t[a] + 1 - (x if a == "x" else y))))
            some |= near <= F.max(F.when(anchor, far)).over(of) * (1 + 1e-9)
    lim = F.least(F.coalesce(F.min(F.when(F.col("_upto") >= k, F.col("_far"))).over(of), limit), limit)
    d = d.withColumn("_fine", (F.col("_near") <= lim * (1 + 1e-9)) & (~enough | some)).where("_fine")
    d = d.withColumn("_all", F.sum("_n").over(of)).withColumn("_close", F.sum(F.when(F.col("_near") < wide * wide, F.col("_n")).otherwise(0)).over(of))
    return d.select("_ql", "_qtx", "_qty", "_nq", "_tx", "_ty", "_n", "_all", "_close")


def _block(qid: list[str], pid: list[str], columns: list[str], k: int, radius2: float | None):
    """The ``k`` nearest points of every query in a block, ties to the lower ids."""

    def nearest_of(qx: np.ndarray, qy: np.ndarray, px: np.ndarray, py: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(query, point, squared distance, rank) of the ``k`` nearest of the points, which are sorted by id, in blocks of distances."""
        step = max(1, AT_ONCE // max(1, len(px)))
        for at in range(0, len(qx) if len(px) else 0, step):
            dx, dy = px[None, :] - qx[at : at + step, None], py[None, :] - qy[at : at + step, None]
            d2 = dx * dx + dy * dy
            fine = d2 <= np.partition(d2, k - 1, axis=1)[:, k - 1 : k] if k < len(px) else np.ones(d2.shape, bool)
            if radius2 is not None:
                fine &= d2 < radius2
            q, p = np.nonzero(fine)
            d = d2[q, p]
            order = np.lexsort((p, d, q))
            q, p, d = q[order], p[order], d[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q) + 1
            best = rank <= k
            yield q[best] + at, p[best], d[best], rank[best].astype(np.int32)

    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        points = points.sort_by([(c, "ascending") for c in pid])
        qx, qy, px, py = (t[c].to_numpy() for t, c in ((queries, "_qx"), (queries, "_qy"), (points, "_px"), (points, "_py")))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))]
        todo = [(np.arange(len(qx)), np.arange(len(px)))]
        while todo:
            q, p = todo.pop()
            if len(q) >= FEWEST and len(p) > 4 * k:
                # What k others beat at all four corners of the queries' box, they beat inside it.
                x, y, u, v = qx[q], qy[q], px[p], py[p]
                box = (x.min(), x.max()), (y.min(), y.max())
                d = (u - sum(box[0]) / 2) ** 2 + (v - sum(box[1]) / 2) ** 2
                best = np.argpartition(d, k - 1)[:k]
                keep = np.zeros(len(p), bool)
                for a in box[0]:
                    for b in box[1]:
                        d = (u - a) ** 2 + (v - b) ** 2
                        keep |= d <= d[best].max() * (1 + 1e-9)
                p = p[keep]
                if len(p) > 4 * k:
                    c = x if box[0][1] - box[0][0] >= box[1][1] - box[1][0] else y
                    order = np.argpartition(c, len(c) // 2)
                    todo += [(q[order[: len(c) // 2]], p), (q[order[len(c) // 2 :]], p)]
                    continue
            found += [(q[i], p[j], d, rank) for i, j, d, rank in nearest_of(qx[q], qy[q], px[p], py[p])]
        q, p, d, rank = (np.concatenate(x) for x in zip(*found, strict=True))
        left, right = queries.select(qid).take(pa.array(q)), points.select(columns).take(pa.array(p))
        return pa.table([*left.columns, *right.columns, pa.array(d), pa.array(rank)], names=[*qid, *columns, "d2", "rank"])

    return run


def nearest(
    queries: DataFrame,
    points: DataFrame,
    qid: list[str],
    pid: list[str],
    k: int,
    radius: float | None = None,
    leaf: float = 1.0,
    qxy: tuple[str, str] = ("qx", "qy"),
    pxy: tuple[str, str] = ("px", "py"),
) -> DataFrame:
    """The ``k`` nearest points of every query: its ids, all columns of the points, ``d2`` and ``rank``.

    ``radius`` is exclusive. Ties go to the lower ``pid``. The points' mean density sets the aimed tile side, ``leaf`` is the least one; where tiles in
    reach hold many points, smaller ones follow. Without a radius the hierarchy starts at the data's extent, so any distance is reachable.
    Rows without a position have no neighbours and are none.
    """
    (qx, qy), (px, py) = qxy, pxy
    # Of points at one position only the k lowest ids can ever be chosen.
    same = Window.partitionBy(px, py).orderBy(*pid)
    pts = points.where(_there(px, py)).withColumn("_s", F.row_number().over(same)).where(F.col("_s") <= k).drop("_s")
    columns = pts.columns
    pts = cut(pts.withColumn("_px", F.col(px).cast("double")).withColumn("_py", F.col(py).cast("double")), "points")
    q = cut(queries.where(_there(qx, qy)).select(*qid, F.col(qx).cast("double").alias("_qx"), F.col(qy).cast("double").alias("_qy")), "queries")

    box = [d.agg(F.min(x), F.max(x), F.min(y), F.max(y), F.count(F.lit(1))).first() for d, x, y in ((q, "_qx", "_qy"), (pts, "_px", "_py"))]
    if not box[0][4] or not box[1][4]:
        top = size = leaf
    else:
        extent = max(max(box[0][i + 1], box[1][i + 1]) - min(box[0][i], box[1][i]) for i in (0, 2))
        of = [max(b[1] - b[0], leaf) * max(b[3] - b[2], leaf) / b[4] for b in box]  # area for each query, for each point
        # Some points a tile, so that few are out of reach; queries enough for a block, unless that means too many points.
        size = max(leaf, math.sqrt(of[1] * k / 2), min(math.sqrt(of[0] * SOME), math.sqrt(of[1] * FEW)))
        top = max(radius or extent, leaf)
    depth = max(0, math.ceil(math.log(top / size, SPLIT) - 1e-9))
    top = size * SPLIT**depth  # at least the radius or the extent, so that the tiles next to a query's reach far enough
    last = depth + EXTRA
    sizes = [top / SPLIT**i for i in range(last + 1)]
    r2 = None if radius is None else radius * radius
    crowd = max(CROWD * k, CROWD_LEAST)

    def counts(d: DataFrame, x: str, y: str, n: str) -> DataFrame:
        """Tiles of the aimed level with the numbers of rows in them."""
        return cut(_up(_finest(d, x, y, sizes[-1]), last - depth).groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias(n)), "tiles")

    q_tiles, p_tiles = counts(q, "_qx", "_qy", "_nq"), counts(pts, "_px", "_py", "_n")

    up = lambda d, old: _up(d.withColumn(f"{old}x", F.col("_tx")).withColumn(f"{old}y", F.col("_ty")), 1, f"{old}x", f"{old}y")

    def coarse(d: DataFrame, i: int, n: str) -> DataFrame:
        return d if i == depth else _up(d, depth - i).groupBy("_tx", "_ty").agg(F.sum(n).alias(n))

    def children(parents: DataFrame, level: int, tiles: DataFrame, rows: DataFrame, x: str, y: str, n: str, old: str) -> DataFrame:
        """Occupied tiles of ``level`` with their parents as ``old``; below the aimed level only those of ``parents``, counted anew."""
        if level <= depth:
            return up(coarse(tiles, level, n), old)
        d = _up(_finest(rows, x, y, sizes[-1]), last - level).groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias(n))
        return up(d, old).join(parents, [f"{old}x", f"{old}y"], "left_semi")

    def split(full: DataFrame, level: int) -> DataFrame:
        """Pairs with the point tiles' occupied children, at ``level``; query tiles that hold too many queries or lie among too many points split as well."""
        full = full.withColumnsRenamed({"_tx": "_ox", "_ty": "_oy"}).drop("_n", "_all")
        crowded = (F.col("_nq") > BLOCK) | (F.col("_close") > crowd // 2)
        d = full.where(~crowded).drop("_close")
        for ql in sorted(r[0] for r in full.where(crowded).select("_ql").distinct().collect()):
            some = full.where(crowded & (F.col("_ql") == ql)).select(F.col("_qtx").alias("_qx"), F.col("_qty").alias("_qy"), "_ox", "_oy")
            down = children(some.select("_qx", "_qy").distinct(), ql + 1, q_tiles, q, "_qx", "_qy", "_nq", "_q").withColumnsRenamed({"_tx": "_qtx", "_ty": "_qty"})
            d = d.unionByName(some.join(down, ["_qx", "_qy"]).select(F.lit(ql + 1).alias("_ql"), "_qtx", "_qty", "_nq", "_ox", "_oy"))
        down = children(full.select("_ox", "_oy").distinct(), level, p_tiles, pts, "_px", "_py", "_n", "_o")
        return d.join(down, ["_ox", "_oy"]).drop("_ox", "_oy")

    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    pairs = coarse(q_tiles, 0, "_nq").select(F.lit(0).alias("_ql"), F.col("_tx").alias("_qtx"), F.col("_ty").alias("_qty"), "_nq", F.explode(steps).alias("_d"))
    pairs = pairs.withColumn("_tx", F.col("_qtx") + F.col("_d.a")).withColumn("_ty", F.col("_qty") + F.col("_d.b")).drop("_d").join(coarse(p_tiles, 0, "_n"), ["_tx", "_ty"])

    # Tiles with few points in reach are done, the others split on, level by level.
    done, level = [], 0
    state = cut(_reach(pairs, 0, sizes[0], k, r2), "reach")
    while level < last:
        full = state.where(F.col("_all") > crowd)
        if full.isEmpty():
            break
        done.append(state.where(F.col("_all") <= crowd).withColumn("_pl", F.lit(level)))
        level += 1
        state = cut(_reach(split(full, level), level, sizes[level], k, r2), "reach")
    done.append(state.withColumn("_pl", F.lit(level)))
    met = done[0]
    for d in done[1:]:
        met = met.unionByName(d)
    met = cut(met.drop("_n", "_all", "_close"), "met")
    release(q_tiles, p_tiles)

    key = ["_ql", "_qtx", "_qty", "_part"]
    parts = F.ceil(F.col("_nq") / BLOCK).cast("int")
    of = met.select("_ql", "_qtx", "_qty", "_nq").distinct()
    levels = met.select("_ql", "_pl").distinct().collect()
    left = right = None
    for i in sorted({r[0] for r in levels}) or [0]:
        a = _up(_finest(q, "_qx", "_qy", sizes[-1]), last - i).withColumnsRenamed({"_tx": "_qtx", "_ty": "_qty"}).join(of.where(F.col("_ql") == i), ["_qtx", "_qty"])
        a = a.select("_ql", "_qtx", "_qty", F.pmod(F.xxhash64(*qid), parts).cast("int").alias("_part"), *qid, "_qx", "_qy")
        left = a if left is None else left.unionByName(a)
    for i in sorted({r[1] for r in levels}) or [0]:
        b = met.where(F.col("_pl") == i).join(_up(_finest(pts, "_px", "_py", sizes[-1]), last - i), ["_tx", "_ty"])
        b = b.select("_ql", "_qtx", "_qty", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"), *columns, "_px", "_py")
        right = b if right is None else right.unionByName(b)
    fresh = lambda d: d.toDF(*d.columns)  # noqa: E731  queries and points may come from one table
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*(q.schema[c] for c in qid), *(pts.schema[c] for c in columns)])
    return fresh(left).groupBy(*key).cogroup(fresh(right).groupBy(*key)).applyInArrow(_block(qid, pid, columns, k, r2), schema + ", d2 double, rank int")


def idw(
    queries: DataFrame,
    points: DataFrame,
    qid: list[str],
    pid: list[str],
    value: str,
    k: int,
    radius: float | None = None,
    leaf: float = 1.0,
    eps: float = 1e-6,
    floor_distance: bool = False,
    **xy,
) -> DataFrame:
    """Inverse-square-distance mean of the k nearest points: (qid, value, nearest distance).

    Weights are 1/(d2 + eps), or 1/max(d, eps)^2 with ``floor_distance``.
    """
    return weighted(nearest(queries, points, qid, pid, k, radius, leaf, **xy), qid, value, eps, floor_distance).drop("d2")


def weighted(near: DataFrame, qid: list[str], value: str, eps: float = 1e-6, floor_distance: bool = False) -> DataFrame:
    """:func:`idw` of the points found by :func:`nearest`, and the smallest ``d2``."""
    w = 1 / F.greatest(F.col("d2"), F.lit(eps * eps)) if floor_distance else 1 / (F.col("d2") + eps)
    return (
        near.withColumn("_w", w)
        .groupBy(*qid)
        .agg(
            (F.sum(F.col("_w") * F.col(value)) / F.sum("_w")).alias(value),
            F.sqrt(F.min("d2")).alias("nearest"),
            F.min("d2").alias("d2"),
        )
    )


def around(queries: DataFrame, points: DataFrame, reach: float, qxy: tuple[str, str] = ("qx", "qy"), pxy: tuple[str, str] = ("px", "py")) -> DataFrame:
    """The queries next to a tile with a point, tiles being ``reach`` wide: all with a point within ``reach``, and few further than three times that."""
    side = reach * (1 + 1e-6)  # so that rounding parts no neighbours
    occupied = _finest(points.where(_there(*pxy)), *pxy, side).select("_tx", "_ty").distinct()
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    wide = occupied.withColumn("_d", F.explode(steps)).select((F.col("_tx") + F.col("_d.a")).alias("_tx"), (F.col("_ty") + F.col("_d.b")).alias("_ty")).distinct()
    return _finest(queries.where(_there(*qxy)), *qxy, side).join(wide, ["_tx", "_ty"], "left_semi").select(*queries.columns)


def confidence(nearest_distance: Column, res: float) -> Column:
    """0 where a point lies within one cell, 1 where the value is interpolated, NULL outside."""
    return F.when(nearest_distance <= res, 0).when(nearest_distance.isNotNull(), 1)
