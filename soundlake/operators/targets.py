"""Target picking on a signed raster and greedy thinning of the picks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundlake.operators.lineage import cut, release


#: Small tiles along a side of a task's tile, and of the rim that it also sees; strongest points of a small tile that take part in a round.
SPAN, HALO, MOST = 24, 8, 8


def _resolve(ident: list[str], side: float, radius: float):
    """Points of one tile that surely survive. A point is settled once all stronger points within the radius are; what lies beyond the rim is not known."""

    def run(points: pa.Table) -> pa.Table:
        order = [("_abs", "descending"), *[(c, "ascending") for c in ident]]
        t = points.sort_by(order)
        x, y, cx, cy, full, fixed, core, edge = (t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("_x", "_y", "_cx", "_cy", "_full", "_fixed", "_core", "_edge"))
        n = len(x)
        # Pairs within reach, by small tiles five by five; rows are sorted, so the lower index is the stronger point.
        wide = int(cx.max() - cx.min()) + 5
        cell = (cy - cy.min() + 2) * wide + cx - cx.min() + 2
        by = np.argsort(cell, kind="stable")
        strong, weak = [], []
        safe = ~edge
        for dy in range(-2, 3):
            for dx in range(-2, 3):
                near = cell + dy * wide + dx
                a, b = np.searchsorted(cell[by], near, "left"), np.searchsorted(cell[by], near, "right")
                i = np.repeat(np.arange(n), b - a)
                j = by[np.arange(len(i)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)]
                hit = (j < i) & ((x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 < radius * radius)
                strong.append(j[hit])
                weak.append(i[hit])
                # A small tile that sent only its strongest may hold others stronger than this point.
                some = b > a
                last = by[np.where(some, b - 1, 0)]
                safe &= ~(some & full[last] & (last < np.arange(n)))
        strong, weak = np.concatenate(strong), np.concatenate(weak)
        kept, gone = fixed.copy(), np.zeros(n, bool)
        while True:
            gone |= (np.bincount(weak, kept[strong], n) > 0) & ~fixed
            new = safe & ~gone & ~kept & (np.bincount(weak, ~gone[strong], n) == 0)
            if not new.any():
                break
            kept |= new
        return t.filter(pa.array(kept & core & ~fixed)).select([*ident, "_x", "_y", "_cx", "_cy", "_abs"])

    return run


def greedy_thin(df: DataFrame, ident: list[str], x: str, y: str, value: str, radius: float) -> DataFrame:
    """Strongest-first selection: a point survives unless a stronger survivor is closer than ``radius``.

    The sequential answer in rounds over tiles with a rim. A task settles every point whose chain of stronger neighbours ends inside its tile and rim;
    only open chains wait for the next round, in which their stronger ends are settled. Small tiles have the diagonal ``radius``, so at most one of their
    points survives; the strongest ``MOST`` of each take part in a round, which bounds a task, and who is close to a survivor drops out by an equi join.
    The strongest open point always survives a round. Scattered strengths take two or three rounds; a monotone ramp takes one per ``SPAN`` small
    tiles of its length, since each survivor of a ramp depends on the one before.
    """
    side = radius / 2**0.5
    points = df.withColumns({"_x": F.col(x).cast("double"), "_y": F.col(y).cast("double"), "_abs": F.abs(value)})
    points = points.where("_x is not null and _y is not null and _abs is not null")
    points = cut(points.withColumns({"_cx": F.floor(F.col("_x") / side), "_cy": F.floor(F.col("_y") / side)}), "points")
    columns = [*ident, "_x", "_y", "_cx", "_cy", "_abs"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.select(*columns).schema)
    live, kept, old = points.select(*columns), None, None
    around = "array(" + ", ".join(f"struct({a} AS a, {b} AS b)" for a in range(-2, 3) for b in range(-2, 3)) + ")"
    tile = lambda c, off: f"floor(({c} + {off}) / {SPAN})"
    reached = f"array_distinct(transform(array({-HALO}, 0, {HALO}), o -> floor(({{0}} + o) / {SPAN})))"
    inside = " OR ".join(f"{c} - {t} * {SPAN} < {2 - HALO} OR {c} - {t} * {SPAN} >= {SPAN + HALO - 2}" for c, t in (("_cx", "_tx"), ("_cy", "_ty")))
    while not live.isEmpty():
        of = Window.partitionBy("_cx", "_cy")
        top = live.withColumn("_i", F.row_number().over(of.orderBy(F.desc("_abs"), *ident))).withColumn("_n", F.count(F.lit(1)).over(of))
        top = top.where(F.col("_i") <= MOST).select(*columns, (F.col("_n") > MOST).alias("_full"), F.lit(False).alias("_fixed"))
        if kept is not None:
            top = top.unionByName(kept.select(*columns, F.lit(False).alias("_full"), F.lit(True).alias("_fixed")))
        dealt = top.selectExpr("*", f"explode({reached.format('_cx')}) AS _tx").selectExpr("*", f"explode({reached.format('_cy')}) AS _ty")
        dealt = dealt.selectExpr("*", f"_tx = {tile('_cx', 0)} AND _ty = {tile('_cy', 0)} AS _core", f"({inside}) AS _edge")
        open_tiles = live.selectExpr(f"{tile('_cx', 0)} AS _tx", f"{tile('_cy', 0)} AS _ty").distinct()
        won = cut(dealt.join(open_tiles, ["_tx", "_ty"], "left_semi").groupBy("_tx", "_ty").applyInArrow(_resolve(ident, side, radius), kinds), "won")
        kept = won if kept is None else kept.unionByName(won)
        shade = won.selectExpr("_x AS _wx", "_y AS _wy", "_cx", "_cy", f"explode({around}) AS _d").selectExpr("_wx", "_wy", "_cx + _d.a AS _sx", "_cy + _d.b AS _sy")
        dx, dy = F.col("_x") - F.col("_wx"), F.col("_y") - F.col("_wy")
        same = (F.col("_cx") == F.col("_sx")) & (F.col("_cy") == F.col("_sy"))
        live = cut(live.join(shade, same & (dx * dx + dy * dy < radius * radius), "left_anti"), "open")
        if old is not None:
            release(old)
        old = live
    if kept is None:
        return df.limit(0)
    return points.join(kept.select(*ident), ident, "left_semi").select(*df.columns)


def rank_targets(df: DataFrame, value: str, tie: list[str]) -> DataFrame:
    """Ids T001... by strength, with polarity. Runs on the thinned list.

    Numbers come from counts per strength band, so no window covers the whole list.
    """
    band = F.floor(F.log2(F.greatest(F.abs(value), F.lit(1e-300))) * 64)
    d = df.withColumn("_b", band)
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_k"))
    above = Window.partitionBy(F.lit(0)).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_b", F.coalesce(F.sum("_k").over(above), F.lit(0)).alias("_base"))
    w = Window.partitionBy("_b").orderBy(F.abs(value).desc(), *tie)
    n = F.col("_base") + F.row_number().over(w)
    return (
        d.join(F.broadcast(base), "_b")
        .withColumn("rank", n)
        .withColumn("target_id", F.format_string("T%03d", F.col("rank")))
        .withColumn("polarity", F.when(F.col(value) > 0, "+").otherwise("-"))
        .drop("_b", "_base")
    )
