"""Along-track operators that never put a whole line into one task.

A line may hold a third of all rows, so a window ``partitionBy(line)`` over the fact table is not
an option. Rows are cut into *stretches* (a monotone expression of the order columns, such as
ten-minute slots); each (line, stretch) is one window partition, and what crosses a stretch border
travels through a summary with one row per stretch, built with map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from soundlake.operators.lineage import cut

ST = "_stretch"


@dataclass(frozen=True)
class Track:
    """How rows run along a line.

    ``order`` must be a total order within a line; ``stretch`` must never decrease along it.
    """

    line: tuple[str, ...]
    order: tuple[str, ...]
    stretch: Column

    @property
    def key(self) -> list[str]:
        return [*self.line, ST]

    def cut(self, df: DataFrame) -> DataFrame:
        return df.withColumn(ST, self.stretch)

    def position(self) -> Column:
        return F.struct(*self.order)

    def within(self, backward: bool = False, also: tuple[str, ...] = ()):
        cols = [F.col(c).desc() if backward else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.key, *also).orderBy(*cols)

    def across(self, backward: bool = False):
        """Window over the stretch summary: everything in strictly earlier (or later) stretches."""
        o = F.col(ST).desc() if backward else F.col(ST).asc()
        return Window.partitionBy(*self.line).orderBy(o).rangeBetween(Window.unboundedPreceding, -1)


def every(seconds: float, t: str = "t") -> Column:
    """Stretches of a fixed duration: bounded by the instrument's rate as long as its clock runs."""
    return F.floor(F.col(t) / seconds)


def numbered(size: int = 65536, seq: str = "seq") -> Column:
    """Stretches of ``size`` record numbers: bounded whatever the clock says."""
    return F.floor(F.col(seq) / size)


def reach(
    df: DataFrame,
    track: Track,
    before: dict[str, tuple[Column, bool]] | None = None,
    after: dict[str, tuple[Column, bool]] | None = None,
    part: str | None = None,
) -> DataFrame:
    """Attach the last known value before, and the first known value after, every row.

    Each entry maps an output name to ``(value, strict)``; a NULL value is "unknown" and is skipped.
    Wrap a value in a struct to carry NULL fields along. ``strict`` leaves the row itself out. The
    forward look runs as a descending scan, because Spark evaluates an unbounded-following frame
    in quadratic time. ``part`` names a column that splits crowded stretches; rows with a known value
    must then be present in every part of their stretch.
    """
    before, after = before or {}, after or {}
    names, also = [*before, *after], (part,) if part else ()
    key = [*track.key, *also]
    rows = track.cut(df).select("*", *[v.alias(f"_v_{n}") for n, (v, _) in {**before, **after}.items()])
    pos = "struct(" + ", ".join(f"`{c}`" for c in track.order) + ")"
    edge = [
        F.expr(f"{fn}(_v_{n}, CASE WHEN _v_{n} IS NOT NULL THEN {pos} END) AS _c_{n}")
        for fn, side in (("max_by", before), ("min_by", after))
        for n in side
    ]
    summary = rows.groupBy(*key).agg(*edge)
    carried = summary.select(
        *key,
        *[F.last(f"_c_{n}", True).over(track.across(backward=n in after)).alias(f"_c_{n}") for n in names],
    )
    found = []
    for side, backward in ((before, False), (after, True)):
        w = track.within(backward, also)
        for n, (_, strict) in side.items():
            frame = w.rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
            found.append(F.coalesce(F.last(f"_v_{n}", True).over(frame), F.col(f"_c_{n}")).alias(n))
    return rows.join(carried, key).select(*df.columns, *found)


def ordinals(df: DataFrame, track: Track, name: str = "ord", total: str | None = None) -> DataFrame:
    """Exact 1-based position of every row in its line, and optionally the line's length."""
    rows = track.cut(df)
    counts = rows.groupBy(*track.key).agg(F.count(F.lit(1)).alias("_k"))
    extra = [F.sum("_k").over(Window.partitionBy(*track.line)).alias(total)] if total else []
    base = counts.select(
        *track.key, F.coalesce(F.sum("_k").over(track.across()), F.lit(0)).alias("_base"), *extra
    )
    out = rows.join(base, track.key).withColumn(name, F.col("_base") + F.row_number().over(track.within()))
    return out.select(*df.columns, name, *([total] if total else []))


def running_sum(df: DataFrame, track: Track, value: Column, name: str) -> DataFrame:
    """Inclusive running sum along the line."""
    rows = track.cut(df).withColumn("_x", value)
    sums = rows.groupBy(*track.key).agg(F.sum("_x").alias("_k"))
    base = sums.select(*track.key, F.coalesce(F.sum("_k").over(track.across()), F.lit(0.0)).alias("_base"))
    w = track.within().rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(base, track.key).withColumn(
        name, F.col("_base") + F.coalesce(F.sum("_x").over(w), F.lit(0.0))
    )
    return out.select(*df.columns, name)


# --- as-of joins ------------------------------------------------------------------------


def interpolate(
    queries: DataFrame,
    knowns: DataFrame,
    line: list[str],
    t: str,
    values: list[str],
    stretch: Column,
    outside: str | dict[str, str] = "null",
    min_knowns: int = 2,
    crowd: int = 1_000_000,
) -> DataFrame:
    """Linear interpolation of ``values`` at query times, both neighbours found in one pass.

    ``outside='null'`` leaves times beyond the known range empty, ``'clamp'`` repeats the end value; a
    dict gives the mode per value.
    Lines with fewer than ``min_knowns`` knowns give NULL. Knowns at one instant are averaged first,
    so the answer does not depend on their order.

    Queries do not look at each other, so a stretch with more than ``crowd`` of them (a stuck clock) is
    dealt out over several parts, each with its own copy of the stretch's knowns.
    """
    counts = queries.withColumn(ST, stretch).groupBy(*line, ST).agg(
        F.expr(f"CAST(ceil(count(1) / {crowd}) AS INT) AS _parts")
    )
    parts = counts.where("_parts > 1")
    k = knowns.groupBy(*line, t).agg(*[F.avg(v).alias(v) for v in values])
    k = k.withColumn(ST, stretch).join(parts, [*line, ST], "left")
    k = k.select(
        *line, t, F.struct(t, *values).alias("_known"), F.expr("explode(sequence(0, coalesce(_parts, 1) - 1)) AS _part")
    )
    keep = [c for c in queries.columns if c not in values]
    q = queries.select(*keep).withColumn(ST, stretch).join(parts, [*line, ST], "left")
    flat = ", ".join(f"`{c}`" for c, ty in queries.dtypes if c in keep and not ty.startswith(("array", "map", "binary")))
    deal = F.expr(f"CASE WHEN _parts > 1 THEN CAST(pmod(xxhash64({flat}), _parts) AS INT) ELSE 0 END AS _part")
    q = q.select(*keep, deal, F.lit(1).alias("_later"))
    # Knowns sort ahead of queries at one instant, so an exact hit is its own left neighbour; on the
    # way back the query comes first, which only loses a right neighbour equal to the left one.
    both = q.unionByName(k.withColumn("_later", F.lit(0)), allowMissingColumns=True)
    known = F.col("_known")
    hit = reach(
        both, Track(tuple(line), (t, "_later"), stretch), {"_p": (known, False)}, {"_n": (known, False)}, "_part"
    ).where("_later = 1")
    size = cut(knowns.groupBy(*line).agg(F.count(F.lit(1)).alias("_size")), "sizes")  # a small table of known size: pings are not shuffled to meet it
    out = hit.join(size, list(line), "left")

    def at(v: str) -> str:
        lerp = f"_p.`{v}` + (_n.`{v}` - _p.`{v}`) * (`{t}` - _p.`{t}`) / (_n.`{t}` - _p.`{t}`)"
        mode = outside if isinstance(outside, str) else outside[v]
        ends = f"coalesce(_p.`{v}`, _n.`{v}`)" if mode == "clamp" else "NULL"
        return (
            f"CASE WHEN coalesce(_size, 0) < {min_knowns} THEN NULL WHEN _p.`{t}` = `{t}` THEN _p.`{v}` "
            f"WHEN _p IS NULL OR _n IS NULL THEN {ends} ELSE {lerp} END AS `{v}`"
        )

    return out.selectExpr(*[f"`{c}`" for c in keep], *[at(v) for v in values])


def heading_parts(heading: str) -> list[Column]:
    return [F.sin(F.radians(heading)).alias("_s"), F.cos(F.radians(heading)).alias("_c")]


def heading_back() -> Column:
    return F.pmod(F.degrees(F.atan2("_s", "_c")), F.lit(360.0))


def interpolate_heading(
    queries: DataFrame, knowns: DataFrame, line: list[str], t: str, heading: str, stretch: Column
) -> DataFrame:
    """Heading through its sine and cosine, clamped outside the known range, result in [0, 360)."""
    unit = knowns.select(*line, t, *heading_parts(heading))
    got = interpolate(queries, unit, line, t, ["_s", "_c"], stretch, outside="clamp")
    return got.withColumn(heading, heading_back()).drop("_s", "_c")


def fill_position(df: DataFrame, own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
    """Own fix first, interpolated fix second; ``pos_source`` 0 if either exists, else 255."""
    (lat, lon), (lat2, lon2) = own, other
    gap = F.col(lat).isNull()
    return (
        df.withColumn("_lat", F.coalesce(lat, lat2))
        .withColumn("_lon", F.when(gap, F.col(lon2)).otherwise(F.col(lon)))
        .drop(lat, lon, lat2, lon2)
        .withColumnsRenamed({"_lat": lat, "_lon": lon})
        .withColumn("pos_source", F.when(F.col(lat).isNull(), F.lit(255)).otherwise(F.lit(0)))
    )


# --- filters and shifts ---------------------------------------------------------------------


def turn_filter(df: DataFrame, track: Track, t: str, heading: str, roll: str, has_pos: Column) -> DataFrame:
    """Keep pings in straight, level towing.

    The reference ping is simply the preceding one with a position and a heading, kept or not.
    """
    from soundlake import constants as K
    from soundlake.functions.geo import heading_gap

    usable = df.where(has_pos & F.col(heading).isNotNull())
    back = reach(usable, track, before={"_prev": (F.struct(F.col(t).alias("t"), F.col(heading).alias("h")), True)})
    dt = F.col(t) - F.col("_prev.t")
    gap = heading_gap(F.col(heading), F.col("_prev.h"))
    rolled = F.coalesce(F.abs(roll) > K.MAX_ROLL, F.lit(False))
    too_fast = F.coalesce((dt > 0) & (F.try_divide(gap, dt) > K.MAX_HEADING_RATE), F.lit(False))
    too_far = F.coalesce(gap > K.MAX_HEADING_STEP, F.lit(False))
    return back.where(~rolled & ~too_fast & ~too_far).drop("_prev")


def shift_back(df: DataFrame, track: Track, x: str, y: str, distance: float) -> DataFrame:
    """Move every record ``distance`` metres back along its heading.

    The heading comes from the previous record; the first record copies the second's. A lone
    record has no heading and stays where it is.
    """
    here = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    near = reach(df, track, before={"_p": (here, True)}, after={"_n": (here, True)})
    dx = F.coalesce(F.col(x) - F.col("_p.x"), F.col("_n.x") - F.col(x))
    dy = F.coalesce(F.col(y) - F.col("_p.y"), F.col("_n.y") - F.col(y))
    moved = near.withColumn("heading_rad", F.atan2(dx, dy))
    h = F.col("heading_rad")
    return (
        moved.withColumn("_x", F.coalesce(F.col(x) - distance * F.sin(h), F.col(x)))
        .withColumn("_y", F.coalesce(F.col(y) - distance * F.cos(h), F.col(y)))
        .drop(x, y, "_p", "_n")
        .withColumnsRenamed({"_x": x, "_y": y})
    )


# --- rolling medians ----------------------------------------------------------------------------


def _block_median(at: np.ndarray, v: np.ndarray, home: np.ndarray, n: int, half: int, reflect: bool) -> np.ndarray:
    """Running median at the home rows of one block; ``v`` are the values at the positions ``at``, copies near the border included."""
    first = at.min() - half
    reach = half if reflect else (min(2 * half + 1, n) - 1) // 2
    values = np.full(at.max() - first + half + 1, np.nan)
    values[at - first] = v
    windows = np.lib.stride_tricks.sliding_window_view(values if reflect else np.nan_to_num(values), 2 * reach + 1)[at[home] - first - reach]
    if not reflect:  # nothing is missing, and the middle of an odd number of values is one of them
        return np.partition(windows, reach, axis=1)[:, reach]
    result = np.full(len(windows), np.nan)
    some = ~np.isnan(windows).all(axis=1)
    result[some] = np.nanmedian(windows[some], axis=1)
    return result


def _medians_of_blocks(keys: list[str], half: int, reflect: bool, out: str, columns: list[str]):
    """Blocks come sorted; many short ones share a batch, and one that a batch cuts waits for the next."""

    def solve(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        at, v, home, n = pdf["_pos"].to_numpy(), pdf["_v"].to_numpy(dtype="float64", na_value=np.nan), pdf["_home"].to_numpy(dtype=bool), pdf["n"].to_numpy()
        ends = np.append(starts[1:], len(pdf))
        found = [_block_median(at[a:b], v[a:b], home[a:b], int(n[a]), half, reflect) for a, b in zip(starts, ends) if home[a:b].any()]
        return pdf.loc[home, columns].assign(**{out: np.concatenate(found) if found else np.zeros(0)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            starts = np.flatnonzero((pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy())
            held = pdf.iloc[starts[-1] :].reset_index(drop=True)
            if len(starts) > 1:
                yield solve(pdf.iloc[: starts[-1]], starts[:-1])
        if held is not None and len(held):
            yield solve(held, np.zeros(1, dtype=int))

    return run


def _running_median(df: DataFrame, line: list[str], value: str, window: int, out: str, reflect: bool, block: int = 8192) -> DataFrame:
    """Median over a window of positions, from ``ord`` and ``n`` columns.

    Lines are cut into blocks of ``block`` positions; rows near a border go to both blocks, so a task holds two blocks of a line at most, however long
    that is. ``reflect`` mirrors the ends, repeating the edge value.
    """
    half = window // 2
    if half >= block:
        raise ValueError("half must be smaller than block")
    o, n = F.col("ord"), F.col("n")
    pos = F.array(o)
    if reflect:
        reps = F.sequence(-F.ceil(half / (2 * n)) - 1, F.ceil(half / (2 * n)) + 1)
        images = F.filter(
            F.flatten(F.transform(reps, lambda m: F.array(o + 2 * n * m, 1 - o + 2 * n * m))),
            lambda p: p.between(1 - half, n + half),
        )
        pos = F.when((o > half) & (o <= n - half), pos).otherwise(images)
    blocks = F.sequence(F.floor((F.col("_pos") - 1 - half) / block), F.floor((F.col("_pos") - 1 + half) / block))
    spread = df.withColumn("_v", F.col(value).cast("double")).withColumn("_pos", F.explode(pos)).withColumn("_blk", F.explode(blocks))
    spread = spread.withColumn("_home", (F.col("_pos") == o) & (F.floor((F.col("_pos") - 1) / block) == F.col("_blk")))
    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])
    dealt = spread.repartition(*line, "_blk").sortWithinPartitions(*line, "_blk", "_pos")
    got = dealt.mapInPandas(_medians_of_blocks([*line, "_blk"], half, reflect, out, df.columns), schema)
    return got.withColumn(out, F.when(~F.isnan(out), F.col(out)))


def median_zero(df: DataFrame, line: list[str], value: str, window: int, out: str) -> DataFrame:
    """Odd median filter with zeros beyond the ends and for missing values; the window shrinks to fit short lines."""
    return _running_median(df, line, value, window, out, reflect=False)


def median_reflect(df: DataFrame, line: list[str], value: str, window: int, out: str) -> DataFrame:
    """Odd median filter with mirrored ends; NULLs take no part."""
    return _running_median(df, line, value, window, out, reflect=True)


def despike(
    df: DataFrame, line: list[str], value: str, out: str, window: int = 21, limit: float = 5.0, smooth: int = 11
) -> DataFrame:
    """Drop values far from the local median, then smooth, restoring the gaps.

    Lines shorter than a window skip that step. Gaps take the line's median while smoothing.
    """
    from soundlake.operators.stats import attach, quantiles

    ref = median_reflect(df, line, value, window, "_ref")
    spike = (F.col("n") >= window) & (F.abs(F.col(value) - F.col("_ref")) > limit)
    kept = cut(ref.withColumn("_kept", F.when(~F.coalesce(spike, F.lit(False)), F.col(value))).drop("_ref"), "kept")
    mid = quantiles(kept, line, "_kept", {"_mid": 0.5})
    filled = attach(kept, mid, line).withColumn("_fill", F.coalesce("_kept", "_mid"))
    soft = median_reflect(filled, line, "_fill", smooth, "_soft")
    result = F.when(F.col("n") >= smooth, F.col("_soft")).otherwise(F.col("_kept"))
    return soft.withColumn(out, F.when(F.col("_kept").isNotNull(), result)).drop("_kept", "_mid", "_fill", "_soft")


# --- runs, segments, sampling --------------------------------------------------------------------


def runs(df: DataFrame, track: Track, flag: Column, min_length: int, min_start: int = 0) -> DataFrame:
    """Maximal TRUE runs as (line, run, start, length); ``start`` counts rows from 0.

    A run is named by the number of FALSE rows before it. Rows are reduced to one row per
    (line, run) with map-side aggregation, so a long run is never one task.
    """
    tagged = runs_tag(df, track, flag)
    return (
        tagged.where("_flag")
        .groupBy(*track.line, "run")
        .agg((F.min("ord") - 1).alias("start"), F.count(F.lit(1)).alias("length"))
        .where((F.col("length") >= min_length) & (F.col("start") >= min_start))
    )


def runs_tag(df: DataFrame, track: Track, flag: Column) -> DataFrame:
    """Rows with ``ord``, ``_flag`` and the id ``run`` of the run they belong to."""
    rows = df.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    rows = ordinals(rows, track)
    rows = running_sum(rows, track, F.when(F.col("_flag"), 0).otherwise(1), "run")
    return rows.withColumn("run", F.col("run").cast("long"))


def thin(df: DataFrame, target: int = 100) -> DataFrame:
    """Every max(1, n div target)-th row, from ``ord`` and ``n`` columns."""
    step = F.greatest(F.lit(1), F.floor(F.col("n") / target))
    return df.where((F.col("ord") - 1) % step == 0)


def segment_of(size: int) -> Column:
    """0-based fixed-size segment from ``ord``."""
    return F.floor((F.col("ord") - 1) / size)


def global_ping_ids(
    df: DataFrame, track: Track, lines: list[str], ping: str, out: str = "ping_ord"
) -> DataFrame:
    """Line-local ping numbers made unique: each line starts where the previous one ended.

    Offsets come from one row per line, so no window runs over the fact table unpartitioned.
    """
    tops = df.groupBy(*lines).agg((F.max(ping) + 1).alias("_len"))
    w = Window.orderBy(*lines).rowsBetween(Window.unboundedPreceding, -1)
    offs = cut(tops.select(*lines, F.coalesce(F.sum("_len").over(w), F.lit(0)).alias("_off")), "offsets")
    return df.join(offs, lines).withColumn(out, F.col("_off") + F.col(ping)).drop("_off")


def resample_polyline(df: DataFrame, track: Track, lon: str, lat: str, points: int) -> DataFrame:
    """``points`` positions evenly spaced by distance along each line; (line, i, lon, lat).

    Every hop (d0, d1] of the line emits the targets that fall on it, so nothing is matched
    against a whole line. Ends are copied; a line of no length repeats its first point.
    """
    from soundlake.functions.geo import haversine

    line, pos = list(track.line), track.position()
    here = F.struct(F.col(lon).alias("x"), F.col(lat).alias("y"))
    step = reach(df.select(*line, *track.order, lon, lat), track, before={"_p": (here, True)})
    hop = haversine(F.col("_p.y"), F.col("_p.x"), F.col(lat), F.col(lon))
    cum = running_sum(step, track, F.coalesce(hop, F.lit(0.0)), "_d1")
    cum = reach(cum, track, before={"_d0": (F.col("_d1"), True)})
    ends = cum.groupBy(*line).agg(
        F.max("_d1").alias("_len"), F.min_by(here, pos).alias("_a"), F.max_by(here, pos).alias("_z")
    )
    unit = F.col("_len") / (points - 1)
    first = F.greatest(F.lit(1), F.floor(F.try_divide("_d0", unit))).cast("int")
    last = F.least(F.lit(points - 2), F.ceil(F.try_divide("_d1", unit))).cast("int")
    inner = (
        cum.join(ends.select(*line, "_len"), line)
        .where((F.col("_d1") > F.col("_d0")) & (first <= last))
        .withColumn("i", F.explode(F.sequence(first, last)))
        .withColumn("_td", F.col("i") * unit)
        .where((F.col("_td") > F.col("_d0")) & (F.col("_td") <= F.col("_d1")))
    )
    ratio = (F.col("_td") - F.col("_d0")) / (F.col("_d1") - F.col("_d0"))
    inner = inner.select(
        *line,
        "i",
        (F.col("_p.x") + ratio * (F.col(lon) - F.col("_p.x"))).alias(lon),
        (F.col("_p.y") + ratio * (F.col(lat) - F.col("_p.y"))).alias(lat),
    )
    flat = F.col("_len") == 0
    fixed = ends.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).where(
        flat | F.col("i").isin(0, points - 1)
    )
    at_end = (F.col("i") == points - 1) & ~flat
    fixed = fixed.select(
        *line,
        "i",
        F.when(at_end, F.col("_z.x")).otherwise(F.col("_a.x")).alias(lon),
        F.when(at_end, F.col("_z.y")).otherwise(F.col("_a.y")).alias(lat),
    )
    return inner.unionByName(fixed)
