"""Group statistics that stay exact when one group holds a third of all rows.

``percentile`` and ``median`` keep a whole group's values in one task, and even counting equal values moves nearly all of them. Here only counts of buckets
are moved: a log-scale histogram finds the bucket that holds the wanted rank, an even histogram of that bucket's own range finds a part of it, and
only the different values of that part are sorted. Values far from zero relative to their spread fill few log-scale buckets; the second histogram takes
care of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundlake.operators.along import Track, ordinals
from soundlake.operators.lineage import cut

MAD_SIGMA = 1.4826


STEPS = 4096  # histogram buckets per octave, and parts of a bucket

# Order-preserving log-scale bucket of ``_v``, and the part of that bucket's range from ``_min`` to ``_max``.
BUCKET = (
    f"CASE WHEN _v > 0 THEN floor(log2(_v) * {STEPS}) + {1100 * STEPS} "
    f"WHEN _v < 0 THEN -(floor(log2(-_v) * {STEPS}) + {1100 * STEPS}) ELSE 0 END AS _b"
)
PART = f"CASE WHEN _max > _min THEN least(floor((_v - _min) / (_max - _min) * {STEPS}), {STEPS - 1}) ELSE 0 END AS _s"


def quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    where: Column | None = None,
    count: str | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``probs``.

    NULL values and NULL keys are skipped; groups without values are absent. ``keys`` may be empty (one
    row). ``df`` is read three times: cut it first where its lineage is long. The tables of hit buckets are stored, so that the planner knows their size
    when it joins them with the rows: at most two rows per group and quantile.
    """
    by = [f"`{c}`" for c in keys] or ["_all"]
    names = keys or ["_all"]
    src = df if where is None else df.where(where)
    src = src.selectExpr(*(by if keys else ["0 AS _all"]), f"CAST(`{value}` AS DOUBLE) AS _v")
    src = src.where(" AND ".join(f"{c} IS NOT NULL" for c in [*by, "_v"])).selectExpr(*by, "_v", BUCKET)
    part = "PARTITION BY " + ", ".join(by)
    size = [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")]
    ranks = ", ".join(
        f"named_struct('_i', {i}, '_frac', {at} - floor({at}), '_r', CAST({edge}({at}) AS BIGINT))"
        for i, at in enumerate(f"{float(p)!r}D * (_tot - 1)" for p in probs.values())
        for edge in ("floor", "ceil")
    )
    # One row per hit bucket, with the ranks that fall into it, counted from its first value.
    inside = "transform(filter({q}, q -> q._r >= _lo AND q._r < _lo + _n), q -> named_struct('_i', q._i, '_frac', q._frac, '_r', q._r - _lo)) AS _q"
    first = src.groupBy(*names, "_b").agg(*size).selectExpr(
        *by, "_b", "_n", "_min", "_max", f"sum(_n) OVER ({part} ORDER BY _b) - _n AS _lo", f"sum(_n) OVER ({part}) AS _tot"
    )
    first = first.selectExpr(*by, "_b", "_min", "_max", "_tot", inside.format(q=f"array({ranks})"))
    first = cut(first.where("size(_q) > 0"), "hits")
    seen = _meet(src, first.select(*names, "_b", "_min", "_max"), [*names, "_b"], keys).selectExpr(*by, "_b", "_v", PART)
    second = seen.groupBy(*names, "_b", "_s").agg(*size).withColumnsRenamed({"_min": "_least", "_max": "_most"})
    second = second.selectExpr("*", f"sum(_n) OVER ({part}, _b ORDER BY _s) - _n AS _lo").join(first.withColumnRenamed("_q", "_all_q"), [*names, "_b"])
    second = second.selectExpr(*by, "_b", "_s", "_least", "_most", "_min", "_max", "_tot", inside.format(q="_all_q"))
    second = cut(second.where("size(_q) > 0"), "hits")
    # A part with a single value is known; the values of the others are counted and sorted.
    known = second.where("_least = _most").selectExpr(*by, "_least AS _v", "_tot", "_q")
    wide = second.where("_least < _most")
    values = _meet(src, wide.selectExpr(*by, "_b", "_s AS _in", "_min", "_max"), [*names, "_b"], keys)
    values = values.selectExpr("*", PART).where("_s = _in").groupBy(*names, "_b", "_s", "_v").agg(F.count(F.lit(1)).alias("_n"))
    values = values.selectExpr("*", f"sum(_n) OVER ({part}, _b, _s ORDER BY _v) - _n AS _lo").join(wide.select(*names, "_b", "_s", "_tot", "_q"), [*names, "_b", "_s"])
    values = values.selectExpr(*by, "_v", "_tot", "filter(_q, q -> q._r >= _lo AND q._r < _lo + _n) AS _q")
    picked = known.unionByName(values).selectExpr(*by, "_v", "_tot", "inline(_q)")
    out = []
    for i, name in enumerate(probs):
        # Both neighbours of the rank are there; where they are one value, so are they one.
        lo, hi, frac = (f"{agg}(CASE WHEN _i = {i} THEN {c} END)" for agg, c in (("min", "_v"), ("max", "_v"), ("max", "_frac")))
        out.append(f"{lo} + ({hi} - {lo}) * {frac} AS `{name}`")
    if count:
        out.append(f"max(_tot) AS `{count}`")
    res = picked.groupBy(*names).agg(*[F.expr(o) for o in out])
    return res if keys else res.drop("_all")


def _meet(rows: DataFrame, hits: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """Rows of the hit buckets. Without keys there is a handful of these; with keys the planner goes by the stored size."""
    return rows.join(hits if keys else F.broadcast(hits), on)


def attach(df: DataFrame, stats: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Join group statistics back to the rows.

    A table without keys has one row: it enters as a scalar subquery. Otherwise it is stored, and the planner decides by its
    size, so rows are not shuffled to meet a small table (``small=True`` is for groups bounded by a constant, such as angle bins).
    """
    if not keys:
        one = stats.select(F.struct(*stats.columns)).scalar()
        return df.withColumn("_one", one).select(*df.columns, *[F.col(f"_one.{c}").alias(c) for c in stats.columns])
    return df.join(F.broadcast(stats) if small else cut(stats, "stats"), keys, "left")


def small_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Median of groups that are small by nature (one ping's samples in one degree).

    One exchange and one sort, all in generated code; millions of tiny groups would push the built-in
    ``median``, an object aggregate, into its sort-based fallback. For groups without a bound use
    ``quantiles``. The rows compress well, so partitions joined by their bytes would hold many: the tasks that sort them are as many as the session's partitions.
    """
    part = "PARTITION BY " + ", ".join(f"`{c}`" for c in keys)
    n = f"count(1) OVER ({part})"
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.where(F.col(value).isNotNull()).selectExpr(*[f"`{c}`" for c in keys], f"`{value}` AS _v").repartition(tasks, *[f"`{c}`" for c in keys])
    ranked = dealt.selectExpr("*", f"row_number() OVER ({part} ORDER BY _v) AS _i", f"{n} AS _n")
    mid = ranked.where("_i = (_n + 1) div 2 OR _i = _n div 2 + 1")
    return mid.groupBy(*keys).agg(F.avg("_v").alias(out))


def median_mad(df: DataFrame, keys: list[str], value: str, small: bool = False) -> DataFrame:
    """Rows with ``med``, ``mad`` and ``cnt`` of their group."""
    med = quantiles(df, keys, value, {"med": 0.5}, count="cnt")
    dev = attach(df, med, keys, small).withColumn("_dev", F.abs(F.col(value) - F.col("med")))
    mad = quantiles(dev, keys, "_dev", {"mad": 0.5})
    return attach(dev.drop("_dev"), mad, keys, small)


def summary(df: DataFrame, keys: list[str], value: str, total: Column | None = None) -> DataFrame:
    """Valid count, min, max, mean, population std and median per group; coverage % of ``total``."""
    aggs = [
        F.count(value).alias("n_valid"),
        F.min(value).alias("vmin"),
        F.max(value).alias("vmax"),
        F.avg(value).alias("vmean"),
        F.stddev_pop(value).alias("vstd"),
    ]
    base = df.groupBy(*keys).agg(*aggs)
    med = quantiles(df, keys, value, {"vmedian": 0.5})
    out = base.join(med, keys, "left") if keys else attach(base, med, keys)
    return out if total is None else out.withColumn("coverage", 100 * F.col("n_valid") / total)


def shares(df: DataFrame, cls: str, over: list[str] | None = None) -> DataFrame:
    """Count and percentage per class; the share window runs over the class counts only."""
    over = over or []
    counts = df.groupBy(*over, cls).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*over) if over else Window.partitionBy(F.lit(0))
    return counts.withColumn("pct", 100 * F.col("n") / F.sum("n").over(w))


#: Values of which every task may hold a copy (8 bytes each) when replicates are drawn; more are joined.
HELD = 1 << 21


def bootstrap_median(df: DataFrame, value: str, track: Track, reps: int = 2000, seed: int = 42) -> DataFrame:
    """Median, population std and a 95 % bootstrap interval of the median (NULL below three values).

    Draw ``j`` of replicate ``r`` takes row ``mix(seed, r, j) mod n``, so there is no random stream. Input is one row per calibration segment;
    ``track`` orders them. Up to ``HELD`` values go to every task, which draws whole replicates and sends one number for each; beyond that each draw
    finds its value by an equi join on the row number.
    """
    known = df.where(F.col(value).isNotNull()).select(*track.line, *track.order, F.col(value).alias("v"))
    one = cut(known.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("v").alias("std")), "one")
    n = one.first()["n"]
    one = attach(one, quantiles(known, [], "v", {"median": 0.5}), [])
    ranked = ordinals(known, track).select((F.col("ord") - 1).alias("i"), F.col("v").cast("double").alias("v"))
    if n <= HELD:
        per_rep = _drawn(ranked, n, reps if n >= 3 else 0, seed)
    else:
        draws = ranked.select(F.col("i").alias("j")).withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(reps - 1).cast("long"))))
        draws = draws.select("r", draw_index(F.lit(seed), F.col("r"), F.col("j"), F.lit(n)).alias("i"))
        per_rep = quantiles(draws.join(ranked, "i"), ["r"], "v", {"m": 0.5})
    return attach(one, quantiles(per_rep, [], "m", {"ci_lo": 0.025, "ci_hi": 0.975}), [])


def _drawn(ranked: DataFrame, n: int, reps: int, seed: int) -> DataFrame:
    """(r, m): median of each replicate, from values that every task holds."""
    spark = ranked.sparkSession
    values = np.empty(n)
    rows = ranked.toPandas()
    values[rows["i"].to_numpy()] = rows["v"].to_numpy()
    held = spark.sparkContext.broadcast(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        j = np.arange(len(v), dtype=np.int64) * 7919 + seed
        lo, hi = (len(v) - 1) // 2, len(v) // 2
        for batch in batches:
            r = batch.column(0).to_numpy()
            m = np.empty(len(r))
            for k, rep in enumerate(r.tolist()):
                a = (rep * 2000003 + j) % 2147483647
                mixed = ((a * 48271 % 2147483647) * 48271 + 12345) % 2147483647
                drawn = np.partition(v[mixed % len(v)], (lo, hi))
                m[k] = drawn[lo] + (drawn[hi] - drawn[lo]) * 0.5
            yield pa.record_batch([pa.array(r), pa.array(m)], names=["r", "m"])

    return cut(spark.range(reps).withColumnRenamed("id", "r").mapInArrow(run, "r long, m double"), "medians")


def draw_index(seed: Column, r: Column, j: Column, n: Column) -> Column:
    """0-based draw from a fixed multiplicative mix of (seed, replicate, draw)."""
    a = (r * 2000003 + j * 7919 + seed) % 2147483647
    b = (a * 48271) % 2147483647
    return ((b * 48271 + 12345) % 2147483647) % n


def kde(df: DataFrame, value: str, points: int = 1000) -> DataFrame:
    """Gaussian density (Scott bandwidth) at ``points`` even positions from min to max; none for a constant.

    Equal values are counted first. Each value adds to the fixed number of grid points its kernel
    reaches (beyond 38 bandwidths the exponential underflows to zero), summed map-side.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("c")
    )
    n = F.sum("c")
    mean = F.sum(F.col("v") * F.col("c")) / n
    one = counts.agg(n.alias("n"), mean.alias("mu"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    var = attach(counts, one, []).agg(
        F.try_divide(
            F.sum(F.col("c") * (F.col("v") - F.col("mu")) * (F.col("v") - F.col("mu"))), F.max("n") - 1
        ).alias("var")
    )
    par = attach(one, var, []).select(
        "n",
        "lo",
        ((F.col("hi") - F.col("lo")) / (points - 1)).alias("dx"),
        (F.sqrt("var") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bw"),
    )
    near = 38 * F.col("bw")
    first = F.greatest(F.lit(0), F.ceil(F.try_divide(F.col("v") - near - F.col("lo"), F.col("dx")))).cast("int")
    last = F.least(F.lit(points - 1), F.floor(F.try_divide(F.col("v") + near - F.col("lo"), F.col("dx")))).cast("int")
    hit = attach(counts, par.where("dx > 0"), []).where("dx > 0").withColumn("i", F.explode(F.sequence(first, last)))
    x = F.col("lo") + F.col("i") * F.col("dx")
    z = (x - F.col("v")) / F.col("bw")
    dens = F.sum(F.col("c") * F.exp(-0.5 * z * z)) / (F.max("n") * F.max("bw") * 2.5066282746310002)
    return hit.groupBy("i").agg(F.max(x).alias("x"), dens.alias("density"))


def unimodality(df: DataFrame, value: str, points: int = 1000) -> DataFrame:
    """Modes above 30 % of the top density, the main mode, and median minus mode in dB."""
    curve = kde(df, value, points)
    w = Window.partitionBy(F.lit(0)).orderBy("i")  # a fixed number of grid points
    near = curve.withColumn("_l", F.lag("density").over(w)).withColumn("_r", F.lead("density").over(w))
    top = curve.agg(F.max("density").alias("top"), F.max_by("x", F.struct("density", -F.col("i"))).alias("mode"))
    peak = (F.col("density") > F.col("_l")) & (F.col("density") > F.col("_r")) & (
        F.col("density") >= 0.3 * F.col("top")
    )
    modes = attach(near, top, []).agg(
        F.sum(F.coalesce(peak.cast("int"), F.lit(0))).alias("n_modes"), F.max("mode").alias("mode")
    )
    med = quantiles(df, [], value, {"median": 0.5}, count="n")
    return attach(modes, med, []).withColumn("gap_db", 20 * (F.col("median") - F.col("mode")))
