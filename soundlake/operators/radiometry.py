"""Side-scan radiometry: gains, angular waterfall, clusters, response curves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.functions import acoustic as A
from soundlake.operators.lineage import cut
from soundlake.operators.raster import label_median
from soundlake.operators.stats import MAD_SIGMA, attach, median_mad, quantiles, small_median


def gain_references(df: DataFrame, keys: list[str], value: str, prob: float = 0.4) -> DataFrame:
    return quantiles(df, keys, value, {"ref": prob}, count="n")


def normalise_gain(
    df: DataFrame, keys: list[str], value: str, out: str, prob: float = 0.4, min_samples: int = 100
) -> DataFrame:
    """Divide by the group's 40th percentile where the group is large enough and it is positive."""
    ref = gain_references(df, keys, value, prob)
    use = (F.col("n") >= min_samples) & (F.col("ref") > 0)
    j = attach(df, ref, keys)
    return j.withColumn(out, F.when(use, F.col(value) / F.col("ref")).otherwise(F.col(value))).drop("ref", "n")


def normalise_agc(df: DataFrame, keys: list[str], value: str, out: str, prob: float = 0.4) -> DataFrame:
    """Divide by the 40th percentile of the positive values, floored at 1e-6."""
    ref = quantiles(df, keys, value, {"ref": prob}, where=F.col(value) > 0)
    j = attach(df, ref, keys)
    scaled = F.col(value) / F.greatest("ref", F.lit(1e-6))
    return j.withColumn(out, F.coalesce(scaled, F.col(value))).drop("ref")


def gain_report(refs: DataFrame) -> DataFrame:
    """Spread of the positive references: p5, median, p95, max/min."""
    pos = refs.where("ref > 0")
    q = quantiles(pos, [], "ref", {"p5": 0.05, "median": 0.5, "p95": 0.95}, count="n_groups")
    r = pos.agg((F.max("ref") / F.min("ref")).alias("ratio"))
    return attach(q, r, [])


def correct_altitude(
    df: DataFrame, value: str, altitude: str, out: str, clip: float = 0.995, lo: float = 0.5, hi: float = 2.0
) -> DataFrame:
    """Clip at the 99.5th percentile of the positive values, times h0/altitude held in [0.5, 2]."""
    h0 = quantiles(df, [], altitude, {"h0": 0.5})
    top = quantiles(df, [], value, {"top": clip}, where=F.col(value) > 0)
    j = attach(attach(df, h0, []), top, [])
    ratio = F.greatest(F.lit(lo), F.least(F.lit(hi), F.try_divide("h0", F.col(altitude))))
    return j.withColumn(out, F.least(F.col(value), F.col("top")) * ratio).drop("top", "h0")


def angle_bin(angle: Column) -> Column:
    """1-degree bin from the lowest waterfall angle; NULL outside [20, 70)."""
    ok = (angle >= K.ANGLE_MIN) & (angle < K.ANGLE_MAX)
    return F.when(ok, F.floor(angle - K.ANGLE_MIN).cast("int"))


def waterfall(df: DataFrame, ping: list[str], db: str, angle: str) -> DataFrame:
    """Median level per (ping, bin): a group holds one ping's samples inside one degree."""
    d = df.withColumn("bin", angle_bin(F.col(angle))).where(F.col("bin").isNotNull())
    return small_median(d, [*ping, "bin"], db, "bs")


def ping_waterfall(pings: DataFrame, ping: list[str], db: str, angle: str) -> DataFrame:
    """:func:`waterfall` of pings that hold their levels and angles as arrays: (ping..., bin, bs).

    A ping's samples lie in one row, so its medians are taken there, before anything is exploded, and no sample crosses the network.
    Missing levels count for nothing; arrays of unlike length end with the shorter one.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pings.select(*ping).schema)
    paired = F.transform(F.arrays_zip(F.col(angle).alias("a"), F.col(db).alias("v")), lambda p: F.struct(p["a"].cast("double").alias("a"), p["v"].cast("double").alias("v")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(len(ping))
                flat, row = lists.flatten(), np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy())
                a, v = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (0, 1))
                use = (a >= K.ANGLE_MIN) & (a < K.ANGLE_MAX) & ~np.isnan(v)
                row, level, place = row[use], v[use], np.floor(a[use] - K.ANGLE_MIN).astype(np.int32)
                order = np.lexsort((level, place, row))
                row, level, place = row[order], level[order], place[order]
                start = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (place[1:] != place[:-1]))[: len(row)])
                size = np.diff(np.append(start, len(row)))
                median = (level[start + (size - 1) // 2] + level[start + size // 2]) / 2
                keys = [c.take(pa.array(row[start])) for c in part.columns[: len(ping)]]
                yield pa.record_batch([*keys, pa.array(place[start]), pa.array(median)], names=[*ping, "bin", "bs"])

    return pings.select(*ping, paired.alias("_p")).mapInArrow(run, f"{kinds}, bin int, bs double")


def robust_z(wf: DataFrame, value: str = "bs", min_count: int = 10) -> DataFrame:
    """(x - median) / (1.4826 MAD) per bin; NULL for thin or constant bins.

    The waterfall is stored first: it is far smaller than its samples and is read several times.
    """
    s = median_mad(cut(wf, "waterfall"), ["bin"], value, small=True)
    use = (F.col("cnt") >= min_count) & (F.col("mad") >= 1e-6)
    return s.withColumn("z", F.when(use, (F.col(value) - F.col("med")) / (MAD_SIGMA * F.col("mad")))).drop(
        "med", "mad", "cnt"
    )


# --- one-dimensional k-means -----------------------------------------------------------------------


def _nearest_centre(v: Column, centres: list[float]) -> Column:
    """Index of the nearest of sorted centres: how many midpoints lie at or below the value."""
    mids = [(a + b) / 2 for a, b in zip(centres, centres[1:])]
    return sum(((v > m).cast("int") for m in mids), F.lit(0))


#: Even buckets into which the values are summed once, parts of a bucket that is looked into again, and how often that may go on.
BUCKETS, PARTS, DEEPER = 4096, 256, 40
#: A bucket is split where its own spread could matter: count times width squared above this share of the clusters' spread. Most that are split at once.
COARSE, AT_ONCE = 1e-5, 64
#: More rounds than any run needs to settle, after which an error is raised.
SAFETY = 1000


def best_splits(n: np.ndarray, s: np.ndarray, k: int) -> list[list[int]]:
    """For 1 to ``k`` clusters the starts of all but the first, such that the sum of squares within clusters of sorted buckets is the least.

    That is the largest sum of S*S/N over clusters. The best last split moves right with the end, so each layer halves its way through the ends
    and every end looks only between the splits of its neighbours.
    """
    at_n, at_s = np.append(0.0, np.cumsum(n)), np.append(0.0, np.cumsum(s))
    m = len(n)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(at_n > 0, at_s * at_s / at_n, 0.0)
    found, cuts = [[]], []
    for c in range(2, min(k, m) + 1):
        new, cut_at = np.full(m + 1, -np.inf), np.zeros(m + 1, np.int64)
        todo = [(c, m, c - 1, m - 1)]
        while todo:
            lo, hi, left, right = todo.pop()
            if lo > hi:
                continue
            end = (lo + hi) // 2
            i = np.arange(left, min(right, end - 1) + 1)
            total = gain[i] + (at_s[end] - at_s[i]) ** 2 / (at_n[end] - at_n[i])
            best = int(i[np.argmax(total)])
            new[end], cut_at[end] = total.max(), best
            todo += [(lo, end - 1, left, best), (end + 1, hi, best, right)]
        cuts.append(cut_at)
        gain, ends = new, [m]
        for at in reversed(cuts):
            ends.append(int(at[ends[-1]]))
        found.append(ends[:0:-1])
    return found


def bucket_sums(values: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(count, sum) of ``v`` in sorted buckets, narrow where a border between up to ``k`` clusters may run.

    One scan, one for each time that a bucket holds so much that its own spread matters, as next to an outlier, and one for the buckets at the
    borders. At most BUCKETS + (DEEPER + 1) * AT_ONCE * PARTS rows reach the driver.
    """
    lo, hi = values.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        return np.zeros(0), np.zeros(0)
    step = (hi - lo) / BUCKETS or 1.0
    at = F.least(F.floor((F.col("v") - lo) / step), F.lit(BUCKETS - 1)).cast("int")
    sums = (F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"))

    def rows(df: DataFrame) -> list[tuple]:
        return [tuple(r)[1:] for r in df.groupBy("b").agg(*sums).collect()]

    def arrays() -> tuple[np.ndarray, ...]:
        table.sort(key=lambda b: b[2])
        return tuple(np.array(x, np.float64) for x in zip(*table, strict=True))

    def finer(which: list[int]) -> list[tuple]:
        """The table with these buckets cut into parts."""
        part = F.lit(None).cast("int")
        for i in which:
            low, high = float(table[i][2]), float(table[i][3])
            inside = F.floor((F.col("v") - low) / ((high - low) / PARTS))
            part = F.when(F.col("v").between(low, high), i * PARTS + F.least(inside, F.lit(PARTS - 1))).otherwise(part)
        return [b for i, b in enumerate(table) if i not in set(which)] + rows(values.withColumn("b", part).where("b is not null"))

    table = rows(values.withColumn("b", at))
    for _ in range(DEEPER):
        n, s, low, high = arrays()
        ends = [0, *best_splits(n, s - n * (s.sum() / n.sum()), k)[-1], len(n)]
        spread = sum(float(np.sum(n[a:b] * (s[a:b] / n[a:b] - s[a:b].sum() / n[a:b].sum()) ** 2)) for a, b in zip(ends, ends[1:]))
        own = n * (high - low) ** 2
        wide = [i for i in np.argsort(-own)[:AT_ONCE].tolist() if own[i] > COARSE * spread and high[i] > low[i]]
        if not wide:
            break
        table = finer(wide)
    n, s, low, high = arrays()
    borders = [e for splits in best_splits(n, s - n * (s.sum() / n.sum()), k) for e in splits]
    near = {i for e in borders for i in range(e - 2, e + 2) if 0 <= i < len(n) and high[i] > low[i]}
    if near:
        table = finer(sorted(near)[: AT_ONCE * 2])
        n, s, _, _ = arrays()
    return n, s


def settle(values: DataFrame, centres: list[float]) -> tuple[list[float], list[int]]:
    """Centres moved to the exact means of the values nearest to them until the sizes stay: a scan a round, of which few are needed from a good start."""
    sizes: list[int] = []
    for _ in range(SAFETY):
        own = _nearest_centre(F.col("v"), centres)
        parts = {r.c: (r.n, r.s) for r in values.groupBy(own.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect()}
        new = [parts.get(i, (0, 0.0))[0] for i in range(len(centres))]
        centres = sorted(parts[i][1] / parts[i][0] if i in parts else c for i, c in enumerate(centres))
        if new == sizes:
            return centres, sizes
        sizes = new
    raise RuntimeError(f"no stable clusters after {SAFETY} rounds")


def optimal_clusters(df: DataFrame, value: str, k: int) -> tuple[list[float], list[int]]:
    """Centres (ascending) and sizes of the ``k`` clusters of least squared distance; fewer where there are fewer different values.

    In one dimension clusters are runs of sorted values, so no seeding and no restarts are needed: dynamic programming finds the best runs over sums of
    narrow buckets, and a few exact rounds settle the values next to a border. The result does not depend on chance or on the order of rows.
    """
    found = _ladder(df, value, k)
    return found(k) if found else ([], [])


def _ladder(df: DataFrame, value: str, k: int):
    """Optimal clusters of any number up to ``k``, from one set of bucket sums; None without values."""
    values = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    n, s = bucket_sums(values, k)
    if not len(n):
        return None
    shift = s.sum() / n.sum()
    splits = best_splits(n, s - n * shift, k)

    def fit(c: int) -> tuple[list[float], list[int]]:
        ends = [0, *splits[min(c, len(splits)) - 1], len(n)]
        return settle(values, [float(s[a:b].sum() / n[a:b].sum()) for a, b in zip(ends, ends[1:])])

    return fit


def merged_count(centres: list[float], sizes: list[int], spread: float, share: float = 0.01, near: float = 0.02) -> int:
    """How many clusters remain after dropping tiny ones and those too close to their lower neighbour."""
    total = sum(sizes)
    big = [c for c, n in zip(centres, sizes) if total and n / total >= share]
    gaps = [b - a for a, b in zip(big, big[1:])]
    return (1 if big else 0) + sum(g >= near * spread for g in gaps)


def cluster(df: DataFrame, value: str, k: int = 7, refits: int = 10) -> list[float]:
    """Centres after refitting with fewer clusters until no two of them merge.

    The centres are those of the last fit; merging only lowers k for the next one. All fits share one set of bucket sums.
    """
    q = quantiles(df, [], value, {"lo": 0.05, "hi": 0.95}).first()
    fit = None if q is None else _ladder(df, value, k)
    if fit is None:
        return []
    centres: list[float] = []
    for _ in range(refits):
        centres, sizes = fit(k)
        left = merged_count(centres, sizes, q["hi"] - q["lo"])
        if left == 0 or left == k:
            break
        k = left
    return centres


def label(df: DataFrame, value: str, centres: list[float], out: str = "label") -> DataFrame:
    """Cluster id by ascending centre, NULL where the value is NULL."""
    return df.withColumn(out, F.when(F.col(value).isNotNull(), _nearest_centre(F.col(value), centres)))


# --- response curves ---------------------------------------------------------------------------------


def response_curves(
    wf: DataFrame, cluster_col: str, value: str = "bs", min_count: int = 5, min_bins: int = 3
) -> DataFrame:
    """Mean level per (cluster, bin), smoothed over five present bins with mirrored ends; ``level`` is its mean.

    At most clusters x 50 rows after the first aggregation.
    """
    c = [cluster_col]
    pts = wf.where(F.col(cluster_col) >= 0).groupBy(*c, "bin").agg(F.avg(value).alias("m"), F.count(value).alias("n"))
    pts = pts.where(F.col("n") >= min_count).drop("n")
    w = Window.partitionBy(*c)
    pts = pts.withColumn("i", F.row_number().over(w.orderBy("bin"))).withColumn("k", F.count(F.lit(1)).over(w))
    pts = pts.where(F.col("k") >= min_bins)
    # Each bin lends its value to the positions whose window, after mirroring, reaches it.
    spread = pts.withColumn("o", F.explode(F.sequence(F.lit(-2), F.lit(2))))
    at = F.col("i") + F.col("o")
    two = 2 * F.col("k")
    m = F.pmod(at - 1, two)
    src = spread.withColumn("j", F.when(m < F.col("k"), m + 1).otherwise(two - m))
    val = pts.select(*c, F.col("i").alias("j"), F.col("m").alias("_mv"))
    soft = src.join(val, [*c, "j"]).groupBy(*c, "bin").agg(F.avg("_mv").alias("curve"))
    return soft.withColumn("level", F.avg("curve").over(w))


def apply_curves(df: DataFrame, curves: DataFrame, cluster_col: str, db: str, angle: str, out: str) -> DataFrame:
    """Level minus the cluster's curve at the angle plus its mean; other samples stay as they are.

    The curve is linear between bin centres and constant beyond its ends. It is broadcast as one
    array per cluster (at most 50 bins each).
    """
    pts = F.array_sort(F.collect_list(F.struct((F.col("bin") + K.ANGLE_MIN + 0.5).alias("a"), F.col("curve").alias("v"))))
    arr = curves.groupBy(cluster_col).agg(pts.alias("_c"), F.max("level").alias("_level")).where(F.size("_c") >= 2)
    j = df.join(F.broadcast(arr), cluster_col, "left")
    a = F.col(angle).cast("double")
    before = F.filter("_c", lambda p: p["a"] <= a)
    lo = F.get(before, F.size(before) - 1)
    hi = F.get(F.col("_c"), F.size(before))
    j = j.withColumn("_lo", lo).withColumn("_hi", hi)
    mid = F.col("_lo.v") + (F.col("_hi.v") - F.col("_lo.v")) * (a - F.col("_lo.a")) / (F.col("_hi.a") - F.col("_lo.a"))
    curve = F.coalesce(mid, F.col("_lo.v"), F.col("_hi.v"))
    return j.withColumn(out, F.coalesce(F.col(db) - curve + F.col("_level"), F.col(db))).drop("_c", "_level", "_lo", "_hi")


def label_image(wf: DataFrame, ping: str, label_col: str) -> DataFrame:
    """Labels smoothed over neighbouring pings and bins.

    Rows are the dense rank of pings that have a bin; the rank comes from counts per block of pings,
    so no window covers all of them.
    """
    ranks = ping_ranks(wf, ping)
    dense = wf.join(ranks, ping)
    return label_median(dense, label_col)


#: Pings of which a window holds the labels at once.
PING_BLOCK = 4096


def smoothed_labels(wf: DataFrame, ping: str, label_col: str) -> DataFrame:
    """(ping, bin, smoothed) of the labelled cells: :func:`label_image` of :func:`full_image`, which is never formed.

    A ping is one short array with a place for every bin, so a survey whose pings fill few of them costs a row a ping instead of three for every place.
    Blocks of pings hold a copy of the ping next to them on either side.
    """
    n = int(K.ANGLE_MAX - K.ANGLE_MIN)
    held = F.map_from_entries(F.collect_list(F.when(F.col(label_col).isNotNull(), F.struct("bin", F.col(label_col).cast("short").alias("l")))))
    edge = F.array(F.lit(0).cast("short"))
    places = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda b: F.coalesce(F.try_element_at("_m", b), F.lit(-1).cast("short")))
    rows = wf.groupBy(ping).agg(held.alias("_m")).join(ping_ranks(wf, ping), ping).select(ping, "row", F.concat(edge, places, edge).alias("_l"))
    block = lambda d: F.floor((F.col("row") + d) / PING_BLOCK)
    rows = rows.withColumn("_blk", F.explode(F.array_distinct(F.array(block(0), block(-1), block(1)))))
    w = Window.partitionBy("_blk").orderBy("row")
    beyond = F.array_repeat(F.lit(0).cast("short"), n + 2)
    near = [F.coalesce(f("_l").over(w), beyond) for f in (F.lag, F.lead)]
    rows = rows.withColumn("_a", near[0]).withColumn("_b", near[1]).where(F.col("_blk") == block(0))
    cells = rows.select(ping, "_l", "_a", "_b", F.posexplode(F.slice("_l", 2, n)).alias("bin", "_own")).where("_own >= 0")
    nine = F.array_sort(F.concat(*[F.slice(c, F.col("bin") + 1, F.lit(3)) for c in ("_a", "_l", "_b")]))
    return cells.select(ping, "bin", F.get(nine, F.lit(4)).cast("int").alias("smoothed"))


def ping_ranks(wf: DataFrame, ping: str, block: int = 100_000) -> DataFrame:
    """(ping, row): 0-based dense rank of the ping ids present."""
    ids = wf.select(ping).distinct().withColumn("_blk", F.floor(F.col(ping) / block))
    base = ids.groupBy("_blk").agg(F.count(F.lit(1)).alias("_k"))
    w = Window.partitionBy(F.lit(0)).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select("_blk", F.coalesce(F.sum("_k").over(w), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_blk").orderBy(ping)
    return ids.join(base, "_blk").select(ping, (F.col("_base") + F.row_number().over(inner) - 1).alias("row"))


def correct(
    samples: DataFrame, ping: str, value: str, altitude: str, angle: str, far: Column, k: int = 7
) -> DataFrame:
    """The whole correction: altitude -> dB -> waterfall -> z -> clusters -> curves -> angle mask.

    Adds ``bs_db`` and ``label`` (-1 where a sample's (ping, bin) has none).
    """
    s = cut(correct_altitude(samples, value, altitude, "_lin").withColumn("_db", A.to_db(F.col("_lin"))).drop("_lin"), "levels")  # read twice, made of two global quantiles
    wf = robust_z(waterfall(s, [ping], "_db", angle))
    wf = cut(wf)  # read by the quantiles, the clusters and the image
    centres = cluster(wf, "z", k)
    labelled = label(wf, "z", centres)
    image = cut(smoothed_labels(labelled, ping, "label").withColumnRenamed("smoothed", "label"), "image")  # read by the curves and the samples
    wl = labelled.drop("label").join(image, [ping, "bin"], "left")
    curves = response_curves(wl, "label")
    out = apply_curves(sample_labels(s, image, ping, angle), curves, "label", "_db", angle, "_corr")
    return out.withColumn("bs_db", A.angle_mask(F.col("_corr"), F.col(angle), far)).drop("_db", "_corr")


def sample_labels(samples: DataFrame, image: DataFrame, ping: str, angle: str) -> DataFrame:
    """Label of each sample's (ping, bin), -1 where there is none."""
    s = samples.withColumn("bin", angle_bin(F.col(angle)))
    lab = image.select(ping, "bin", "label")
    return s.join(lab, [ping, "bin"], "left").withColumn("label", F.coalesce("label", F.lit(-1))).drop("bin")


def cluster_report(image: DataFrame, ping: str, label_col: str) -> DataFrame:
    """Number of clusters, and the share of (ping, bin) places without a label."""
    places = int(K.ANGLE_MAX - K.ANGLE_MIN)
    pings = image.select(ping).distinct().agg(F.count(F.lit(1)).alias("_p"))
    lab = F.when(F.col(label_col) >= 0, F.col(label_col))
    c = image.agg(F.coalesce(F.max(lab) + 1, F.lit(0)).alias("n_clusters"), F.count(lab).alias("_n"))
    return attach(c, pings, []).select("n_clusters", (1 - F.col("_n") / (places * F.col("_p"))).alias("unlabelled"))


def full_image(wf: DataFrame, ping: str) -> DataFrame:
    """Every (ping, bin) of the image: bins without a value are unlabelled, not beyond the edge."""
    n = int(K.ANGLE_MAX - K.ANGLE_MIN)
    all_ = wf.select(ping).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return all_.join(wf, [ping, "bin"], "left")


def angle_diagnostics(df: DataFrame, db: str, angle: str, lo: float = 15.0, hi: float = 80.0, min_count: int = 100) -> DataFrame:
    """Per 1-degree bin: count, median, robust CV, share of |z| > 3; statistics need 100 samples."""
    a = F.col(angle)
    d = df.where((a >= lo) & (a < hi) & F.col(db).isNotNull()).withColumn("bin", F.floor(a - lo).cast("int"))
    s = median_mad(d, ["bin"], db, small=True)
    sig = MAD_SIGMA * F.col("mad")
    z = F.abs((F.col(db) - F.col("med")) / F.greatest(sig, F.lit(1e-6)))
    ok = F.col("n") >= min_count
    g = s.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("med").alias("med"),
        F.max("mad").alias("mad"),
        F.avg((z > 3).cast("double")).alias("out"),
    )
    return g.select(
        "bin",
        "n",
        F.when(ok, F.col("med")).alias("median"),
        F.when(ok, sig / F.greatest(F.abs("med"), F.lit(1e-6))).alias("cv"),
        F.when(ok, F.col("out")).alias("outlier_ratio"),
    )
