"""Traces: bottoms, calibration, ground resampling, altitude filter, picks."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.checks.base import BLANK, along, by_seq, check, r, trace, track
from soundlake.checks.scalars import CLASS_SQL
from soundlake.operators import along as T
from soundlake.operators import altitude
from soundlake.operators import trace as TR
from soundlake.plans import jobs

BOTTOM = """bt AS (SELECT line, seq, amps, CAST(list_position(amps[9:], list_max(amps[9:])) + 7 AS INTEGER) AS idx_b, list_max(amps[9:])::DOUBLE AS amp_b FROM trace)"""


@check("t5_bottom", "trace", f"WITH {BOTTOM} SELECT line, seq, idx_b, amp_b FROM bt")
def _(spark, d):
    return TR.bottom(trace(spark, d), blanking=BLANK).select("line", "seq", "idx_b", "amp_b")


def cal_sql(src: str, keys: str, least: int) -> str:
    """Mean trace, bottom, double echo and constant per segment of ``src`` (keys, amps)."""
    on = " AND ".join(f"m.{k} = b.{k}" for k in keys.split(", "))
    return f"""ex AS (SELECT {keys}, unnest(amps)::DOUBLE AS a, generate_subscripts(amps, 1) - 1 AS pos FROM {src}),
    sz AS (SELECT {keys}, count(*) AS n, max(len(amps)) AS length FROM {src} GROUP BY {keys}),
    mt AS (SELECT {keys}, pos, sum(a) / any_value(n) AS avg, any_value(n) AS n, any_value(length) AS length FROM ex JOIN sz USING ({keys}) GROUP BY {keys}, pos),
    bb AS (SELECT {keys}, arg_max(pos, (avg, -pos)) AS idx_b, max(avg) AS amp_b, any_value(n) AS n, any_value(length) AS length FROM mt WHERE pos >= 8 GROUP BY {keys}),
    ec AS (SELECT {', '.join('m.' + k for k in keys.split(', '))}, arg_max(pos, (avg, -pos)) AS idx_bsb, max(avg) AS amp_bsb FROM mt m JOIN bb b ON {on} AND pos >= CAST(floor(idx_b * 1.95) AS INT) AND pos < least(b.length, CAST(floor(idx_b * 2.1) AS INT))
       GROUP BY {', '.join('m.' + k for k in keys.split(', '))}),
    cc AS (SELECT {keys}, idx_b, amp_b, idx_bsb, amp_bsb, CASE WHEN n >= {least} AND length >= 60 AND amp_b > 0 AND amp_bsb > 0 AND amp_bsb < amp_b THEN amp_b * amp_b / amp_bsb END AS cc FROM bb LEFT JOIN ec USING ({keys}))"""


CAL = {"blanking": BLANK, "min_pings": 30, "min_samples": 60, "min_window": 1}


@check("a9_calibration", "trace", f"""WITH rg AS (SELECT line, CASE WHEN seq % 3 = 0 THEN amps[:50] ELSE amps END AS amps FROM trace), {cal_sql('rg', 'line', 30)}
    SELECT line, CAST(idx_b AS INTEGER) AS idx_b, ROUND(amp_b, 9) AS amp_b, CAST(idx_bsb AS INTEGER) AS idx_bsb, ROUND(cc, 9) AS cc FROM cc""")
def _(spark, d):
    t = trace(spark, d).withColumn("amps", F.when(F.col("seq") % 3 == 0, F.slice("amps", 1, 50)).otherwise(F.col("amps")))
    c = TR.calibration(t, ["line"], **CAL)
    return c.select("line", "idx_b", r("amp_b", 9).alias("amp_b"), "idx_bsb", r("cc", 9).alias("cc"))


FIXED = f"""{BOTTOM}, od AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY seq) AS i, count(*) OVER (PARTITION BY line) AS nn FROM bt WHERE amp_b > 0),
    sgm AS (SELECT *, (i - 1) // 8 AS seg FROM od WHERE (i - 1) // 8 < nn // 8), {cal_sql('sgm', 'line, seg', 8)},
    fx AS (SELECT line, seg, any_value(cc) AS cc, stddev_pop(log10(amp_b + 1e-12)) AS log_std FROM (SELECT s.line, s.seg, s.amp_b, cc.cc FROM sgm s JOIN cc USING (line, seg)) GROUP BY ALL)"""


def fixed(spark, d):
    return jobs.fixed_segments(trace(spark, d), by_seq(), 8, BLANK, min_pings=8, min_samples=60, min_window=1)


@check("a12_fixed_segments", "trace", f"WITH {FIXED} SELECT line, seg, ROUND(cc, 9) AS cc, ROUND(log_std, 9) AS log_std FROM fx")
def _(spark, d):
    return fixed(spark, d).select("line", "seg", r("cc", 9).alias("cc"), r("log_std", 9).alias("log_std"))


@check("a12_calibration_check", "trace", f"""WITH {FIXED}, ok AS (SELECT *, 20 * log10(cc) AS db, quantile_cont(log_std, 0.2) OVER () AS lim FROM fx WHERE cc > 0), md AS (SELECT median(amp_b) AS m FROM bt WHERE amp_b > 0)
    SELECT (SELECT count(*) FROM fx) AS n_segments, count(*) AS n_ok, ROUND(median(db), 6) AS median_all, count(*) FILTER (WHERE log_std <= lim) AS n_stable,
    CASE WHEN count(*) FILTER (WHERE log_std <= lim) > 5 THEN ROUND(median(db) FILTER (WHERE log_std <= lim), 6) END AS median_stable, ROUND(20 * log10(any_value(m) * pow(10, 14.6 / 20)), 6) AS anchor_db, ROUND(20 * log10(any_value(m) * pow(10, 14.6 / 20)) - median(db), 6) AS gap_db FROM ok, md""")
def _(spark, d):
    from soundlake.operators.stats import quantiles

    b = TR.bottom(trace(spark, d), blanking=BLANK).where("amp_b > 0")
    out = jobs.calibration_check(fixed(spark, d), quantiles(b, [], "amp_b", {"median": 0.5}))
    return out.select("n_segments", "n_ok", "n_stable", *[r(c).alias(c) for c in ("median_all", "median_stable", "anchor_db", "gap_db")])


# --- calibration segments on tracks -------------------------------------------------------------------

GROUND = """gd AS (SELECT *, v / 100 AS vrm, v / 12 AS slope, CASE WHEN seq % 9 <> 0 THEN sin(seq) * 0.32 END AS bpi, CASE WHEN seq % 17 <> 0 THEN 20 + v / 40 END AS depth FROM track),
    lm AS (SELECT quantile_cont(vrm, 0.7) AS lim FROM gd), gg AS (SELECT line, t, seq, v, depth, coalesce(vrm < lim AND slope < 6 AND abs(bpi) < 0.3 AND depth IS NOT NULL, false) AS good FROM gd, lm)"""


def ground(spark, d):
    from soundlake.operators.stats import attach, quantiles

    q, v = F.col("seq"), F.col("v")
    g = track(spark, d).withColumn("vrm", v / 100).withColumn("slope", v / 12).withColumn(
        "bpi", F.when(q % 9 != 0, F.sin(q) * 0.32)).withColumn("depth", F.when(q % 17 != 0, 20 + v / 40))
    return attach(g, quantiles(g, [], "vrm", {"_vlim": 0.7}), [])


@check("f8_good_ground", "track", f"WITH {GROUND} SELECT seq, good FROM gg")
def _(spark, d):
    return ground(spark, d).select("seq", jobs.good_ground().alias("good"))


SEGS = f"""{GROUND}, nu AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY t, seq) - 1 AS i FROM gg),
    rn AS (SELECT *, sum(CASE WHEN good THEN 0 ELSE 1 END) OVER (PARTITION BY line ORDER BY i) AS run FROM nu),
    sg AS (SELECT line, CAST(run AS BIGINT) AS run, min(i) AS "start", count(*) AS length, avg(depth) AS depth_mean, stddev_pop(depth) AS depth_std, stddev_pop(v) AS amp_std, avg(v) AS amp_mean, stddev_pop(v) / avg(v) AS amp_cv, count(v) AS n_amp FROM rn WHERE good GROUP BY line, run)"""


def segments(spark, d):
    t = T.runs_tag(ground(spark, d), along(), jobs.good_ground()).where("_flag")
    return t.groupBy("line", "run").agg(
        (F.min("ord") - 1).alias("start"), F.count("*").alias("length"), F.avg("depth").alias("depth_mean"), F.stddev_pop("depth").alias("depth_std"),
        F.stddev_pop("v").alias("amp_std"), F.avg("v").alias("amp_mean"), F.try_divide(F.stddev_pop("v"), F.avg("v")).alias("amp_cv"), F.count("v").alias("n_amp"))


@check("a8_segment_stats", "track", f"""WITH {SEGS} SELECT line, run, "start", length, ROUND(depth_mean, 6) AS depth_mean, ROUND(depth_std, 6) AS depth_std, ROUND(amp_std, 6) AS amp_std, ROUND(amp_mean, 6) AS amp_mean, ROUND(amp_cv, 6) AS amp_cv, n_amp FROM sg""")
def _(spark, d):
    return segments(spark, d).select("line", "run", "start", "length", "n_amp", *[r(c).alias(c) for c in ("depth_mean", "depth_std", "amp_std", "amp_mean", "amp_cv")])


@check("f9_accept_segment", "track", f"""WITH {SEGS} SELECT line, run FROM sg WHERE length >= 2 AND "start" >= 5 AND depth_std <= 0.5 AND n_amp >= 1 AND amp_cv <= 0.6""")
def _(spark, d):
    return segments(spark, d).where(jobs.accept_segment(2, 5, 0.5, 0.6)).select("line", "run")


# --- ground resampling ----------------------------------------------------------------------------------

GRND = """pg AS (SELECT line, seq, amps, 8.0 + seq % 3 AS alt FROM trace),
    sm AS (SELECT *, sqrt(greatest(i * i - alt * alt, 0)) AS g FROM (SELECT line, seq, alt, unnest(amps)::DOUBLE AS a, generate_subscripts(amps, 1) - 1.0::DOUBLE AS i FROM pg) WHERE i >= alt / cos(radians(15.0)) AND i <= alt / cos(radians(65.0))),
    bn AS (SELECT line, seq, CAST(b AS INTEGER) AS bin, b * 0.5::DOUBLE AS x FROM pg, (SELECT unnest(range(91)) AS b)),
    lo AS (SELECT bn.*, sm.g AS g0, sm.a AS a0 FROM bn ASOF JOIN sm ON bn.line = sm.line AND bn.seq = sm.seq AND bn.x >= sm.g),
    hi AS (SELECT lo.*, sm.g AS g1, sm.a AS a1 FROM lo ASOF JOIN sm ON lo.line = sm.line AND lo.seq = sm.seq AND lo.x <= sm.g),
    gv AS (SELECT line, seq, bin, CASE WHEN g1 = g0 THEN a0 ELSE a0 + (a1 - a0) * (x - g0) / (g1 - g0) END AS value FROM hi)"""


def ground_grid(spark, d):
    p = trace(spark, d).select("line", "seq", "amps", F.lit(1.0).alias("pix"), (F.lit(8.0) + F.col("seq") % 3).alias("alt"))
    return TR.to_ground_grid(p, "amps", "pix", "alt", F.lit(65.0), ["line", "seq"], 0.5, 45.0)


@check("g6_ground_grid", "trace", f"WITH {GRND} SELECT line, seq, bin, ROUND(value, 6) AS value FROM gv")
def _(spark, d):
    return ground_grid(spark, d).select("line", "seq", "bin", r("value").alias("value"))


G7 = f"""{GRND}, bs AS (SELECT line, seq, bin, value, 'port' AS side FROM gv UNION ALL SELECT line, seq, bin, value / 2, 'stbd' FROM gv WHERE bin > 8),
    np AS (SELECT line, count(*) AS n FROM trace GROUP BY line), pb AS (SELECT line, side, bin, count(*) AS k FROM bs GROUP BY ALL),
    fr AS (SELECT line, side, min(bin) AS first FROM pb JOIN np USING (line) WHERE k = n GROUP BY ALL),
    lay AS (SELECT line, max(first) FILTER (WHERE side = 'port') AS pf, max(first) FILTER (WHERE side = 'stbd') AS sf FROM fr GROUP BY line),
    rw AS (SELECT line, seq, side, bin, value, CASE side WHEN 'port' THEN 90 - bin ELSE 91 - pf + 4 + bin - sf END AS raw FROM bs JOIN lay USING (line) WHERE bin >= CASE side WHEN 'port' THEN pf ELSE sf END),
    ex AS (SELECT line, min(raw) AS lo, max(raw) AS hi FROM rw WHERE value > 1e-12 GROUP BY line)"""


def merged(spark, d):
    g = ground_grid(spark, d)
    both = g.withColumn("side", F.lit("port")).unionByName(
        g.where("bin > 8").withColumn("value", F.col("value") / 2).withColumn("side", F.lit("stbd")))
    n = trace(spark, d).groupBy("line").agg(F.count("*").alias("n_pings"))
    return TR.merge_sides(both, ["line"], "side", n, gap=4, bins=91)


@check("g7_waterfall_cells", "trace", f"WITH {G7} SELECT line, seq, side, CAST(raw - lo AS INTEGER) AS col, ROUND(value, 6) AS value FROM rw JOIN ex USING (line) WHERE raw BETWEEN lo AND hi")
def _(spark, d):
    return merged(spark, d)[0].select("line", "seq", "side", "col", r("value").alias("value"))


@check("g7_waterfall_layout", "trace", f"WITH {G7} SELECT line, CAST(91 - pf + 2 - lo AS INTEGER) AS nadir_col, CAST(hi - lo + 1 AS INTEGER) AS n_cols FROM lay JOIN ex USING (line)")
def _(spark, d):
    return merged(spark, d)[1].select("line", "nadir_col", "n_cols")


# --- first return, altitude filter -------------------------------------------------------------------------


@check("p1_first_return", "trace", """WITH e AS (SELECT line, seq, a, i FROM (SELECT line, seq, unnest(amps)::DOUBLE AS a, generate_subscripts(amps, 1) - 1 AS i FROM trace) WHERE i >= 6),
    w AS (SELECT x.line, x.seq, x.i, list(y.a) AS vs FROM e x JOIN e y ON x.line = y.line AND x.seq = y.seq AND abs(x.i - y.i) <= 4 GROUP BY ALL),
    m AS (SELECT line, seq, i, list_sort(list_concat(vs, list_resize([]::DOUBLE[], CAST(9 - len(vs) AS BIGINT), 0.0::DOUBLE)))[5] AS s FROM w),
    j AS (SELECT *, lead(s) OVER (PARTITION BY line, seq ORDER BY i) - s AS up, max(s) OVER (PARTITION BY line, seq) AS top FROM m)
    SELECT line, seq, ROUND(min(i) FILTER (WHERE up > top * 0.1) * 5e-1, 6) AS first_return FROM j GROUP BY ALL""")
def _(spark, d):
    t = trace(spark, d).withColumn("pix", F.lit(0.5))
    return TR.with_first_return(t, "amps", "pix", width=9).select("line", "seq", r("first_return").alias("first_return"))


KALMAN = """WITH RECURSIVE o AS (SELECT line, seq, CASE WHEN seq % 5 <> 0 THEN 20 + v / 8 END AS z, row_number() OVER (PARTITION BY line ORDER BY t, seq) AS i
      FROM (SELECT * REPLACE (CASE WHEN line % 11 = 0 THEN 100000 + seq // 40 ELSE line END AS line) FROM track)),
    md AS (SELECT line, median(z) AS m FROM o GROUP BY line HAVING count(z) >= 5),
    kf AS (SELECT line, 0::BIGINT AS i, m AS x, 10.0::DOUBLE AS p, false AS hit FROM md UNION ALL
      SELECT s.line, s.i, CASE WHEN h THEN x + (p + 0.01) / (p + 9.01) * (z - x) ELSE x END,
        CASE WHEN h THEN pow(1 - (p + 0.01) / (p + 9.01), 2) * (p + 0.01) + pow((p + 0.01) / (p + 9.01), 2) * 9 ELSE p + 0.01 END, h
      FROM (SELECT k.line, k.x, k.p, o.z, o.i, coalesce(abs(o.z - k.x) / sqrt(k.p + 9.01) < 3, false) AS h FROM kf k JOIN o ON o.line = k.line AND o.i = k.i + 1) s)
    SELECT o.line, o.seq, ROUND(CASE WHEN md.line IS NULL THEN o.z {pick} END, 6) AS alt FROM o LEFT JOIN md ON o.line = md.line LEFT JOIN kf ON kf.line = o.line AND kf.i = o.i"""


def observed(spark, d):
    short = F.when(F.col("line") % 11 == 0, 100000 + F.floor(F.col("seq") / 40)).otherwise(F.col("line"))  # lines of a few records
    return track(spark, d).withColumn("line", short).withColumn("z", F.when(F.col("seq") % 5 != 0, 20 + F.col("v") / 8))


@check("p2_gated_filter", "track", KALMAN.replace("{pick}", "WHEN kf.hit THEN kf.x"))
def _(spark, d):
    return altitude.smooth(observed(spark, d), along(), "z", chunk=40, out="alt").select("line", "seq", r("alt").alias("alt"))


@check("p2b_gated_filter_carry", "track", KALMAN.replace("{pick}", "ELSE kf.x"))
def _(spark, d):
    return altitude.smooth(observed(spark, d), along(), "z", carry=True, chunk=40, out="alt").select("line", "seq", r("alt").alias("alt"))


# --- picks --------------------------------------------------------------------------------------------------

WIDE_SAMPLE = 93333  # nanoseconds: 64 samples then span about four metres


def loud(spark, d):
    return trace(spark, d).withColumn("amps", F.transform("amps", lambda x: (x.cast("double") * x * x * 100000 + 1).cast("float")))


LOUD = """tr AS (SELECT line, seq, list_transform(amps, lambda x: (x::DOUBLE * x * x * 100000 + 1)::FLOAT) AS amps FROM trace),
    bo AS (SELECT line, seq, amps, CAST(list_position(amps[{least} + 1:], list_max(amps[{least} + 1:])) + {least} - 1 AS INTEGER) AS idx_b, list_max(amps[{least} + 1:])::DOUBLE AS amp_b FROM tr)"""

# The imaginary part of the analytic signal is a circular convolution, with one kernel for even lengths and another for odd ones.
HILBERT = """ns AS (SELECT DISTINCT n FROM sp), hk AS (SELECT n, j, CASE WHEN j = 0 THEN 0 WHEN n % 2 = 1 THEN (1 / tan(pi() * j / n) - cos(pi() * j) / sin(pi() * j / n)) / n
      WHEN j % 2 = 1 THEN 2 / tan(pi() * j / n) / n ELSE 0 END AS h FROM (SELECT n, unnest(range(n)) AS j FROM ns)),
    en AS (SELECT x.line, x.seq, x.n, x.i, sqrt(pow(any_value(x.a), 2) + pow(sum(y.a * h), 2)) AS e FROM sp x JOIN sp y ON x.line = y.line AND x.seq = y.seq JOIN hk ON hk.n = x.n AND j = (x.i - y.i + x.n) % x.n
      GROUP BY ALL),
    lv AS (SELECT *, 20 * log10(greatest(e, 1.0)) AS db FROM en)"""


def pick_sql(strict: bool, speed: str) -> str:
    """Peak by peak, with correlated subqueries; the spacing never binds, as the blind zone is at most two samples here."""
    value = "db - regr_slope(db, i) OVER w * i - regr_intercept(db, i) OVER w" if strict else "db"
    fine = "prom >= 5 * noise AND noise >= 1e-6 AND width >= 3" if strict else "prom >= 3 AND width >= 2"
    near = lambda agg, test: f"(SELECT {agg} FROM dv y WHERE y.line = p.line AND y.seq = p.seq AND {test})"
    return f"""dz AS (SELECT *, {WIDE_SAMPLE}::DOUBLE * 1e-9 * vp / 2 AS dz FROM (SELECT *, {speed} AS vp FROM bo)),
    wi AS (SELECT *, idx_b + CAST(floor({K.BLIND_ZONE_M} / dz) AS INT) AS lo, least(len(amps), idx_b + CAST(floor({K.MAX_DEPTH_M} / dz) AS INT)) AS hi FROM dz),
    sp AS (SELECT line, seq, hi - lo AS n, unnest(amps[lo + 1:hi])::DOUBLE AS a, unnest(range(hi - lo)) AS i FROM wi WHERE hi - lo >= 10), {HILBERT},
    de AS (SELECT line, seq, n, i, db, {value} AS v FROM lv WINDOW w AS (PARTITION BY line, seq)),
    me AS (SELECT *, median(v) OVER (PARTITION BY line, seq) AS med FROM de), dv AS (SELECT *, 1.4826 * median(abs(v - med)) OVER (PARTITION BY line, seq) AS noise FROM me),
    ex AS (SELECT * FROM (SELECT *, lag(v) OVER w AS l, lead(v) OVER w AS r FROM dv WINDOW w AS (PARTITION BY line, seq ORDER BY i)) WHERE v > l AND v > r {'' if strict else 'AND v >= med + 5'}),
    bd AS (SELECT p.*, coalesce({near('max(y.i)', 'y.i < p.i AND y.v > p.v')} + 1, 0) AS first, coalesce({near('min(y.i)', 'y.i > p.i AND y.v > p.v')} - 1, n - 1) AS last FROM ex p),
    pr AS (SELECT p.*, v - greatest({near('min(y.v)', 'y.i BETWEEN p.first AND p.i')}, {near('min(y.v)', 'y.i BETWEEN p.i AND p.last')}) AS prom FROM bd p),
    cr AS (SELECT p.*, v - prom / 2 AS level, coalesce({near('max(y.i)', 'y.i BETWEEN p.first AND p.i AND y.v <= p.v - p.prom / 2')}, first) AS a, coalesce({near('min(y.i)', 'y.i BETWEEN p.i AND p.last AND y.v <= p.v - p.prom / 2')}, last) AS b FROM pr p),
    ab AS (SELECT p.*, {near('any_value(y.v)', 'y.i = p.a')} AS va, {near('any_value(y.v)', 'y.i = p.a + 1')} AS va1, {near('any_value(y.v)', 'y.i = p.b')} AS vb, {near('any_value(y.v)', 'y.i = p.b - 1')} AS vb1 FROM cr p),
    wd AS (SELECT *, b - CASE WHEN vb < level THEN (level - vb) / (vb1 - vb) ELSE 0 END - a - CASE WHEN va < level THEN (level - va) / (va1 - va) ELSE 0 END AS width FROM ab),
    rk AS (SELECT *, row_number() OVER w AS k, score - lead(score) OVER w AS ahead FROM (SELECT *, {'prom' if strict else 'prom * v'} AS score FROM wd WHERE {fine}) WINDOW w AS (PARTITION BY line, seq ORDER BY score DESC, i)),
    pk AS (SELECT rk.line, rk.seq, (lo + i - idx_b) * dz AS thickness, {'prom / noise' if strict else 'NULL::DOUBLE'} AS snr, prom AS prominence FROM rk JOIN wi ON wi.line = rk.line AND wi.seq = rk.seq
      WHERE k = 1 {'AND coalesce(ahead >= 3, true)' if strict else ''} AND abs((lo + i - idx_b) * dz - {K.DRAFT_M}) >= {K.MULTIPLE_M})"""


@check("p3_strict_picks", "trace", f"""WITH {LOUD.format(least=2)}, {pick_sql(True, '1500.0::DOUBLE')}
    SELECT line, seq, ROUND(thickness, 6) AS thickness, ROUND(snr, 6) AS snr, ROUND(prominence, 6) AS prominence FROM pk""")
def _(spark, d):
    t = TR.bottom(loud(spark, d), blanking=2).withColumn("vp", F.lit(1500.0))
    p = TR.pick_reflector(t, ["line", "seq"], strict=True, sample_ns=WIDE_SAMPLE)
    return p.select("line", "seq", *[r(c).alias(c) for c in ("thickness", "snr", "prominence")])


@check("p4_lenient_picks", "trace", f"""WITH {LOUD.format(least=2)}, {pick_sql(False, '1500.0::DOUBLE')}
    SELECT line, seq, ROUND(thickness, 6) AS thickness, ROUND(prominence, 6) AS prominence FROM pk""")
def _(spark, d):
    t = TR.bottom(loud(spark, d), blanking=2).withColumn("vp", F.lit(1500.0))
    p = TR.pick_reflector(t, ["line", "seq"], strict=False, sample_ns=WIDE_SAMPLE)
    return p.select("line", "seq", r("thickness").alias("thickness"), r("prominence").alias("prominence"))


@check("p5_envelope", "trace", f"""WITH {LOUD.format(least=BLANK)}, sp AS (SELECT line, seq, len(amps) AS n, unnest(amps)::DOUBLE AS a, unnest(range(len(amps))) AS i FROM tr), {HILBERT},
    bb AS (SELECT line, seq, any_value(n) AS n, max(db) AS top, min(db) - max(db) AS db_min, sum(db) - any_value(n) * max(db) AS db_sum, arg_max(i, (e, -i)) FILTER (WHERE i >= {BLANK}) AS idx_b FROM lv GROUP BY ALL),
    lh AS (SELECT *, CAST(floor(idx_b * 1.95) AS INTEGER) AS lo, CAST(floor(idx_b * 2.1) AS INTEGER) AS hi FROM bb),
    ec AS (SELECT lh.line, lh.seq, arg_max(i, (e, -i)) AS idx FROM lh JOIN lv ON lv.line = lh.line AND lv.seq = lh.seq AND i >= lo AND i < hi WHERE hi < lh.n GROUP BY ALL)
    SELECT lh.line, lh.seq, CAST(idx_b AS INTEGER) AS idx_b, CAST(coalesce(idx, lo) AS INTEGER) AS idx_bsb, ROUND(db_min, 6) AS db_min, ROUND(db_sum, 4) AS db_sum FROM lh LEFT JOIN ec ON ec.line = lh.line AND ec.seq = lh.seq""")
def _(spark, d):
    e = TR.envelope_db(loud(spark, d), ["line", "seq"], blanking=BLANK)
    return e.select("line", "seq", "idx_b", "idx_bsb", r(F.array_min("env_db")).alias("db_min"), r(F.aggregate("env_db", F.lit(0.0), lambda a, x: a + x), 4).alias("db_sum"))


SPEED = f"""CASE {CLASS_SQL.replace("rl", "least(greatest(-20 * log10(amp_b / 2.0e4), 0.0), 50.0)")} WHEN 0 THEN 1776.0 WHEN 1 THEN 1660.5 WHEN 2 THEN 1627.5
    WHEN 3 THEN 1590.0 WHEN 4 THEN 1545.0 WHEN 5 THEN 1480.0 WHEN 6 THEN 1444.0 ELSE 1489.073 END::DOUBLE"""


@check("p6_thickness_picks", "trace", f"""WITH {LOUD.format(least=2)}, {pick_sql(False, SPEED)}
    SELECT line, seq, ROUND(thickness, 6) AS thickness FROM pk WHERE thickness BETWEEN {K.THICK_MIN} AND {K.THICK_MAX}""")
def _(spark, d):
    p = TR.thickness_picks(loud(spark, d), ["line", "seq"], 2.0e4, blanking=2, min_samples=60, sample_ns=WIDE_SAMPLE, strict=False)
    return p.select("line", "seq", r("thickness").alias("thickness"))
