"""Group statistics and radiometry on the sample table."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.checks.base import SAMPLE_GRID, SAMPLE_TIE, check, r, r5, raster, sample, sql5, table, track
from soundlake.functions import acoustic as A
from soundlake.operators import cube, mosaic
from soundlake.operators import radiometry as R
from soundlake.operators import stats as S
from soundlake.operators.lineage import cut, scratch
from soundlake.operators.stats import attach
from soundlake.plans import jobs

GAIN = """g AS (SELECT *, quantile_cont(bs, 0.4) OVER (PARTITION BY line, channel) AS ref, count(*) OVER (PARTITION BY line, channel) AS n FROM sample),
    gn AS (SELECT *, CASE WHEN n >= 100 AND ref > 0 THEN bs / ref ELSE bs END AS lin FROM g)"""
BEST = """b AS (SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY abs(angle - 45), ping, num, part, line, bs) AS k FROM {src} WHERE {db} IS NOT NULL)"""


@check("a1_gain_norm", "sample", f"WITH {GAIN} SELECT ping, num, part, line, bs, ROUND(lin, 6) AS lin FROM gn")
def _(spark, d):
    g = R.normalise_gain(sample(spark, d), ["line", "channel"], "bs", "lin")
    return g.select("ping", "num", "part", "line", "bs", r("lin").alias("lin"))


@check("a1b_agc_norm", "sample", """WITH s AS (SELECT *, bs - 30000 AS a FROM sample),
    q AS (SELECT line, quantile_cont(a, 0.4) AS ref FROM s WHERE a > 0 GROUP BY line)
    SELECT ping, num, part, s.line, bs, ROUND(a / greatest(ref, 1e-6), 6) AS lin FROM s LEFT JOIN q ON s.line = q.line""")
def _(spark, d):
    s = sample(spark, d).withColumn("a", F.col("bs") - 30000)
    return R.normalise_agc(s, ["line"], "a", "lin").select("ping", "num", "part", "line", "bs", r("lin").alias("lin"))


@check("a2_altitude_correct", "sample", f"""WITH k AS (SELECT median(altitude) AS h0, quantile_cont(bs, 0.995) FILTER (WHERE bs > 0) AS top FROM sample)
    SELECT ping, num, part, line, bs, {sql5('least(bs, top) * least(greatest(h0 / altitude, 0.5), 2.0)', 3)} AS lin FROM sample, k""")
def _(spark, d):
    s = R.correct_altitude(sample(spark, d), "bs", "altitude", "lin")
    return s.select("ping", "num", "part", "line", "bs", r5("lin", 3).alias("lin"))


WF = """w AS (SELECT ping, CAST(floor(angle - 20) AS INTEGER) AS bin, median(10 * log10(bs)) AS bs FROM sample WHERE angle >= 20 AND angle < 70 GROUP BY ALL)"""
ZS = WF + """, m AS (SELECT *, median(bs) OVER (PARTITION BY bin) AS med, count(*) OVER (PARTITION BY bin) AS n FROM w),
    a AS (SELECT *, median(abs(bs - med)) OVER (PARTITION BY bin) AS mad FROM m),
    z AS (SELECT ping, bin, bs, CASE WHEN n >= 10 AND mad >= 1e-6 THEN (bs - med) / (1.4826 * mad) END AS z FROM a)"""


def falls(spark, d):
    s = sample(spark, d).withColumn("db", A.to_db(F.col("bs")))
    return R.waterfall(s, ["ping"], "db", "angle")


@check("a3_waterfall", "sample", f"WITH {WF} SELECT ping, bin, ROUND(bs, 6) AS bs FROM w")
def _(spark, d):
    return falls(spark, d).select("ping", "bin", r("bs").alias("bs"))


@check("a3_ping_waterfall", "sample", f"WITH {WF} SELECT ping, bin, ROUND(bs, 6) AS bs FROM w")
def _(spark, d):
    """Pings that hold their samples as arrays, as they come from the files."""
    both = F.collect_list(F.struct("angle", A.to_db(F.col("bs")).alias("db")))
    pings = sample(spark, d).groupBy("ping").agg(both.alias("s")).select("ping", F.col("s.angle").alias("angle"), F.col("s.db").alias("db"))
    return R.ping_waterfall(pings, ["ping"], "db", "angle").select("ping", "bin", r("bs").alias("bs"))


@check("a4_robust_z", "sample", f"WITH {ZS} SELECT ping, bin, ROUND(z, 6) AS z FROM z")
def _(spark, d):
    return R.robust_z(falls(spark, d)).select("ping", "bin", r("z").alias("z"))


CURVE = """wl AS (SELECT ping, CASE WHEN bin % 7 = 3 AND ping % 90 <> 1 THEN bin + 1 ELSE bin END AS bin, bs, CAST(ping % 4 AS INTEGER) - 1 AS label FROM w),
    p AS (SELECT label, bin, avg(bs) AS m, count(*) AS n FROM wl WHERE label >= 0 GROUP BY label, bin HAVING count(*) >= 5),
    i AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY bin) AS i, count(*) OVER (PARTITION BY label) AS k FROM p),
    c AS (SELECT x.label, x.bin, avg(y.m) AS curve FROM (SELECT *, unnest([-2, -1, 0, 1, 2]) AS o FROM i) x JOIN i y ON x.label = y.label AND x.k >= 3 AND
      y.i = CASE WHEN x.i + o < 1 THEN 1 - (x.i + o) WHEN x.i + o > x.k THEN 2 * x.k + 1 - (x.i + o) ELSE x.i + o END GROUP BY ALL),
    cv AS (SELECT *, avg(curve) OVER (PARTITION BY label) AS level FROM c)"""


def curves(spark, d):
    w = falls(spark, d).withColumn("label", (F.col("ping") % 4).cast("int") - 1)
    w = w.withColumn("bin", F.when((F.col("bin") % 7 == 3) & (F.col("ping") % 90 != 1), F.col("bin") + 1).otherwise(F.col("bin")))  # leaves thin bins
    return R.response_curves(w, "label")


@check("a5_response_curve", "sample", f"WITH {WF}, {CURVE} SELECT label, bin, ROUND(curve, 6) AS curve, ROUND(level, 6) AS level FROM cv")
def _(spark, d):
    return curves(spark, d).select("label", "bin", r("curve").alias("curve"), r("level").alias("level"))


@check("x9_apply_curve", "sample", f"""WITH {WF}, {CURVE}, s AS (SELECT *, 10 * log10(bs) AS db, CAST(ping % 4 AS INTEGER) - 1 AS label, angle + (num % 10) / 10.0::DOUBLE AS ang FROM sample),
    e AS (SELECT label, bin + 20.5 AS a, curve AS v, level, lead(bin + 20.5) OVER w AS na, lead(curve) OVER w AS nv, lag(bin) OVER w IS NULL AS first FROM cv WINDOW w AS (PARTITION BY label ORDER BY bin)),
    j AS (SELECT s.*, e.a, e.v, e.na, e.nv, e.level FROM s LEFT JOIN e ON s.label = e.label AND (s.ang >= e.a AND (e.na IS NULL OR s.ang < e.na) OR (e.first AND s.ang < e.a)))
    SELECT ping, num, part, line, bs, ROUND(coalesce(db - CASE WHEN ang < a OR na IS NULL THEN v ELSE v + (nv - v) * (ang - a) / (na - a) END + level, db), 6) AS corr FROM j""")
def _(spark, d):
    s = sample(spark, d).withColumn("db", A.to_db(F.col("bs"))).withColumn("label", (F.col("ping") % 4).cast("int") - 1)
    s = s.withColumn("ang", F.col("angle") + F.col("num") % 10 / 10.0)
    out = R.apply_curves(s, curves(spark, d), "label", "db", "ang", "corr")
    return out.select("ping", "num", "part", "line", "bs", r("corr").alias("corr"))


@check("a6_angle_diagnostics", "sample", """WITH g AS (SELECT CASE WHEN angle >= 60 AND ping % 50 <> 0 THEN angle - 10 ELSE angle END AS angle, bs FROM sample),
    s AS (SELECT CAST(floor(angle - 15) AS INTEGER) AS bin, 10 * log10(bs) AS db FROM g WHERE angle >= 15 AND angle < 80),
    m AS (SELECT *, median(db) OVER (PARTITION BY bin) AS med FROM s), a AS (SELECT *, median(abs(db - med)) OVER (PARTITION BY bin) AS mad FROM m)
    SELECT bin, count(*) AS n, CASE WHEN count(*) >= 100 THEN ROUND(max(med), 6) END AS median, CASE WHEN count(*) >= 100 THEN ROUND(1.4826 * max(mad) / greatest(abs(max(med)), 1e-6), 6) END AS cv,
    CASE WHEN count(*) >= 100 THEN ROUND(avg(CASE WHEN abs((db - med) / greatest(1.4826 * mad, 1e-6)) > 3 THEN 1.0 ELSE 0.0 END), 6) END AS outlier_ratio FROM a GROUP BY bin""")
def _(spark, d):
    few = (F.col("angle") >= 60) & (F.col("ping") % 50 != 0)  # leaves thin bins at the far end
    s = sample(spark, d).withColumn("db", A.to_db(F.col("bs"))).withColumn("angle", F.when(few, F.col("angle") - 10).otherwise(F.col("angle")))
    out = R.angle_diagnostics(s, "db", "angle")
    return out.select("bin", "n", *[r(c).alias(c) for c in ("median", "cv", "outlier_ratio")])


@check("a10_bootstrap", "", """WITH s AS (SELECT c_custkey AS id, c_acctbal AS v, row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer),
    dr AS (SELECT r, s.i AS j, n, (((r * 2000003 + s.i * 7919 + 42) % 2147483647 * 48271 % 2147483647) * 48271 + 12345) % 2147483647 % n AS i FROM s, (SELECT unnest(range(2000)) AS r)),
    md AS (SELECT r, median(s.v) AS m FROM dr JOIN s ON dr.i = s.i GROUP BY r)
    SELECT (SELECT count(*) FROM s) AS n, (SELECT ROUND(stddev_pop(v), 6) FROM s) AS std, (SELECT ROUND(median(v), 6) FROM s) AS median,
      (SELECT ROUND(quantile_cont(m, 0.025), 6) FROM md) AS ci_lo, (SELECT ROUND(quantile_cont(m, 0.975), 6) FROM md) AS ci_hi""")
def _(spark, d):
    from soundlake.operators.along import Track

    # One row per calibration segment; here every customer's account.
    c = table(spark, d, "customer").select(F.lit(0).alias("g"), F.col("c_custkey").alias("id"), "c_acctbal")
    out = S.bootstrap_median(c, "c_acctbal", Track(("g",), ("id",), F.floor(F.col("id") / 500)))
    return out.select("n", *[r(x).alias(x) for x in ("std", "median", "ci_lo", "ci_hi")])


@check("a11_unimodality", "sample", """WITH v AS (SELECT ROUND(log10(bs), 3) AS v FROM sample), c AS (SELECT v, count(*) AS c FROM v GROUP BY v),
    k AS (SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 999 AS dx, stddev_samp(v) * pow(count(*), -0.2) AS bw FROM v),
    d AS (SELECT i, lo + i * dx AS x, sum(c * exp(-0.5 * pow((lo + i * dx - v) / bw, 2))) / any_value(n * bw * sqrt(2 * pi())) AS y FROM c, k, (SELECT unnest(range(1000)) AS i) GROUP BY ALL),
    p AS (SELECT *, lag(y) OVER (ORDER BY i) AS l, lead(y) OVER (ORDER BY i) AS r, max(y) OVER () AS top FROM d)
    SELECT CAST(count(CASE WHEN y > l AND y > r AND y >= 0.3 * top THEN 1 END) AS BIGINT) AS n_modes, ROUND(arg_max(x, y), 6) AS mode, (SELECT ROUND(median(v), 6) FROM v) AS median,
    (SELECT n FROM k) AS n, ROUND(20 * ((SELECT median(v) FROM v) - arg_max(x, y)), 6) AS gap_db FROM p""")
def _(spark, d):
    s = sample(spark, d).withColumn("lv", F.round(F.log10("bs"), 3))
    out = S.unimodality(s, "lv")
    return out.select("n_modes", r("mode").alias("mode"), r("median").alias("median"), "n", r("gap_db").alias("gap_db"))


LAYERS = """l AS (SELECT "row", col, 'depth' AS layer, z AS value FROM raster UNION ALL SELECT "row", col, 'bs', z * 3 - col FROM raster WHERE col % 3 <> 0)"""


def layers(spark, d):
    g = raster(spark, d)
    a = g.select("row", "col", F.lit("depth").alias("layer"), F.col("z").alias("value"))
    b = g.where("col % 3 <> 0").select("row", "col", F.lit("bs").alias("layer"), (F.col("z") * 3 - F.col("col")).alias("value"))
    return a.unionByName(b)


@check("a14_layer_stats", "raster", f"""WITH {LAYERS} SELECT layer, count(*) AS n_valid, ROUND(min(value), 6) AS vmin, ROUND(max(value), 6) AS vmax, ROUND(avg(value), 6) AS vmean,
    ROUND(stddev_pop(value), 6) AS vstd, ROUND(median(value), 6) AS vmedian, ROUND(100.0 * count(*) / (SELECT count(*) FROM orders), 6) AS coverage FROM l GROUP BY layer""")
def _(spark, d):
    total = table(spark, d, "orders").count()
    out = S.summary(layers(spark, d), ["layer"], "value", F.lit(total))
    return out.select("layer", "n_valid", *[r(c).alias(c) for c in ("vmin", "vmax", "vmean", "vstd", "vmedian", "coverage")])


@check("a15_display_range", "raster", f"""WITH {LAYERS} SELECT layer, 'default' AS kind, ROUND(quantile_cont(value, 0.02), 6) AS lo, ROUND(quantile_cont(value, 0.98), 6) AS hi FROM l GROUP BY layer
    UNION ALL SELECT layer, 'depth', ROUND(quantile_cont(value, 0.01), 6), ROUND(quantile_cont(value, 0.99), 6) FROM l GROUP BY layer
    UNION ALL SELECT layer, 'trace', ROUND(quantile_cont(value, 0.02), 6), ROUND(quantile_cont(value, 0.95), 6) FROM l GROUP BY layer
    UNION ALL SELECT layer, 'thickness', ROUND(quantile_cont(value, 0.1), 6), ROUND(quantile_cont(value, 0.9), 6) FROM l GROUP BY layer
    UNION ALL SELECT layer, 'signed', ROUND(-quantile_cont(abs(value), 0.98), 6), ROUND(quantile_cont(abs(value), 0.98), 6) FROM l GROUP BY layer""")
def _(spark, d):
    src, out = layers(spark, d), None
    for kind in ("default", "depth", "trace", "thickness", "signed"):
        q = cube.display_range(src, ["layer"], "value", kind).select("layer", F.lit(kind).alias("kind"), r("lo").alias("lo"), r("hi").alias("hi"))
        out = q if out is None else out.unionByName(q)
    return out


@check("a16_class_shares", "sample", "SELECT CAST(floor(angle / 10) AS INTEGER) AS cls, count(*) AS n, ROUND(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM sample GROUP BY 1")
def _(spark, d):
    s = sample(spark, d).withColumn("cls", F.floor(F.col("angle") / 10).cast("int"))
    return S.shares(s, "cls").select("cls", "n", r("pct").alias("pct"))


@check("a18_altitude_summary", "track", """SELECT line, channel, count(*) AS pings, ROUND(min(a), 6) AS alt_min, ROUND(max(a), 6) AS alt_max, ROUND(median(a), 6) AS alt_median
    FROM (SELECT *, CASE WHEN seq % 4 <> 0 THEN v END AS a FROM track) GROUP BY ALL""")
def _(spark, d):
    t = track(spark, d).withColumn("a", F.when(F.col("seq") % 4 != 0, F.col("v")))
    out = jobs.altitude_summary(t, ["line", "channel"], "a")
    return out.select("line", "channel", "pings", *[r(c).alias(c) for c in ("alt_min", "alt_max", "alt_median")])


@check("a19_gain_report", "sample", """WITH g AS (SELECT quantile_cont(bs, 0.4) AS ref FROM sample GROUP BY line, channel)
    SELECT ROUND(quantile_cont(ref, 0.05), 4) AS p5, ROUND(median(ref), 4) AS median, ROUND(quantile_cont(ref, 0.95), 4) AS p95, count(*) AS n_groups, ROUND(max(ref) / min(ref), 6) AS ratio FROM g""")
def _(spark, d):
    out = R.gain_report(R.gain_references(sample(spark, d), ["line", "channel"], "bs"))
    return out.select(r("p5", 4).alias("p5"), r("median", 4).alias("median"), r("p95", 4).alias("p95"), "n_groups", r("ratio").alias("ratio"))


@check("a19_sample_percentiles", "sample", """SELECT ROUND(quantile_cont(bs, 0.01), 6) AS p1, ROUND(quantile_cont(bs, 0.05), 6) AS p5, ROUND(quantile_cont(bs, 0.5), 6) AS p50,
    ROUND(quantile_cont(bs, 0.95), 6) AS p95, ROUND(quantile_cont(bs, 0.99), 6) AS p99 FROM sample""")
def _(spark, d):
    q = S.quantiles(sample(spark, d), [], "bs", {f"p{p}": p / 100 for p in (1, 5, 50, 95, 99)})
    return q.select(*[r(c).alias(c) for c in q.columns])


BEST_SQL = "WITH " + BEST.format(src="sample", db="CASE WHEN bs > 10000 THEN bs END") + """
    SELECT "row", col, bs AS db, CAST(num AS INTEGER) AS label, ROUND(exp(-pow((angle - 45) / 12, 2)), 9) AS weight FROM b WHERE k = 1"""


@check("t1_best_sample", "sample", BEST_SQL)
def _(spark, d):
    s = sample(spark, d).withColumn("db", F.when(F.col("bs") > 10000, F.col("bs")))
    b = mosaic.best_sample(s, SAMPLE_GRID, "db", "angle", "num", SAMPLE_TIE)
    return b.select("row", "col", "db", "label", r("weight", 9).alias("weight"))


@check("t1_growing_mosaic", "sample", BEST_SQL)
def _(spark, d):
    """Lines added in four goes, the second of them twice, to a stored mosaic."""
    s = sample(spark, d).withColumn("db", F.when(F.col("bs") > 10000, F.col("bs")))
    path = scratch(spark, "mosaic")
    for i in (2, 0, 3, 0, 1):
        mosaic.add_samples(path, s.where(F.col("line") % 4 == i), SAMPLE_GRID, "db", "angle", "num", SAMPLE_TIE, bits=4)
    return mosaic.stored_winners(spark, path).select("row", "col", "db", "label", r("weight", 9).alias("weight"))


def winners(spark, d):
    g = R.normalise_gain(sample(spark, d), ["line", "channel"], "bs", "lin").withColumn("db", A.to_db(F.col("lin")))
    return mosaic.best_sample(g, SAMPLE_GRID, "db", "angle", "num", SAMPLE_TIE)


FLAG = f"WITH {GAIN}, dbs AS (SELECT * REPLACE (lin AS lin), 10 * log10(lin) AS db FROM gn WHERE lin > 1e-12), " + BEST.format(src="dbs", db="db")


@check("g8_mosaic_flagship", "sample", FLAG + """, q AS (SELECT * FROM b WHERE k = 1)
    SELECT 'bs' AS layer, count(*) AS n_valid, ROUND(min(db), 6) AS vmin, ROUND(max(db), 6) AS vmax, ROUND(avg(db), 6) AS vmean, ROUND(stddev_pop(db), 6) AS vstd,
    ROUND(median(db), 6) AS vmedian, ROUND(100.0 * count(*) / 3200, 6) AS coverage FROM q""")
def _(spark, d):
    w = cut(winners(spark, d), "mosaic").withColumn("layer", F.lit("bs"))
    out = S.summary(w, ["layer"], "db", F.lit(SAMPLE_GRID.nrows * SAMPLE_GRID.ncols))
    return out.select("layer", "n_valid", *[r(c).alias(c) for c in ("vmin", "vmax", "vmean", "vstd", "vmedian", "coverage")])


@check("g8_mosaic_cells", "sample", FLAG + """ SELECT "row", col, ROUND(db, 6) AS db, num AS label FROM b WHERE k = 1""")
def _(spark, d):
    return winners(spark, d).select("row", "col", r("db").alias("db"), "label")


@check("g8_mosaic_filled", "sample", "WITH " + BEST.format(src="sample", db="CASE WHEN angle BETWEEN 43 AND 47 THEN bs END") + """,
    dep AS (SELECT r AS "row", c AS col FROM (SELECT unnest(range(64)) AS r), (SELECT unnest(range(50)) AS c) WHERE (r * 50 + c) % 13 <> 0),
    kn AS (SELECT b."row", b.col, bs AS db, num FROM b JOIN dep USING ("row", col) WHERE k = 1),
    ho AS (SELECT * FROM dep ANTI JOIN kn USING ("row", col)),
    pr AS (SELECT h."row", h.col, kn.db, kn.num, pow(kn.col - h.col, 2) + pow(kn."row" - h."row", 2) AS d2,
      row_number() OVER (PARTITION BY h."row", h.col ORDER BY pow(kn.col - h.col, 2) + pow(kn."row" - h."row", 2), kn."row", kn.col) AS k FROM ho h JOIN kn ON abs(kn."row" - h."row") <= 3 AND abs(kn.col - h.col) <= 3),
    fi AS (SELECT "row", col, sum(db / (d2 + 1e-6)) FILTER (WHERE k <= 4 AND d2 < 2.25) / sum(1 / (d2 + 1e-6)) FILTER (WHERE k <= 4 AND d2 < 2.25) AS db, max(num) FILTER (WHERE k = 1 AND d2 < 5.0625) AS label FROM pr GROUP BY ALL)
    SELECT dep."row"::INTEGER AS "row", dep.col::INTEGER AS col, ROUND(coalesce(kn.db, fi.db), 4) AS db, coalesce(kn.num, fi.label) AS label, CASE WHEN kn.db IS NULL THEN 0.0::DOUBLE ELSE ROUND(w, 9) END AS confidence
    FROM dep LEFT JOIN (SELECT kn.*, exp(-pow((angle - 45) / 12, 2)) AS w FROM kn JOIN b ON b."row" = kn."row" AND b.col = kn.col AND b.k = 1) kn USING ("row", col) LEFT JOIN fi USING ("row", col)""")
def _(spark, d):
    s = sample(spark, d).withColumn("db", F.when(F.col("angle").between(43, 47), F.col("bs")))
    dep = SAMPLE_GRID.cells(spark).where((F.col("row") * 50 + F.col("col")) % 13 != 0)
    m = mosaic.mosaic(s, SAMPLE_GRID, dep, "db", "angle", "num", SAMPLE_TIE)
    return m.select("row", "col", r("db", 4).alias("db"), "label", r("confidence", 9).alias("confidence"))


@check("u_quantile_hot_group", "", """SELECT ROUND(quantile_cont(CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_extendedprice END, 0.25), 6) AS q25,
    ROUND(quantile_cont(CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE -l_extendedprice END, 0.5), 6) AS q50 FROM lineitem""")
def _(spark, d):
    li = table(spark, d, "lineitem")
    hot = F.col("l_orderkey") % 3 == 0
    a = li.select(F.when(hot, 1.0).otherwise(F.col("l_extendedprice")).alias("v"), F.when(hot, 1.0).otherwise(-F.col("l_extendedprice")).alias("w"))
    q = attach(S.quantiles(a, [], "v", {"q25": 0.25}), S.quantiles(a, [], "w", {"q50": 0.5}), [])
    return q.select(r("q25").alias("q25"), r("q50").alias("q50"))


