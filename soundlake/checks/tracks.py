"""As-of joins, windows along a track, sort and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.checks.base import THREE_DAYS, along, check, r, sample, spot, table, track
from soundlake.functions.geo import flat_spacing
from soundlake.operators import along as T
from soundlake.operators import cube
from soundlake.operators.along import every
from soundlake.operators.stats import attach
from soundlake.operators.targets import greedy_thin, rank_targets

# --- as-of joins ------------------------------------------------------------------------------------

NEIGHBOURS = """WITH k AS (SELECT line, t, {vals} FROM track WHERE channel = 'view'),
    q AS (SELECT line, seq, t FROM track WHERE channel = 'click'),
    c AS (SELECT line, count(*) AS n FROM k GROUP BY line),
    a AS (SELECT q.*, k.t AS pt, {pv} FROM q ASOF LEFT JOIN k ON q.line = k.line AND q.t >= k.t),
    b AS (SELECT a.*, k.t AS nt, {nv} FROM a ASOF LEFT JOIN k ON a.line = k.line AND a.t <= k.t),
    e AS (SELECT b.*, c.n FROM b LEFT JOIN c ON b.line = c.line)"""


def asof(*cols: str) -> str:
    def side(p: str) -> str:
        return ", ".join(f"k.{c} AS {p}{c}" for c in cols)

    return NEIGHBOURS.replace("{pv}", side("p")).replace("{nv}", side("n"))


def lerp(c: str) -> str:
    return f"CASE WHEN pt = t THEN p{c} WHEN pt IS NOT NULL AND nt IS NOT NULL THEN p{c} + (n{c} - p{c}) * (t - pt) / (nt - pt) END"


def split(spark, d):
    t = track(spark, d)
    return t.where("channel = 'click'").select("line", "seq", "t"), t.where("channel = 'view'")


@check("j1_asof_lerp", "track", asof("v", "roll").replace("{vals}", "v, roll") + f"""
    SELECT line, seq, ROUND(CASE WHEN n >= 2 THEN {lerp('v')} END, 6) AS v, ROUND(CASE WHEN n >= 2 THEN {lerp('roll')} END, 6) AS roll FROM e""")
def _(spark, d):
    q, k = split(spark, d)
    out = T.interpolate(q, k, ["line"], "t", ["v", "roll"], every(THREE_DAYS))
    return out.select("line", "seq", r("v").alias("v"), r("roll").alias("roll"))


@check("j1b_heading_lerp", "track", asof("s", "c").replace("{vals}", "sin(radians(heading)) AS s, cos(radians(heading)) AS c") + f""",
    h AS (SELECT *, coalesce({lerp('s')}, ps, ns) AS s, coalesce({lerp('c')}, pc, nc) AS c FROM e WHERE n >= 2),
    g AS (SELECT line, seq, degrees(atan2(s, c)) AS a FROM h)
    SELECT q.line, q.seq, ROUND(CASE WHEN a < 0 THEN a + 360 ELSE a END, 6) AS heading FROM q LEFT JOIN g ON q.seq = g.seq""")
def _(spark, d):
    q, k = split(spark, d)
    out = T.interpolate_heading(q, k.select("line", "t", "heading"), ["line"], "t", "heading", every(THREE_DAYS))
    return out.select("line", "seq", r("heading").alias("heading"))


@check("j1c_fill_gaps", "track", asof("lat", "lon").replace("{vals}", "lat, lon") + f""",
    o AS (SELECT e.*, CASE WHEN e.seq % 3 = 0 THEN x.lat END AS lat0, CASE WHEN e.seq % 3 = 0 THEN x.lon END AS lon0 FROM e JOIN track x ON e.seq = x.seq),
    f AS (SELECT line, seq, coalesce(lat0, CASE WHEN n >= 2 THEN {lerp('lat')} END) AS lat, coalesce(lon0, CASE WHEN n >= 2 THEN {lerp('lon')} END) AS lon FROM o)
    SELECT line, seq, ROUND(lat, 9) AS lat, ROUND(lon, 9) AS lon, CASE WHEN lat IS NULL THEN 255 ELSE 0 END AS pos_source FROM f""")
def _(spark, d):
    t = track(spark, d)
    own = F.col("seq") % 3 == 0
    q = t.where("channel = 'click'").select(
        "line", "seq", "t", F.when(own, F.col("lat")).alias("lat"), F.when(own, F.col("lon")).alias("lon"))
    k = t.where("channel = 'view'").select("line", "t", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    f = T.fill_position(T.interpolate(q, k, ["line"], "t", ["lat2", "lon2"], every(THREE_DAYS)), ("lat", "lon"), ("lat2", "lon2"))
    return f.select("line", "seq", r("lat", 9).alias("lat"), r("lon", 9).alias("lon"), "pos_source")


# --- windows -----------------------------------------------------------------------------------------


@check("w1_layback", "track", """WITH p AS (SELECT line, seq, line * 10 + v / 10 AS x, v AS y, t FROM track UNION ALL SELECT -1, seq, v / 10 - 10, v, t FROM track WHERE seq = (SELECT min(seq) FROM track)),
    n AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM p WINDOW w AS (PARTITION BY line ORDER BY t, seq)),
    h AS (SELECT *, CASE WHEN px IS NOT NULL THEN atan2(x - px, y - py) ELSE atan2(nx - x, ny - y) END AS h FROM n)
    SELECT line, seq, ROUND(coalesce(x - 10 * sin(h), x), 6) AS x, ROUND(coalesce(y - 10 * cos(h), y), 6) AS y FROM h""")
def _(spark, d):
    t = track(spark, d)
    first = attach(t, t.agg(F.min("seq").alias("_first")), []).where("seq = _first").drop("_first")
    t = t.unionByName(first.withColumn("line", F.lit(-1).cast(t.schema["line"].dataType)))  # a line of one record
    p = t.select("line", "seq", "t", (F.col("line") * 10 + F.col("v") / 10).alias("x"), F.col("v").alias("y"))
    return T.shift_back(p, along(), "x", "y", 10.0).select("line", "seq", r("x").alias("x"), r("y").alias("y"))


MEDIAN_ZERO = """WITH o AS (SELECT line, seq, v, row_number() OVER (PARTITION BY line ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY line) AS n FROM track{where}),
    s AS (SELECT *, CAST((least({w}, n) - 1) // 2 AS INTEGER) AS h FROM o),
    j AS (SELECT a.line, a.seq, any_value(a.h) AS h, list(b.v) AS vs FROM s a JOIN s b ON a.line = b.line AND abs(a.i - b.i) <= a.h GROUP BY a.line, a.seq)
    SELECT line, seq, list_sort(list_concat(vs, list_resize([]::DOUBLE[], CAST(2 * h + 1 - len(vs) AS BIGINT), 0.0::DOUBLE)))[h + 1] AS med FROM j"""


@check("w2_median_zero_35", "track", MEDIAN_ZERO.replace("{w}", "35").replace("{where}", ""))
def _(spark, d):
    t = T.ordinals(track(spark, d), along(), "ord", "n")
    return T.median_zero(t, ["line"], "v", 35, "med").select("line", "seq", "med")


@check("w2_median_zero_short", "track", MEDIAN_ZERO.replace("{w}", "35").replace("{where}", "").replace("FROM track)", "FROM (SELECT * REPLACE (line * 100 + seq % (line % 40 + 1) AS line) FROM track))"))
def _(spark, d):
    t = track(spark, d).withColumn("line", F.col("line") * 100 + F.col("seq") % (F.col("line") % 40 + 1))  # many lines shorter than the window
    t = T.ordinals(t, along(), "ord", "n")
    return T.median_zero(t, ["line"], "v", 35, "med").select("line", "seq", "med")


REFLECT = """o AS (SELECT line, seq, {v} AS x, row_number() OVER (PARTITION BY line ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY line) AS n FROM track),
    ref AS (SELECT a.line, a.seq, median(b.x) AS m FROM (SELECT line, seq, i, n, unnest(generate_series(i - 10, i + 10)) AS p FROM o) a
      JOIN o b ON a.line = b.line AND b.i = CASE WHEN ((a.p - 1) % (2 * a.n) + 2 * a.n) % (2 * a.n) < a.n THEN ((a.p - 1) % (2 * a.n) + 2 * a.n) % (2 * a.n) + 1
        ELSE 2 * a.n - ((a.p - 1) % (2 * a.n) + 2 * a.n) % (2 * a.n) END GROUP BY ALL)"""


@check("w3_median_reflect", "track", "WITH " + REFLECT.replace("{v}", "CASE WHEN seq % 6 <> 0 THEN v END") + " SELECT line, seq, ROUND(m, 6) AS med FROM ref")
def _(spark, d):
    t = track(spark, d).withColumn("x", F.when(F.col("seq") % 6 != 0, F.col("v")))
    t = T.ordinals(t, along(), "ord", "n")
    return T.median_reflect(t, ["line"], "x", 21, "med").select("line", "seq", r("med").alias("med"))


@check("w4_despike", "track", "WITH " + REFLECT.replace("{v}", "CASE WHEN seq % 6 <> 0 THEN v / 4 END") + """,
    kept AS (SELECT o.*, CASE WHEN o.n >= 21 AND abs(o.x - ref.m) > 5 THEN NULL ELSE o.x END AS k FROM o JOIN ref ON o.seq = ref.seq),
    fil AS (SELECT *, coalesce(k, median(k) OVER (PARTITION BY line)) AS f FROM kept),
    soft AS (SELECT a.line, a.seq, median(b.f) AS m FROM (SELECT line, seq, i, n, unnest(generate_series(i - 5, i + 5)) AS p FROM fil) a
      JOIN fil b ON a.line = b.line AND b.i = CASE WHEN ((a.p - 1) % (2 * a.n) + 2 * a.n) % (2 * a.n) < a.n THEN ((a.p - 1) % (2 * a.n) + 2 * a.n) % (2 * a.n) + 1
        ELSE 2 * a.n - ((a.p - 1) % (2 * a.n) + 2 * a.n) % (2 * a.n) END GROUP BY ALL)
    SELECT fil.line, fil.seq, ROUND(CASE WHEN k IS NOT NULL THEN CASE WHEN n >= 11 THEN m ELSE k END END, 6) AS clean FROM fil JOIN soft ON fil.seq = soft.seq""")
def _(spark, d):
    t = track(spark, d).withColumn("x", F.when(F.col("seq") % 6 != 0, F.col("v") / 4))
    t = T.ordinals(t, along(), "ord", "n")
    return T.despike(t, ["line"], "x", "clean").select("line", "seq", r("clean").alias("clean"))


RUNS = """o AS (SELECT line, seq, v, row_number() OVER (PARTITION BY line ORDER BY t, seq) AS i FROM track),
    f AS (SELECT *, v > 8 AS ok, sum(CASE WHEN v > 8 THEN 0 ELSE 1 END) OVER (PARTITION BY line ORDER BY i) AS run FROM o)"""


@check("w5_runs", "track", f"""WITH {RUNS} SELECT line, CAST(run AS BIGINT) AS run, min(i) - 1 AS "start", count(*) AS length FROM f WHERE ok
    GROUP BY line, run HAVING count(*) >= 5 AND min(i) - 1 >= 10""")
def _(spark, d):
    return T.runs(track(spark, d), along(), F.col("v") > 8, 5, 10)


@check("w6_thin_track", "track", """WITH o AS (SELECT line, seq, row_number() OVER (PARTITION BY line ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY line) AS n FROM track)
    SELECT line, seq FROM o WHERE (i - 1) % greatest(1, n // 20) = 0""")
def _(spark, d):
    return T.thin(T.ordinals(track(spark, d), along(), "ord", "n"), 20).select("line", "seq")


@check("w7_resample_polyline", "track", """WITH p AS (SELECT line, t, seq, lon, lat, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM track WINDOW w AS (PARTITION BY line ORDER BY t, seq)),
    h AS (SELECT *, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2) AS a FROM p),
    c AS (SELECT *, sum(coalesce(2 * 6371000 * atan2(sqrt(a), sqrt(1 - a)), 0)) OVER (PARTITION BY line ORDER BY t, seq) AS d FROM h),
    s AS (SELECT *, lag(d) OVER (PARTITION BY line ORDER BY t, seq) AS pd, max(d) OVER (PARTITION BY line) AS len FROM c),
    tg AS (SELECT line, len, unnest(range(50)) AS i FROM (SELECT DISTINCT line, len FROM s)),
    m AS (SELECT tg.line, tg.i, s.plon + (tg.i * (tg.len / 49) - pd) / (d - pd) * (s.lon - s.plon) AS lon, s.plat + (tg.i * (tg.len / 49) - pd) / (d - pd) * (s.lat - s.plat) AS lat
          FROM tg JOIN s ON tg.line = s.line AND tg.i BETWEEN 1 AND 48 AND tg.i * (tg.len / 49) > pd AND tg.i * (tg.len / 49) <= d),
    z AS (SELECT line, 0 AS i, arg_min(lon, (t, seq)) AS lon, arg_min(lat, (t, seq)) AS lat FROM track GROUP BY line UNION ALL
          SELECT line, 49, arg_max(lon, (t, seq)), arg_max(lat, (t, seq)) FROM track GROUP BY line)
    SELECT line, CAST(i AS INTEGER) AS i, ROUND(lon, 8) AS lon, ROUND(lat, 8) AS lat FROM (SELECT * FROM m UNION ALL SELECT * FROM z)""")
def _(spark, d):
    out = T.resample_polyline(track(spark, d), along(), "lon", "lat", 50)
    return out.select("line", "i", r("lon", 8).alias("lon"), r("lat", 8).alias("lat"))


@check("w8_global_ping", "track", """WITH o AS (SELECT line, seq, row_number() OVER (PARTITION BY line ORDER BY t, seq) - 1 AS p FROM track),
    l AS (SELECT line, max(p) + 1 AS n FROM o GROUP BY line), s AS (SELECT line, coalesce(sum(n) OVER (ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM l)
    SELECT o.line, seq, CAST(off + p AS BIGINT) AS ping_ord FROM o JOIN s ON o.line = s.line""")
def _(spark, d):
    t = T.ordinals(track(spark, d), along(), "p").withColumn("p", F.col("p") - 1)
    return T.global_ping_ids(t, along(), ["line"], "p").select("line", "seq", "ping_ord")


@check("w9_fixed_segments", "track", """WITH o AS (SELECT line, seq, v, row_number() OVER (PARTITION BY line ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY line) AS n FROM track)
    SELECT line, (i - 1) // 10 AS seg, count(*) AS pings, ROUND(sum(v), 4) AS v FROM o WHERE (i - 1) // 10 < n // 10 GROUP BY ALL""")
def _(spark, d):
    t = T.ordinals(track(spark, d), along(), "ord", "n").withColumn("seg", T.segment_of(10))
    t = t.where(F.col("seg") < F.floor(F.col("n") / 10))
    return t.groupBy("line", "seg").agg(F.count("*").alias("pings"), r(F.sum("v"), 4).alias("v"))


@check("a17_ping_spacing", "track", """WITH p AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM track WINDOW w AS (PARTITION BY line ORDER BY t, seq))
    SELECT line, ROUND(avg(sqrt(pow((lat - plat) * 111320, 2) + pow((lon - plon) * 111320 * cos(radians(plat)), 2))), 4) AS spacing,
    ROUND(min(heading), 6) AS heading_min, ROUND(max(heading), 6) AS heading_max, count(*) AS pings, count(CASE WHEN seq % 7 <> 0 THEN 1 END) AS valid FROM p GROUP BY line""")
def _(spark, d):
    here = F.struct("lat", "lon")
    t = T.reach(track(spark, d), along(), before={"p": (here, True)})
    gap = flat_spacing(F.col("p.lat"), F.col("p.lon"), F.col("lat"), F.col("lon"))
    return t.groupBy("line").agg(
        r(F.avg(gap), 4).alias("spacing"), r(F.min("heading")).alias("heading_min"), r(F.max("heading")).alias("heading_max"),
        F.count("*").alias("pings"), F.count(F.when(F.col("seq") % 7 != 0, 1)).alias("valid"),
    )


# --- sort, top, sets ---------------------------------------------------------------------------------


@check("t2_greedy_dedup", "spot", """WITH RECURSIVE o AS (SELECT *, row_number() OVER (ORDER BY abs(v) DESC, id) AS n FROM spot),
    g(n, kept) AS (SELECT 0::BIGINT, []::STRUCT(id BIGINT, x DOUBLE, y DOUBLE, v DOUBLE)[] UNION ALL
      SELECT o.n, CASE WHEN len(list_filter(kept, lambda k: (k.x - o.x) * (k.x - o.x) + (k.y - o.y) * (k.y - o.y) < 1600)) > 0 THEN kept
        ELSE list_append(kept, {'id': o.id, 'x': o.x::DOUBLE, 'y': o.y::DOUBLE, 'v': o.v}) END FROM g JOIN o ON o.n = g.n + 1),
    z AS (SELECT unnest(kept) AS k FROM (SELECT kept FROM g ORDER BY n DESC LIMIT 1)) SELECT k.id AS id, k.x AS x, k.y AS y, k.v AS v FROM z""")
def _(spark, d):
    return greedy_thin(spot(spark, d), ["id"], "x", "y", "v", 40.0).select("id", "x", "y", "v")


@check("t2_greedy_first_round", "spot", """SELECT a.id FROM spot a WHERE NOT EXISTS (SELECT 1 FROM spot b WHERE
    (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) < 1600 AND (abs(b.v), -b.id) > (abs(a.v), -a.id))""")
def _(spark, d):
    # Points without a stronger neighbour always survive: read them off the full answer.
    kept = greedy_thin(spot(spark, d), ["id"], "x", "y", "v", 40.0)
    s = spot(spark, d)
    side = 40.0
    step = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    tx, ty = F.floor(F.col("x") / side), F.floor(F.col("y") / side)
    k = kept.select("id", "x", "y", "v", F.explode(step).alias("s")).withColumn("tx", tx + F.col("s.a")).withColumn("ty", ty + F.col("s.b"))
    o = s.select(F.col("id").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("v").alias("ov"), tx.alias("tx"), ty.alias("ty"))
    d2 = (F.col("x") - F.col("ox")) ** 2 + (F.col("y") - F.col("oy")) ** 2
    stronger = F.struct(F.abs("ov"), -F.col("oid")) > F.struct(F.abs("v"), -F.col("id"))
    beaten = k.join(o, ["tx", "ty"]).where((d2 < 1600) & stronger).select("id").distinct()
    return kept.select("id").join(beaten, "id", "left_anti")


@check("t3_rank_targets", "spot", """SELECT id, 'T' || lpad(CAST(n AS VARCHAR), CAST(greatest(3, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS target_id,
    CASE WHEN v > 0 THEN '+' ELSE '-' END AS polarity FROM (SELECT *, row_number() OVER (ORDER BY abs(v) DESC, id) AS n FROM spot)""")
def _(spark, d):
    return rank_targets(spot(spark, d), "v", ["id"]).select("id", "target_id", "polarity")


@check("t4_sort_segments", "track", f"""WITH {RUNS} SELECT line, CAST(run AS BIGINT) AS run, count(*) AS length, ROUND(20 * log10(avg(v)), 6) AS cc_db
    FROM f WHERE ok GROUP BY line, run ORDER BY cc_db""")
def _(spark, d):
    t = T.runs_tag(track(spark, d), along(), F.col("v") > 8).where("_flag")
    g = t.groupBy("line", "run").agg(F.count("*").alias("length"), r(20 * F.log10(F.avg("v"))).alias("cc_db"))
    return g.orderBy("cc_db")


@check("t6_preferred_channel", "track", """WITH c AS (SELECT *, CASE channel WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'error' THEN 2 WHEN 'signup' THEN 3 END AS p
    FROM (SELECT * REPLACE (line * 1000 + seq % 100 AS line) FROM track)), b AS (SELECT *, min(p) OVER (PARTITION BY line) AS m FROM c WHERE p IS NOT NULL)
    SELECT line, seq FROM b WHERE p = m""")
def _(spark, d):
    names = dict(zip(["click", "view", "error", "signup"], cube.CHANNEL_ORDER))
    m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    t = track(spark, d).withColumn("line", F.col("line") * 1000 + F.col("seq") % 100)  # short lines, so that channels are missing
    t = t.withColumn("channel", m[F.col("channel")])
    return cube.preferred_channel(t, ["line"]).select("line", "seq")


@check("u1_union_lines", "track", """SELECT 'SSS' AS instrument, channel, count(*) AS n FROM track WHERE channel <> 'view' GROUP BY ALL
    UNION ALL SELECT 'SBP', channel, count(*) FROM track WHERE channel = 'view' GROUP BY ALL""")
def _(spark, d):
    t = track(spark, d)
    sss = t.where("channel <> 'view'").select(F.lit("SSS").alias("instrument"), "channel")
    sbp = t.where("channel = 'view'").select(F.lit("SBP").alias("instrument"), "channel")
    return sss.unionByName(sbp).groupBy("instrument", "channel").agg(F.count("*").alias("n"))


@check("u2_distinct_ids", "sample", "SELECT DISTINCT line, channel FROM sample")
def _(spark, d):
    return sample(spark, d).select("line", "channel").distinct()


@check("u3_contour_levels", "raster", """WITH m AS (SELECT ceil(max(z) / 10) * 10 AS top FROM raster)
    SELECT DISTINCT CAST(l AS BIGINT) AS level FROM (SELECT unnest(generate_series(5, CAST(top AS BIGINT) - 1, 5)) AS l FROM m
    UNION SELECT unnest(generate_series(10, CAST(top AS BIGINT) - 1, 10)) FROM m)""")
def _(spark, d):
    from soundlake.checks.base import raster
    from soundlake.operators.raster import contour_levels

    highest = raster(spark, d).agg(F.max("z").alias("top"))
    levels = contour_levels(highest.first().top)
    return highest.select(F.explode(F.array(*[F.lit(v).cast("long") for v in levels])).alias("level"))


@check("s7_nmea", "track", """WITH s AS (SELECT seq, CASE WHEN seq % 4 = 0 THEN 'x' ELSE '' END AS bad, lat, lon, seq % 3 AS k FROM track),
    p AS (SELECT *, CASE k WHEN 0 THEN 'GGA' WHEN 1 THEN 'RMC' ELSE 'VTG' END AS kind,
      CAST(printf('%.4f', floor(lat) * 100 + (lat - floor(lat)) * 60 + 0.000013) AS DOUBLE) AS a, CAST(printf('%.4f', floor(lon) * 100 + (lon - floor(lon)) * 60 + 0.000013) AS DOUBLE) AS o FROM s)
    SELECT seq, ROUND(CASE WHEN kind <> 'VTG' AND bad = '' THEN -(floor(a / 100) + (a - floor(a / 100) * 100) / 60) END, 8) AS lat,
      ROUND(CASE WHEN kind <> 'VTG' THEN floor(o / 100) + (o - floor(o / 100) * 100) / 60 END, 8) AS lon FROM p""")
def _(spark, d):
    from soundlake.functions.acoustic import nmea_position

    def dm(c):
        return F.format_string("%.4f", F.floor(c) * 100 + (F.col(c) - F.floor(c)) * 60 + 0.000013)

    bad = F.when(F.col("seq") % 4 == 0, "x").otherwise("")
    k = F.col("seq") % 3
    pos = F.concat(bad, dm("lat"), F.lit(",S,"), dm("lon"), F.lit(",E"))
    text = (
        F.when(k == 0, F.concat(F.lit("$GPGGA,120000,"), pos, F.lit(",1")))
        .when(k == 1, F.concat(F.lit("$GPRMC,120000,A,"), pos, F.lit(",5.0,90,010124,,")))
        .otherwise(F.concat(F.lit("$GPVTG,"), pos, F.lit(",,,,")))
    )
    lat, lon = nmea_position(text)
    return track(spark, d).select("seq", r(lat, 8).alias("lat"), r(lon, 8).alias("lon"))


def mag_text():
    """Records as the instrument writes them; every fifth is interpolated, every seventh is broken."""
    return F.concat(
        F.lit("*24.001/12:00:"), F.format_string("%04.1f", F.col("seq") % 60 + 0.5), F.lit(" F:"),
        F.format_string("%.3f", 44000 + F.col("v")), F.lit(" S:120 D:"), F.format_string("%+.2f", "roll"), F.lit("m A:"),
        F.format_string("%.2f", F.col("v") / 10 + 0.0012), F.lit("m L:0 Q:"), (F.col("seq") % 100).cast("string"), F.lit(" X:1.0 Y:2.0 z x:"),
        F.format_string("%.7f", "lon"), F.when(F.col("seq") % 7 == 0, " yy:").otherwise(" y:"), F.format_string("%.7f", "lat"),
        F.when(F.col("seq") % 5 == 0, " <INTERP>").otherwise(" <REAL>"),
    )


@check("s2_mag_records", "track", """SELECT seq, '12:00:' || printf('%04.1f', seq % 60 + 0.5) AS "time", CAST(printf('%.3f', 44000 + v) AS DOUBLE) AS "F_nT",
    CAST(printf('%.2f', roll) AS DOUBLE) AS depth_m, CAST(printf('%.2f', v / 10 + 0.0012) AS DOUBLE) AS alt_m, CAST(seq % 100 AS INTEGER) AS quality,
    CAST(printf('%.7f', lon) AS DOUBLE) AS lon, CAST(printf('%.7f', lat) AS DOUBLE) AS lat FROM track WHERE seq % 5 <> 0 AND seq % 7 <> 0""")
def _(spark, d):
    from soundlake.sources.text import parse_mag

    return parse_mag(track(spark, d).select("seq", mag_text().alias("value")))


@check("s1_xyz", "spot", "SELECT x, y, -v AS z FROM spot")
def _(spark, d):
    from soundlake.sources.text import parse_xyz

    text = F.concat_ws("   ", F.lit(""), "x", "y", -F.col("v"))
    return parse_xyz(spot(spark, d).select(text.alias("value")))


@check("s8_survey_files", "", """WITH f AS (SELECT n_name AS name, n_regionkey AS dir FROM nation), d AS (SELECT r_regionkey AS dir, (r_regionkey * 3) % 5 AS dir_order, CASE WHEN r_regionkey % 2 = 0 THEN 15.0::DOUBLE END AS cable_length FROM region)
    SELECT name, cable_length, CAST(row_number() OVER (ORDER BY dir_order, name) - 1 AS INTEGER) AS line_id FROM f JOIN d ON f.dir = d.dir""")
def _(spark, d):
    from soundlake.sources.text import list_surveys

    files = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("dir"))
    k = F.col("r_regionkey")
    dim = table(spark, d, "region").select(k.alias("dir"), (k * 3 % 5).alias("dir_order"), F.when(k % 2 == 0, 15.0).alias("cable_length"))
    return list_surveys(files, dim).select("name", "cable_length", "line_id")


