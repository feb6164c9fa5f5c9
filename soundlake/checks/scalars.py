"""Scalar functions and filters."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.checks.base import (
    BLANK, along, check, holed, r, raster, sample, table, trace, track,
)
from soundlake.functions import acoustic as A
from soundlake.functions import geo as G
from soundlake.operators import along as T
from soundlake.operators import trace as TR
from soundlake.operators.raster import masked
from soundlake.operators.stats import attach, quantiles

RAD = "6371000.0"


def far_sql(c: str) -> str:
    return f"(CASE WHEN {c} = 1 THEN 65.0 ELSE 70.0 END)"


# Pings of 64 samples: pixel 1 m, altitude 8..17 m.
PING_SQL = """WITH p AS (SELECT line, seq, amps, 1.0 AS pix, 8.0 + seq % 10 AS alt,
    CASE WHEN line % 2 = 1 THEN 65.0 ELSE 70.0 END AS far, (seq * 7 % 360)::DOUBLE AS heading FROM trace)"""


def pings(spark, d):
    return trace(spark, d).select(
        "line", "seq", "amps", F.lit(1.0).alias("pix"), (F.lit(8.0) + F.col("seq") % 10).alias("alt"),
        F.when(F.col("line") % 2 == 1, F.lit("HF_port")).otherwise(F.lit("LF_stbd")).alias("channel"),
        (F.col("seq") * 7 % 360).cast("double").alias("heading"),
        (F.lit(22.1) + F.col("seq") * 1e-4).alias("lat"), (F.lit(120.7) + F.col("line") * 1e-3).alias("lon"),
    )


@check(
    "x1_slant_projection", "trace",
    PING_SQL + """, e AS (SELECT *, unnest(amps) AS a, generate_subscripts(amps, 1) - 1 AS i FROM p)
    SELECT line, seq, CAST(i AS INTEGER) AS sample, a AS bs_linear,
      ROUND(sqrt(greatest(i * pix * (i * pix) - alt * alt, 0)), 6) AS ground_m,
      ROUND(degrees(acos(alt / (i * pix))), 6) AS inc_angle
    FROM e WHERE i * pix > alt / cos(radians(15.0)) AND i * pix < alt / cos(radians(far))""",
)
def _(spark, d):
    e = TR.project_samples(pings(spark, d), "amps", "pix", "alt", A.far_cutoff(F.col("channel")), ["line", "seq"])
    return e.select("line", "seq", "sample", "bs_linear", r("ground_m").alias("ground_m"), r("inc_angle").alias("inc_angle"))


@check(
    "x2_offset_position", "track",
    f"""SELECT seq, ROUND(lat + degrees(v * cos(radians(heading)) / {RAD}), 9) AS lat2,
    ROUND(lon + degrees(v * sin(radians(heading)) / ({RAD} * cos(radians(lat)))), 9) AS lon2 FROM track""",
)
def _(spark, d):
    lat, lon = G.offset_position(F.col("lat"), F.col("lon"), F.col("heading"), F.col("v"))
    return track(spark, d).select("seq", r(lat, 9).alias("lat2"), r(lon, 9).alias("lon2"))


@check(
    "x3_towfish_layback", "track",
    f"""WITH b AS (SELECT *, CASE WHEN line % 2 = 0 THEN 15.0 END AS cable, v / 20 AS depth FROM track),
    c AS (SELECT *, CASE WHEN cable IS NULL THEN 0.0 ELSE sqrt(greatest(cable * cable - depth * depth, 0)) END AS back,
          radians(heading + 180) AS brg FROM b)
    SELECT seq, ROUND(back, 6) AS back, ROUND(lat + degrees(back * cos(brg) / {RAD}), 9) AS lat2,
      ROUND(lon + degrees(back * sin(brg) / ({RAD} * cos(radians(lat)))), 9) AS lon2 FROM c""",
)
def _(spark, d):
    t = track(spark, d).withColumn("cable", F.when(F.col("line") % 2 == 0, 15.0)).withColumn("depth", F.col("v") / 20)
    t = t.withColumn("back", G.towfish_layback(F.col("cable"), F.col("depth")))
    lat, lon = G.offset_position(F.col("lat"), F.col("lon"), F.col("heading") + 180, F.col("back"))
    return t.select("seq", r("back").alias("back"), r(lat, 9).alias("lat2"), r(lon, 9).alias("lon2"))


@check("x4_to_db", "sample", """SELECT ping, num, part, line, bs,
    CASE WHEN bs > 20000 THEN ROUND(10 * log10(bs - 20000), 6) END AS db FROM sample""")
def _(spark, d):
    return sample(spark, d).select(
        "ping", "num", "part", "line", "bs", r(A.to_db(F.greatest(F.col("bs") - 20000, F.lit(0.0)))).alias("db")
    )


@check(
    "x5_reflection_loss", "trace",
    """WITH b AS (SELECT line, seq, amps, list_max(amps[9:]) AS m FROM trace)
    SELECT line, seq, CAST(list_position(amps[9:], m) + 7 AS INTEGER) AS idx_b,
    ROUND(least(greatest(-20 * log10(m::DOUBLE / 0.8), 0.0), 50.0), 6) AS rl FROM b""",
)
def _(spark, d):
    t = TR.reflection_loss(trace(spark, d), 0.8, BLANK, min_samples=60)
    return t.select("line", "seq", "idx_b", r("rl").alias("rl"))


@check("x6_class_limits", "", """WITH s AS (SELECT * FROM (VALUES ('Sand', 1943, 1776.0), ('Silty sand / Sandy silt', 1772, 1660.5),
    ('Silt', 1740, 1627.5), ('Sand-silt-clay', 1596, 1590.0), ('Clayey silt / Silty clay', 1455, 1545.0),
    ('Partially consolidated mud', 1320, 1480.0), ('Fluid mud', 1183, 1444.0)) t(name, rho, vp)),
    rl AS (SELECT name, -20 * log10(abs((rho * vp::DOUBLE - 997 * 1489.073::DOUBLE) / (rho * vp::DOUBLE + 997 * 1489.073::DOUBLE))) AS rl FROM s),
    lim AS (SELECT name, rl, (rl + lead(rl) OVER (ORDER BY rl)) / 2 AS upper, row_number() OVER (ORDER BY rl) - 1 AS id FROM rl),
    val AS (SELECT o_orderkey, o_totalprice / 20000 AS v FROM orders),
    c AS (SELECT (SELECT min(id) FROM lim WHERE v < coalesce(upper, 1e300)) AS id FROM val)
    SELECT CAST(lim.id AS INTEGER) AS class_id, name, ROUND(rl, 6) AS rl_db, ROUND(upper, 6) AS upper_db, count(c.id) AS n
    FROM lim LEFT JOIN c ON c.id = lim.id GROUP BY ALL""")
def _(spark, d):
    o = table(spark, d, "orders").select(A.sediment_class(F.col("o_totalprice") / 20000).alias("class_id"))
    n = o.groupBy("class_id").agg(F.count("*").alias("n"))
    s = A.sediment_table(spark).join(n, "class_id", "left")
    return s.select("class_id", "name", r("rl_db").alias("rl_db"), r("upper_db").alias("upper_db"), F.coalesce("n", F.lit(0)).alias("n"))


LIMITS = A.class_limits()
CLASS_SQL = "(CASE WHEN rl IS NULL OR rl < 0 THEN -1 " + " ".join(
    f"WHEN rl < {t!r} THEN {i}" for i, t in enumerate(LIMITS)) + " ELSE 6 END)"
ACCT = "WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal / 400 END AS rl FROM customer)"


def acct(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal") / 400).alias("rl")
    )


@check("x7_classify", "", ACCT + f" SELECT c_custkey, {CLASS_SQL} AS class_id FROM a")
def _(spark, d):
    return acct(spark, d).select("c_custkey", A.sediment_class(F.col("rl")).alias("class_id"))


@check("x8_class_speed", "", ACCT + f""" SELECT c_custkey, CASE {CLASS_SQL} WHEN 0 THEN 1776.0 WHEN 1 THEN 1660.5 WHEN 2 THEN 1627.5
    WHEN 3 THEN 1590.0 WHEN 4 THEN 1545.0 WHEN 5 THEN 1480.0 WHEN 6 THEN 1444.0 ELSE 1489.073 END::DOUBLE AS vp FROM a""")
def _(spark, d):
    return acct(spark, d).select("c_custkey", TR.class_speed(F.col("rl")).alias("vp"))


_S = G.series()


def dbl(x: float) -> str:
    """A SQL literal that is a double, not a decimal."""
    return f"CAST('{x!r}' AS DOUBLE)"


def _series_sql() -> tuple[str, str]:
    e, rect = dbl(_S["e"]), dbl(_S["rect"])
    ath = lambda x: f"(0.5 * ln((1 + {x}) / (1 - {x})))"
    fwd = f"""SELECT id, lon, lat, sinh({ath('sin(radians(lat))')} - {e} * {ath(f'({e} * sin(radians(lat)))')}) AS t,
        radians(lon - 121.0) AS lam FROM g"""
    x = "eta0" + "".join(f" + {dbl(a)} * cos({2 * j} * xi0) * sinh({2 * j} * eta0)" for j, a in enumerate(_S["alpha"], 1))
    y = "xi0" + "".join(f" + {dbl(a)} * sin({2 * j} * xi0) * cosh({2 * j} * eta0)" for j, a in enumerate(_S["alpha"], 1))
    scale = f"0.9999e0 * {rect}"
    return fwd, f"""SELECT id, lon, lat, 250000e0 + {scale} * ({x}) AS x, {scale} * ({y}) AS y FROM
        (SELECT *, atan2(t, cos(lam)) AS xi0, {ath('(sin(lam) / sqrt(1 + t * t))')} AS eta0 FROM f)"""


PROJECT_SQL = ("f AS ({}), xy AS ({})").format(*_series_sql())


@check("x10_projection", "", f"""WITH g AS (SELECT c_custkey AS id, 119.5 + (c_custkey * 7919 % 3001) / 1000.0::DOUBLE AS lon,
    21.5 + (c_custkey * 104729 % 4001) / 1000.0::DOUBLE AS lat FROM customer), {PROJECT_SQL}
    SELECT id, ROUND(x, 4) AS x, ROUND(y, 4) AS y, ROUND(lon, 8) AS lon2, ROUND(lat, 8) AS lat2 FROM xy""")
def _(spark, d):
    k = F.col("c_custkey")
    g = table(spark, d, "customer").select(
        k.alias("id"), (119.5 + k * 7919 % 3001 / 1000.0).alias("lon"), (21.5 + k * 104729 % 4001 / 1000.0).alias("lat")
    )
    x, y = G.project(F.col("lon"), F.col("lat"))
    g = g.withColumn("x", x).withColumn("y", y)
    lon2, lat2 = G.unproject(F.col("x"), F.col("y"))
    return g.select("id", r("x", 4).alias("x"), r("y", 4).alias("y"), r(lon2, 8).alias("lon2"), r(lat2, 8).alias("lat2"))


@check("x11_cell_centres", "raster", """SELECT "row", col, 227173.5e0 + (col + 0.5) * 0.5 AS x, 2449210.5e0 - ("row" + 0.5) * 0.5 AS y,
    CAST(floor((2449210.5 - (2449210.5 - ("row" + 0.5) * 0.5)) / 0.5) AS INTEGER) AS row2 FROM raster""")
def _(spark, d):
    g = raster(spark, d).select("row", "col")
    g = g.withColumn("x", G.centre_x(F.col("col"), 227173.5, 0.5)).withColumn("y", G.centre_y(F.col("row"), 2449210.5, 0.5))
    return g.withColumn("row2", G.cell_of(F.col("x"), F.col("y"), 227173.5, 2449210.5, 0.5)[0])


@check("x12_angle_weight", "sample", """SELECT ping, num, part, line, bs, ROUND(exp(-pow((angle - 45) / 12, 2)), 9) AS w FROM sample""")
def _(spark, d):
    return sample(spark, d).select("ping", "num", "part", "line", "bs", r(A.angle_weight(F.col("angle")), 9).alias("w"))


COLORS_SQL = "(VALUES " + ", ".join(
    f"({i}, {int(c[1:3], 16)}, {int(c[3:5], 16)}, {int(c[5:7], 16)})" for i, c in enumerate(K.SEDIMENT_COLORS)) + ") t(k, r, g, b)"


@check("x13_class_colour", "raster", f"""WITH k AS (SELECT o_orderkey AS id, o_orderkey % 9 AS k,
    o_orderkey // 100 AS "row", o_orderkey % 100 AS col FROM orders), c AS (SELECT * FROM {COLORS_SQL})
    SELECT id, coalesce(c.r, 255) AS red, coalesce(c.g, 255) AS green, coalesce(c.b, 255) AS blue
    FROM k LEFT JOIN c ON c.k = k.k AND id % 97 <> 0""")
def _(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 9).cast("int").alias("class_id"),
        F.floor(F.col("o_orderkey") / 100).cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"),
    )
    from soundlake.plans.jobs import class_colours

    return class_colours(o, holed(spark, d).where("z is not null")).select("id", "red", "green", "blue")


@check("x14_null_sentinel", "", """SELECT p_partkey, nullif(p_size + 205, 255) AS u8, nullif(p_size - 2, -1) AS i8 FROM part""")
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", A.null_sentinel(F.col("p_size") + 205, "uint8").alias("u8"),
        A.null_sentinel(F.col("p_size") - 2, "int8").alias("i8"),
    )


@check("x15_round_output", "", """SELECT p_partkey, round_even(p_retailprice / 8, 1) AS a, round_even(p_retailprice / 7, 4) AS b FROM part""")
def _(spark, d):
    p = F.col("p_retailprice")
    return table(spark, d, "part").select("p_partkey", F.bround(p / 8, 1).alias("a"), F.bround(p / 7, 4).alias("b"))


@check("x16_to_byte", "raster", """SELECT "row", col, CAST(trunc((z - (SELECT min(z) FROM raster)) /
    ((SELECT max(z) FROM raster) - (SELECT min(z) FROM raster)) * 255) AS INTEGER) AS byte FROM raster""")
def _(spark, d):
    g = raster(spark, d)
    lim = g.agg(F.min("z").alias("lo"), F.max("z").alias("hi"))
    return attach(g, lim, []).select("row", "col", A.to_byte(F.col("z"), F.col("lo"), F.col("hi")).alias("byte"))


@check("x17_stretch", "raster", """WITH l AS (SELECT quantile_cont(z, 0.02) AS lo, quantile_cont(z, 0.98) AS hi FROM raster)
    SELECT "row", col, ROUND(least(greatest((z - lo) / greatest(hi - lo, 1e-6), 0), 1), 6) AS u FROM raster, l""")
def _(spark, d):
    g = raster(spark, d)
    j = attach(g, quantiles(g, [], "z", {"lo": 0.02, "hi": 0.98}), [])
    return j.select("row", "col", r(A.stretch01(F.col("z"), F.col("lo"), F.col("hi"))).alias("u"))


@check("x18_heading_gap", "track", """SELECT seq, ROUND(least(abs(heading - (seq * 37 % 360)), 360 - abs(heading - (seq * 37 % 360))), 6) AS gap FROM track""")
def _(spark, d):
    g = G.heading_gap(F.col("heading"), F.col("seq") * 37 % 360)
    return track(spark, d).select("seq", r(g).alias("gap"))


@check("x19_degree_minute", "track", """SELECT seq, printf('%d°%05.2f′N', CAST(floor(lat) AS BIGINT), (lat - floor(lat)) * 60) AS lat_text,
    printf('%d°%05.2f′%s', CAST(floor(abs(lon - 121)) AS BIGINT), (abs(lon - 121) - floor(abs(lon - 121))) * 60,
    CASE WHEN lon >= 121 THEN 'E' ELSE 'W' END) AS lon_text FROM track""")
def _(spark, d):
    return track(spark, d).select(
        "seq", G.degree_minute(F.col("lat"), "lat").alias("lat_text"), G.degree_minute(F.col("lon") - 121, "lon").alias("lon_text")
    )


@check("x20_water_depth", "track", """SELECT seq, CASE WHEN seq % 5 <> 0 THEN ROUND(v / 10 + roll + 4, 6) END AS depth FROM track""")
def _(spark, d):
    t = track(spark, d).withColumn("alt", F.when(F.col("seq") % 5 != 0, F.col("roll") + 4))
    return t.select("seq", r(A.water_depth(F.col("v") / 10, F.col("alt"))).alias("depth"))


# --- filters ----------------------------------------------------------------------------------------


@check("f1_turn_filter", "track", """WITH u AS (SELECT *, v / 6 AS hd FROM track WHERE seq % 7 <> 0 AND seq % 11 <> 0),
    p AS (SELECT *, lag(hd) OVER w AS ph, lag(t) OVER w AS pt FROM u WINDOW w AS (PARTITION BY line ORDER BY t, seq)),
    g AS (SELECT *, least(abs(hd - ph), 360 - abs(hd - ph)) AS gap, t - pt AS dt FROM p)
    SELECT line, seq FROM g WHERE NOT (seq % 13 <> 0 AND abs(roll) > 3)
    AND NOT coalesce(dt > 0 AND gap / dt > 2, false) AND NOT coalesce(gap > 3, false)""")
def _(spark, d):
    t = track(spark, d).withColumn("hd", F.when(F.col("seq") % 11 != 0, F.col("v") / 6)).withColumn(
        "rl", F.when(F.col("seq") % 13 != 0, F.col("roll")))
    return T.turn_filter(t, along(), "t", "hd", "rl", F.col("seq") % 7 != 0).select("line", "seq")


@check("f2_mag_quality", "track", """SELECT seq FROM track WHERE CAST(seq % 100 AS INTEGER) >= 20
    AND v BETWEEN (100 + line) * 0.9::DOUBLE AND (100 + line) * 1.1::DOUBLE""")
def _(spark, d):
    from soundlake.plans.magnetics import quality_filter

    t = track(spark, d).withColumn("q", F.col("seq") % 100)
    dim = t.select("line").distinct().withColumn("f_ref", 100.0 + F.col("line"))
    return quality_filter(t, dim, ["line"], "v", "q", min_quality=20).select("seq")


@check("f3_min_group", "track", """WITH a AS (SELECT *, count(*) OVER (PARTITION BY line) AS n0 FROM track),
    b AS (SELECT *, count(*) OVER (PARTITION BY line) AS n1 FROM a WHERE n0 >= 60 AND v > 20)
    SELECT line, seq FROM b WHERE n1 >= 55""")
def _(spark, d):
    from soundlake.plans.magnetics import big_lines

    t = big_lines(track(spark, d), ["line"], 60).where("v > 20")
    return big_lines(t, ["line"], 55).select("line", "seq")


@check("f4_background_outlier", "spot", "SELECT id FROM spot WHERE abs(v) < 2 * (SELECT stddev_pop(v) FROM spot)")
def _(spark, d):
    from soundlake.checks.base import spot
    from soundlake.plans.magnetics import drop_outliers

    return drop_outliers(spot(spark, d), "v").select("id")


@check("f5_angle_mask", "sample", """SELECT ping, num, part, line, bs, CASE WHEN angle BETWEEN 15 AND CASE channel WHEN 1 THEN 65 ELSE 70 END
    AND angle <> 30 THEN bs END AS db FROM (SELECT * REPLACE (angle + 8 AS angle) FROM sample)""")
def _(spark, d):
    s = sample(spark, d).withColumn("angle", F.col("angle") + 8)
    far = A.far_cutoff(F.when(F.col("channel") == 1, "HF").otherwise("LF"))
    db = F.when(F.col("angle") != 30, F.col("bs"))
    return s.select("ping", "num", "part", "line", "bs", A.angle_mask(db, F.col("angle"), far).alias("db"))


@check("f6_slant_window", "sample", f"""SELECT ping, num, part, line, bs FROM sample
    WHERE angle > altitude / cos(radians(15.0)) AND angle < altitude / cos(radians({far_sql('channel')}))""")
def _(spark, d):
    far = A.far_cutoff(F.when(F.col("channel") == 1, "HF").otherwise("LF"))
    lo, hi = A.slant_window(F.col("altitude"), far)
    s = sample(spark, d).where((F.col("angle") > lo) & (F.col("angle") < hi))
    return s.select("ping", "num", "part", "line", "bs")


@check("f7_accept_altitude", "track", """WITH a AS (SELECT seq, CASE WHEN seq % 3 <> 0 THEN v / 10 END AS fr, CASE WHEN seq % 4 <> 0 THEN v / 9 + 2 END AS bed,
    v % 5 - 1 AS dep FROM track), m AS (SELECT max(bed) * 0.6 AS c FROM a)
    SELECT seq, ROUND(CASE WHEN fr > 5 AND fr < c THEN fr WHEN dep > 0 AND bed - dep > 5 AND bed - dep < c THEN bed - dep END, 6) AS alt FROM a, m""")
def _(spark, d):
    v, q = F.col("v"), F.col("seq")
    a = track(spark, d).select(
        "seq", F.when(q % 3 != 0, v / 10).alias("fr"), F.when(q % 4 != 0, v / 9 + 2).alias("bed"), (v % 5 - 1).alias("dep")
    )
    a = attach(a, a.agg((F.max("bed") * 0.6).alias("c")), [])
    alt = A.accept_altitude(F.col("fr"), F.col("bed"), F.col("dep"), F.col("c"))
    return a.select("seq", r(alt).alias("alt"))


@check("f10_thickness_range", "", "SELECT p_partkey, p_size / 10.0::DOUBLE AS t FROM part WHERE p_size / 10.0::DOUBLE BETWEEN 0.1 AND 3.0")
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") / 10.0).alias("t"))
    return p.where(A.plausible_thickness(F.col("t")))


@check("f13_depth_mask", "raster", """SELECT c_custkey // 10 AS "row", c_custkey % 10 * 7 AS col, c_acctbal AS v FROM customer
    WHERE EXISTS (SELECT 1 FROM raster WHERE raster."row" = c_custkey // 10 AND raster.col = c_custkey % 10 * 7)""")
def _(spark, d):
    c = F.col("c_custkey")
    cells = table(spark, d, "customer").select(
        F.floor(c / 10).alias("row"), (c % 10 * 7).alias("col"), F.col("c_acctbal").alias("v"))
    return masked(cells, raster(spark, d))


@check("f14_channel_dispatch", "", """SELECT DISTINCT event_type, CASE WHEN event_type = 'click' THEN 'HF' ELSE 'LF' END AS freq,
    CASE WHEN event_type = 'click' THEN 65.0 ELSE 70.0 END::DOUBLE AS far FROM events""")
def _(spark, d):
    e = table(spark, d, "events").select("event_type").distinct()
    name = F.when(F.col("event_type") == "click", "hf_port").otherwise("lf_stbd")
    return e.select("event_type", A.frequency_of(F.array(name)).alias("freq"), A.far_cutoff(name).alias("far"))


assert math.isclose(LIMITS[0], 8.821, abs_tol=1e-3)
