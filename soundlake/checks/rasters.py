"""Raster filters, layer algebra, blur, contours."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.checks.base import check, holed, r, r5, raster, raster_grid, spot, sql5, table
from soundlake.checks.scalars import dbl
from soundlake.functions.geo import series
from soundlake.operators import lines as L
from soundlake.operators import raster as R
from soundlake.operators.raster import Grid
from soundlake.plans import jobs

DENSE = """dn AS (SELECT CAST(o_orderkey // 100 AS INTEGER) AS r, CAST(o_orderkey % 100 AS INTEGER) AS c, z FROM orders LEFT JOIN raster ON raster."row" = o_orderkey // 100 AND raster.col = o_orderkey % 100)"""


HOLED = """dn AS (SELECT "row" AS r, col AS c, z FROM holed)"""


def box_sql(n: int, aggs: str, lo: int | None = None) -> str:
    lo = n if lo is None else lo
    return f"""SELECT a.r, a.c, any_value(a.z) AS z, {aggs} FROM dn a JOIN dn b ON b.r BETWEEN a.r - {lo} AND a.r + {n} AND b.c BETWEEN a.c - {lo} AND a.c + {n} WHERE a.z IS NOT NULL GROUP BY a.r, a.c"""


@check("r1_erosion", "holed", f"""WITH {HOLED}, b AS ({box_sql(2, 'count(b.z) AS n')}) SELECT r AS "row", c AS col, z FROM b WHERE n = 25""")
def _(spark, d):
    return R.erode(holed(spark, d), raster_grid(spark, d), "z", 2).select("row", "col", "z")


GRAD = """g AS (SELECT a."row", a.col, a.z, (e.z - w.z) / 2 AS zx, (s.z - n.z) / 2 AS zy FROM raster a
    LEFT JOIN raster e ON e."row" = a."row" AND e.col = a.col + 1 LEFT JOIN raster w ON w."row" = a."row" AND w.col = a.col - 1
    LEFT JOIN raster s ON s."row" = a."row" + 1 AND s.col = a.col LEFT JOIN raster n ON n."row" = a."row" - 1 AND n.col = a.col)"""


@check("r2_slope", "raster", f"""WITH {GRAD} SELECT "row", col, ROUND(degrees(atan(sqrt(zx * zx + zy * zy))), 6) AS slope FROM g""")
def _(spark, d):
    return R.slope(raster(spark, d), "z", 1.0).select("row", "col", r("slope").alias("slope"))


VRM = f"""{GRAD}, u AS (SELECT *, atan(sqrt(zx * zx + zy * zy)) AS s, atan2(zy, zx) AS a FROM g WHERE zx IS NOT NULL AND zy IS NOT NULL),
    v AS (SELECT a."row", a.col, count(*) AS n, sqrt(pow(sum(sin(b.s) * cos(b.a)), 2) + pow(sum(sin(b.s) * sin(b.a)), 2) + pow(sum(cos(b.s)), 2)) AS len
      FROM raster a JOIN u b ON b."row" BETWEEN a."row" - 2 AND a."row" + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 GROUP BY ALL)"""


@check("r3_ruggedness", "raster", f"""WITH {VRM} SELECT "row", col, ROUND(1 - len / 25, 6) AS vrm FROM v WHERE n = 25""")
def _(spark, d):
    out = R.ruggedness(raster(spark, d), raster_grid(spark, d), "z")
    return out.where("vrm is not null").select("row", "col", r("vrm").alias("vrm"))


@check("r4_position_index", "holed", f"""WITH {HOLED}, o AS ({box_sql(10, 'sum(b.z) AS s, count(b.z) AS n')}), i AS ({box_sql(1, 'sum(b.z) AS s, count(b.z) AS n')})
    SELECT o.r AS "row", o.c AS col, {sql5('o.z - (o.s - i.s) / (o.n - i.n)')} AS bpi FROM o JOIN i ON o.r = i.r AND o.c = i.c""")
def _(spark, d):
    out = R.position_index(holed(spark, d), raster_grid(spark, d), "z").where("bpi is not null")
    return out.select("row", "col", r5("bpi").alias("bpi"))


def terrain_sql(outer: int, digits: int) -> str:
    side = 2 * outer + 1
    return f"""WITH {DENSE}, o AS ({box_sql(outer, 'sum(b.z) AS s, count(b.z) AS n')}), i AS ({box_sql(1, 'sum(b.z) AS s')}), {VRM}
    SELECT o.r AS "row", o.c AS col, ROUND(degrees(atan(sqrt(zx * zx + zy * zy))), {digits}) AS slope, ROUND(1 - len / 25, {digits}) AS vrm, {sql5(f'o.z - (o.s - i.s) / {side * side - 9}', digits)} AS bpi
    FROM o JOIN i ON o.r = i.r AND o.c = i.c JOIN g ON g."row" = o.r AND g.col = o.c JOIN v ON v."row" = o.r AND v.col = o.c WHERE o.n = {side * side}"""


@check("r_terrain_layers", "raster", terrain_sql(3, 6))
def _(spark, d):
    t = R.terrain(raster(spark, d), raster_grid(spark, d), "z", outer=3)
    return t.select("row", "col", r("slope").alias("slope"), r("vrm").alias("vrm"), r5("bpi").alias("bpi"))


def blur_sql(sigma: float, radius: int, rows: str) -> str:
    def fold(i: str, n: str) -> str:
        m = f"((({i}) % (2 * {n}) + 2 * {n}) % (2 * {n}))"
        return f"CASE WHEN {m} < {n} THEN {m} ELSE 2 * {n} - 1 - {m} END"

    # Mirrored images fold the kernel into one weight per (target, source) of a line.
    return f"""kk AS (SELECT o, exp(-0.5 * pow(o / {sigma}::DOUBLE, 2)) AS k FROM (SELECT unnest(range(-{radius}, {radius} + 1)) AS o)), kr AS (SELECT o, k / (SELECT sum(k) FROM kk) AS k FROM kk),
    nr AS (SELECT {rows} AS n), m AS (SELECT * FROM {{src}} WHERE z IS NOT NULL),
    wc AS (SELECT p, {fold('p + o', '100')} AS src, sum(k) AS k FROM (SELECT unnest(range(100)) AS p), kr GROUP BY ALL),
    wr AS (SELECT p, {fold('p + o', 'n')} AS src, sum(k) AS k FROM (SELECT unnest(range(n)) AS p, n FROM nr), kr GROUP BY ALL),
    ac AS (SELECT "row", p AS col, sum(k * z) AS num, sum(k) AS den FROM m JOIN wc ON src = m.col GROUP BY ALL),
    ar AS (SELECT p AS "row", col, sum(k * num) AS num, sum(k * den) AS den FROM ac JOIN wr ON src = ac."row" GROUP BY ALL),
    bl AS (SELECT CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col, num / den AS s FROM ar WHERE den > 0.1)"""


ROWS = "(SELECT max(o_orderkey) // 100 + 1 FROM orders)"


@check("r5_blur_small", "raster", "WITH " + blur_sql(1, 4, ROWS).replace("{src}", "raster") + """ SELECT "row", col, ROUND(s, 6) AS smooth FROM bl""")
def _(spark, d):
    return R.blur(raster(spark, d), raster_grid(spark, d), "z", 1.0).select("row", "col", r("smooth").alias("smooth"))


SPARSE = """sp AS (SELECT "row", col, CASE WHEN "row" % 40 < 12 AND col < 60 THEN z END AS z FROM raster)"""


@check("r5_blur_bleed", "raster", f"WITH {SPARSE}, " + blur_sql(8, 32, ROWS).replace("{src}", "sp") + """ SELECT "row", col, ROUND(s, 6) AS smooth FROM bl""")
def _(spark, d):
    g = raster(spark, d).withColumn("z", F.expr("CASE WHEN row % 40 < 12 AND col < 60 THEN z END"))
    return R.blur(g, raster_grid(spark, d), "z", 8.0).select("row", "col", r("smooth").alias("smooth"))


@check("r5_blur_wide", "raster", "WITH " + blur_sql(400, 1600, ROWS).replace("{src}", "raster") + """ SELECT "row", col, ROUND(s, 6) AS smooth FROM bl SEMI JOIN raster USING ("row", col)""")
def _(spark, d):
    b = R.blur(raster(spark, d), raster_grid(spark, d), "z", 400.0)
    return R.masked(b, raster(spark, d)).select("row", "col", r("smooth").alias("smooth"))


@check("r6_extrema", "spot", """WITH s AS (SELECT CAST(id // 50 AS INTEGER) AS "row", CAST(id % 50 AS INTEGER) AS col, CASE WHEN id % 13 <> 0 THEN v END AS v FROM spot)
    SELECT a."row", a.col, any_value(a.v) AS v FROM s a JOIN s b ON b."row" BETWEEN a."row" - 4 AND a."row" + 3 AND b.col BETWEEN a.col - 4 AND a.col + 3
    WHERE abs(a.v) > 100 GROUP BY a."row", a.col HAVING any_value(abs(a.v)) = max(abs(b.v))""")
def _(spark, d):
    i = F.col("id")
    s = spot(spark, d).select(F.floor(i / 50).cast("int").alias("row"), (i % 50).cast("int").alias("col"), F.when(i % 13 != 0, F.col("v")).alias("v"))
    n = table(spark, d, "customer").count()
    return R.extrema(s, Grid(0, 0, 1, n // 50 + 1, 50), "v", 100.0, 8).select("row", "col", "v")


CONTOUR = """q AS (SELECT a."row", a.col, a.s AS a, b.s AS b, d.s AS d, e.s AS e FROM {t} a JOIN {t} b ON b."row" = a."row" AND b.col = a.col + 1 JOIN {t} d ON d."row" = a."row" + 1 AND d.col = a.col JOIN {t} e ON e."row" = a."row" + 1 AND e.col = a.col + 1),
    lv AS (SELECT *, unnest(generate_series(5, 55, 5)) AS lev FROM q), hit AS (SELECT *, (a >= lev)::INT + 2 * (b >= lev)::INT + 4 * (e >= lev)::INT + 8 * (d >= lev)::INT AS code, (a + b + d + e) / 4 >= lev AS mid FROM lv),
    pt AS (SELECT *, {'x': col + (lev - a) / nullif(b - a, 0), 'y': "row" + 0.0::DOUBLE} AS t, {'x': col + (lev - d) / nullif(e - d, 0), 'y': "row" + 1.0::DOUBLE} AS bo, {'x': col + 0.0::DOUBLE, 'y': "row" + (lev - a) / nullif(d - a, 0)} AS l, {'x': col + 1.0::DOUBLE, 'y': "row" + (lev - b) / nullif(e - b, 0)} AS r FROM hit),
    sg AS (SELECT *, unnest(CASE WHEN code IN (0, 15) THEN [] WHEN code IN (1, 14) THEN [[l, t]] WHEN code IN (2, 13) THEN [[t, r]] WHEN code IN (4, 11) THEN [[r, bo]] WHEN code IN (7, 8) THEN [[bo, l]] WHEN code IN (3, 12) THEN [[l, r]] WHEN code IN (6, 9) THEN [[t, bo]]
      WHEN (code = 5) = mid THEN [[t, r], [bo, l]] ELSE [[l, t], [r, bo]] END) AS g FROM pt)
    SELECT "row", col, CAST(lev AS BIGINT) AS depth_m, CASE WHEN lev % 10 = 0 THEN 'major' ELSE 'minor' END AS kind, ROUND(g[1].x + 0.5, 6) AS x1, ROUND({rows} - g[1].y - 0.5, 6) AS y1, ROUND(g[2].x + 0.5, 6) AS x2, ROUND({rows} - g[2].y - 0.5, 6) AS y2 FROM sg"""


@check("r8_contours", "raster", "WITH rs AS (SELECT \"row\", col, z AS s FROM raster), " + CONTOUR.replace("{t}", "rs").replace("{rows}", ROWS))
def _(spark, d):
    return rounded(R.contour_segments(raster(spark, d), raster_grid(spark, d), "z"))


@check("r8_contours_smooth", "raster", "WITH " + blur_sql(1, 4, ROWS).replace("{src}", "raster") + ", " + CONTOUR.replace("{t}", "bl").replace("{rows}", ROWS).replace(", 6) AS", ", 4) AS"))
def _(spark, d):
    return rounded(jobs.depth_contours(raster(spark, d), raster_grid(spark, d), sigma=1.0), 4)


def crossing_sql(side: str, to: str) -> str:
    """Key and position of a quad's crossing on one of its sides."""
    return f"""(("row" + ({side} = 2)::BIGINT) * 101 + col + ({side} = 1)::BIGINT) * 2 + ({side} IN (1, 3))::BIGINT AS {to},
        CASE {side} WHEN 0 THEN col + (lev - a) / (b - a) WHEN 1 THEN col + 1 WHEN 2 THEN col + (lev - d) / (e - d) ELSE col END AS {to}x,
        CASE {side} WHEN 0 THEN "row" WHEN 1 THEN "row" + (lev - b) / (e - b) WHEN 2 THEN "row" + 1 ELSE "row" + (lev - a) / (d - a) END AS {to}y"""


# Directed segments by crossing keys, walked one step a round: open lines from their heads, rings from each crossing below its neighbours, until a lower one shows that
# the ring starts elsewhere.
LINES = (
    CONTOUR[: CONTOUR.index("    pt AS")]
    + f"""    pr AS (SELECT *, unnest(CASE WHEN code IN (0, 15) THEN [] WHEN code IN (1, 14) THEN [[3, 0]] WHEN code IN (2, 13) THEN [[0, 1]] WHEN code IN (4, 11) THEN [[1, 2]] WHEN code IN (7, 8) THEN [[2, 3]] WHEN code IN (3, 12) THEN [[3, 1]]
      WHEN code IN (6, 9) THEN [[0, 2]] WHEN (code = 5) = mid THEN [[0, 1], [2, 3]] ELSE [[3, 0], [1, 2]] END) AS k FROM hit),
    en AS (SELECT *, (code >> k[1]) & 1 > (code >> ((k[1] + 1) % 4)) & 1 AS falls FROM pr),
    di AS (SELECT *, CASE WHEN falls THEN k[1] ELSE k[2] END AS i, CASE WHEN falls THEN k[2] ELSE k[1] END AS j FROM en),
    ds AS MATERIALIZED (SELECT lev, {crossing_sql('i', 'u')}, {crossing_sql('j', 'v')} FROM di),
    hd AS (SELECT lev, u AS line, false AS ring, 0 AS ord, v FROM ds ANTI JOIN (SELECT lev, v AS u FROM ds) USING (lev, u)
      UNION ALL SELECT s.lev, s.u, true, 0, s.v FROM ds s JOIN ds p ON p.lev = s.lev AND p.v = s.u WHERE s.u < p.u AND s.u < s.v),
    wk AS (SELECT * FROM hd UNION ALL SELECT wk.lev, line, ring, ord + 1, ds.v FROM wk JOIN ds ON ds.lev = wk.lev AND ds.u = wk.v WHERE NOT ring OR ds.u > line),
    ln AS (SELECT lev, line, ring, max(ord) + 2 AS n FROM wk GROUP BY lev, line, ring HAVING NOT ring OR bool_or(v = line)),
    ev AS (SELECT lev, line, ring, n, ord, ux AS px, uy AS py FROM ln JOIN wk USING (lev, line, ring) JOIN ds USING (lev, v) UNION ALL SELECT lev, line, ring, n, n - 1, vx, vy FROM ln JOIN wk USING (lev, line, ring) JOIN ds USING (lev, v) WHERE ord = n - 2)"""
)
def unproject_sql(source: str) -> str:
    """``source`` with x, y as well as lon, lat."""
    s = series()
    xi0 = "xi" + "".join(f" - {dbl(v)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, v in enumerate(s["beta"], 1))
    eta0 = "eta" + "".join(f" - {dbl(v)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, v in enumerate(s["beta"], 1))
    phi = "chi" + "".join(f" + {dbl(v)} * sin({2 * j} * chi)" for j, v in enumerate(s["delta"], 1))
    scale = f"(0.9999e0 * {dbl(s['rect'])})"
    return f"""(SELECT *, 121 + degrees(atan2(sinh(eta0), cos(xi0))) AS lon, degrees({phi}) AS lat FROM (SELECT *, asin(sin(xi0) / cosh(eta0)) AS chi FROM
      (SELECT *, {xi0} AS xi0, {eta0} AS eta0 FROM (SELECT *, y / {scale} AS xi, (x - 250000e0) / {scale} AS eta FROM {source}))))"""


@check("r8_contour_lines", "raster", "WITH RECURSIVE rs AS (SELECT \"row\", col, z AS s FROM raster), " + LINES.replace("{t}", "rs") + f"""
    SELECT lev::BIGINT AS depth_m, CASE WHEN lev % 10 = 0 THEN 'major' ELSE 'minor' END AS kind, line, ord::BIGINT AS ord, n::BIGINT AS n, ring AS closed, ROUND(px + 0.5, 6) AS x, ROUND({ROWS} - py - 0.5, 6) AS y FROM ev""")
def _(spark, d):
    p = L.contour_lines(raster(spark, d), raster_grid(spark, d), "z")
    return p.select("depth_m", "kind", "line", "ord", "n", "closed", r("x").alias("x"), r("y").alias("y"))


@check("s13_contour_features", "raster", "WITH RECURSIVE " + blur_sql(1, 4, ROWS).replace("{src}", "raster") + ", " + LINES.replace("{t}", "bl") + f""",
    xy AS (SELECT *, 227173.5e0 + (px + 0.5) * 0.5 AS x, 2449210.5e0 - (py + 0.5) * 0.5 AS y FROM ev),
    ft AS (SELECT lev, line, ring, list([ROUND(lon + 1.23e-10, 7), ROUND(lat + 1.23e-10, 7)] ORDER BY ord) AS c FROM {unproject_sql('xy')} GROUP BY lev, line, ring)
    SELECT lev::BIGINT AS depth_m, CASE WHEN lev % 10 = 0 THEN 'major' ELSE 'minor' END AS kind, line, 0::BIGINT AS part, ring AS closed, len(c)::BIGINT AS n,
      '{{"type":"Feature","properties":{{"depth_m":' || lev::DOUBLE || ',"level":"' || CASE WHEN lev % 10 = 0 THEN 'major' ELSE 'minor' END || '"}},"geometry":{{"type":"LineString","coordinates":' || replace(CAST(c AS VARCHAR), ' ', '') || '}}}}' AS feature FROM ft""")
def _(spark, d):
    g = raster_grid(spark, d)
    return jobs.contour_features(raster(spark, d), Grid(227173.5, 2449210.5, 0.5, g.nrows, g.ncols), sigma=1.0)


def rounded(c, n=6):
    return c.select("row", "col", "depth_m", "kind", *[r(x, n).alias(x) for x in ("x1", "y1", "x2", "y2")])


@check("a7_xyz_grid", "", """WITH p AS (SELECT ROUND(100 + (o_orderkey % 100) * 0.5 + 0.0001, 3) AS x, ROUND(900 - (o_orderkey // 100) * 0.5, 3) AS y, abs(-o_totalprice) AS z FROM orders),
    c AS (SELECT min(x) AS x0, max(y) AS y0 FROM p) SELECT CAST(ROUND((y0 - y) / 0.5) AS INTEGER) AS "row", CAST(ROUND((x - x0) / 0.5) AS INTEGER) AS col, avg(z) AS z, count(*) AS n FROM p, c GROUP BY ALL""")
def _(spark, d):
    k = F.col("o_orderkey")
    xyz = table(spark, d, "orders").select(
        (F.lit(100) + (k % 100) * 0.5 + 0.0001).alias("x"), (F.lit(900) - F.floor(k / 100) * 0.5).alias("y"), (-F.col("o_totalprice")).alias("z"))
    return R.points_to_grid(xyz, 0.5)


@check("j2_raster_lookup", "raster spot", f"""SELECT id, z FROM (SELECT id, x / 8 - 5 AS px, y * n / 1000 - 3 AS py, n FROM spot, (SELECT {ROWS} AS n)) LEFT JOIN raster ON "row" = floor(n - py) AND col = floor(px)""")
def _(spark, d):
    g = raster_grid(spark, d)
    p = spot(spark, d).select("id", (F.col("x") / 8 - 5).alias("px"), (F.col("y") * g.nrows / 1000 - 3).alias("py"))
    return R.lookup(p, raster(spark, d), g, "px", "py", ["z"]).select("id", "z")


@check("j3_nearest_centre", "raster spot", f"""WITH sz AS (SELECT {ROWS} AS n), g AS (SELECT id, floor(x) / 8 AS x, floor(y) * n / 950 AS y, n FROM spot, sz)
    SELECT id, (SELECT arg_min(c, (abs(c + 0.5 - x), c)) FROM (SELECT unnest(generate_series(greatest(0, least(98, x::BIGINT - 2)), greatest(1, least(99, x::BIGINT + 2)))) AS c))::INTEGER AS col,
      (SELECT arg_min(r, (abs(n - (r + 0.5) - y), r)) FROM (SELECT unnest(generate_series(greatest(0, least(n - 2, (n - y)::BIGINT - 2)), greatest(1, least(n - 1, (n - y)::BIGINT + 2)))) AS r))::INTEGER AS "row" FROM g""")
def _(spark, d):
    from soundlake.functions.geo import nearest_centre

    n = raster_grid(spark, d).nrows
    s = spot(spark, d)
    return s.select("id", nearest_centre(F.floor("x") / 8, 0.5, 1.0, 100).alias("col"), nearest_centre(-(F.floor("y") * n / 950), 0.5 - n, 1.0, n).alias("row"))


@check("j9_class_attributes", "", """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'Coarse sand' WHEN 1 THEN 'Fine sand / Silty sand' WHEN 2 THEN 'Silt / Sandy silt' WHEN 3 THEN 'Sand-silt-clay' WHEN 4 THEN 'Compacted mud'
    WHEN 5 THEN 'Clayey silt / Silty clay' WHEN 6 THEN 'Fluid mud' ELSE 'class ' || (o_orderkey % 9) END AS label, CASE o_orderkey % 9 WHEN 0 THEN 0.05 WHEN 1 THEN 0.15 WHEN 2 THEN 0.3 WHEN 3 THEN 0.5 WHEN 4 THEN 0.8 WHEN 5 THEN 1.2 WHEN 6 THEN 2.0 END::DOUBLE AS thickness FROM orders""")
def _(spark, d):
    from soundlake.functions.acoustic import class_label, sediment_table

    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 9).cast("int").alias("class_id"))
    j = o.join(F.broadcast(sediment_table(spark).select("class_id", "thickness")), "class_id", "left")
    return j.select("o_orderkey", class_label(F.col("class_id")).alias("label"), "thickness")


SECOND = """b AS (SELECT "row", col, z * 2 - col AS w FROM raster WHERE ("row" + col) % 4 <> 0)"""


def second(spark, d):
    return raster(spark, d).where("(row + col) % 4 <> 0").select("row", "col", (F.col("z") * 2 - F.col("col")).alias("w"))


@check("j11_residual", "raster", f"""WITH {SECOND} SELECT a."row", a.col, ROUND(a.z - b.w, 6) AS residual FROM raster a JOIN b USING ("row", col)""")
def _(spark, d):
    return R.residual(raster(spark, d), second(spark, d), "z", "w").select("row", "col", r("residual").alias("residual"))


@check("j12_hybrid", "raster", f"""WITH {SECOND}, a AS (SELECT * FROM raster WHERE col < 40 OR "row" % 5 = 0) SELECT coalesce(b."row", a."row") AS "row", coalesce(b.col, a.col) AS col, coalesce(b.w, a.z) AS v,
    CASE WHEN b.w IS NOT NULL THEN 1 WHEN a.z IS NOT NULL THEN 0 END AS source FROM b FULL JOIN a USING ("row", col)""")
def _(spark, d):
    a = raster(spark, d).where("col < 40 or row % 5 = 0").withColumnRenamed("z", "v")
    return R.hybrid(second(spark, d).withColumnRenamed("w", "v"), a, "v")


@check("j13_holes", "raster", f"""WITH {SECOND} SELECT "row", col FROM raster ANTI JOIN b USING ("row", col)""")
def _(spark, d):
    return R.holes(raster(spark, d), second(spark, d))


@check("j6_align_layers", "raster", f"""WITH {SECOND} SELECT "row", col, a.z AS depth, b.w AS level FROM raster a FULL JOIN b USING ("row", col)""")
def _(spark, d):
    from soundlake.operators import cube

    a = raster(spark, d).select(F.lit("depth").alias("layer"), "row", "col", F.col("z").alias("value"))
    b = second(spark, d).select(F.lit("level").alias("layer"), "row", "col", F.col("w").alias("value"))
    cells = a.unionByName(b)
    return cube.build(cells, cube.present(cells, ["depth", "missing", "level"]))


COARSE = "dc AS (SELECT r, c, 1.2 + (c + 0.5) * 2.5 AS x, {rows} - 0.7 - (r + 0.5) * 2.5 AS y FROM (SELECT unnest(range(CAST({rows} / 2.5 - 3 AS BIGINT))) AS r), (SELECT unnest(range(45)) AS c))".replace("{rows}", ROWS)


def coarse(spark, d):
    src = raster_grid(spark, d)
    return src, Grid(1.2, src.nrows - 0.7, 2.5, round(src.nrows / 2.5 - 3), 45)


@check("j10_resample_nearest", "raster", f"""WITH {COARSE} SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, z FROM dc JOIN raster ON raster."row" = floor({ROWS} - y) AND raster.col = floor(x)""")
def _(spark, d):
    src, dst = coarse(spark, d)
    return R.resample_nearest(raster(spark, d), src, dst, "z")


@check("j10_resample_bilinear", "raster", f"""WITH {COARSE}, u AS (SELECT r, c, x - 0.5 AS u, {ROWS} - y - 0.5 AS v, x, y FROM dc WHERE x BETWEEN 0 AND 100 AND y BETWEEN 0 AND {ROWS}),
    p AS (SELECT r, c, a."row", a.col, z, (1 - abs(a.col - u)) * (1 - abs(a."row" - v)) AS w FROM u JOIN raster a ON a.col BETWEEN floor(u) AND floor(u) + 1 AND a."row" BETWEEN floor(v) AND floor(v) + 1)
    SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, {sql5('sum(w * z) / sum(w)')} AS z FROM p WHERE w > 0 GROUP BY ALL""")
def _(spark, d):
    src, dst = coarse(spark, d)
    return R.resample_bilinear(raster(spark, d), src, dst, "z").select("row", "col", r5("z").alias("z"))


@check("s9_grid_bounds", "raster", """SELECT min(col) * 0.5 + 10.0::DOUBLE AS "left", 500.0 - min("row") * 0.5::DOUBLE AS top, CAST(max("row") - min("row") + 1 AS INTEGER) AS nrows, CAST(max(col) - min(col) + 1 AS INTEGER) AS ncols FROM raster""")
def _(spark, d):
    g = Grid(10.0, 500.0, 0.5, 0, 0).centres(raster(spark, d))
    b = R.bounds_of(g, 0.5)
    return raster(spark, d).groupBy().agg(
        F.lit(b.left).alias("left"), F.lit(b.top).alias("top"), F.lit(b.nrows).alias("nrows"), F.lit(b.ncols).alias("ncols"))


@check("r7_label_median", "raster", """WITH l AS (SELECT "row" * 2 + col // 50 AS "row", col % 50 AS col, CASE WHEN z > 40 THEN CAST(floor(z) AS INTEGER) % 5 WHEN z > 4 THEN CAST(floor(z) AS INTEGER) % 3 ELSE -1 END AS l FROM raster),
    im AS (SELECT r, c, coalesce(l, -1) AS l FROM (SELECT DISTINCT "row" AS r FROM l), (SELECT unnest(range(50)) AS c) LEFT JOIN l ON l."row" = r AND l.col = c),
    v AS (SELECT a.r, a.c, any_value(a.l) AS l, list(b.l) AS ls FROM im a JOIN im b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 WHERE a.l >= 0 GROUP BY a.r, a.c)
    SELECT CAST(r AS BIGINT) AS "row", CAST(c AS INTEGER) AS bin, CAST(list_sort(list_concat(ls, list_resize([]::INT[], CAST(9 - len(ls) AS BIGINT), 0)))[5] AS INTEGER) AS smoothed FROM v""")
def _(spark, d):
    from soundlake.operators import radiometry as RM

    z = F.floor("z").cast("int")
    lab = F.when(F.col("z") > 40, z % 5).when(F.col("z") > 4, z % 3)
    g = raster(spark, d).select((F.col("row") * 2 + F.floor(F.col("col") / 50).cast("int")).alias("ping"), (F.col("col") % 50).alias("bin"), lab.alias("label"))
    full = RM.full_image(g, "ping")
    out = RM.label_image(full, "ping", "label")
    return out.select(F.col("row"), "bin", "smoothed")
