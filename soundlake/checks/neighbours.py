"""Nearest neighbours and inverse-distance gridding: cells of the orders raster against customer spots."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.checks.base import check, r, r5, spot, sql5, table
from soundlake.checks.rasters import ROWS, blur_sql
from soundlake.operators.knn import confidence, idw, nearest
from soundlake.plans import jobs

CELLS = """cl AS (SELECT o_orderkey AS q, (o_orderkey % 125) * 8.0 AS qx, (o_orderkey // 125) * 8.0 AS qy FROM orders),
    pr AS (SELECT q, id, v, (x - qx) * (x - qx) + (y - qy) * (y - qy) AS d2 FROM cl, spot),
    rk AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, id) AS rank FROM pr{where})"""


def cells(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k.alias("q"), (k % 125 * 8.0).alias("qx"), (F.floor(k / 125) * 8.0).alias("qy"))


def spots(spark, d):
    return spot(spark, d).withColumnsRenamed({"x": "px", "y": "py"})


@check("j4_knn_radius", "spot", "WITH " + CELLS.replace("{where}", " WHERE d2 < 4900") + " SELECT q, id, CAST(rank AS INTEGER) AS rank, ROUND(d2, 4) AS d2 FROM rk WHERE rank <= 12")
def _(spark, d):
    n = nearest(cells(spark, d), spots(spark, d), ["q"], ["id"], 12, 70.0, leaf=10.0)
    return n.select("q", "id", "rank", r("d2", 4).alias("d2"))


@check("j5_knn_unbounded", "spot", "WITH " + CELLS.replace("{where}", "") + " SELECT q, id, CAST(rank AS INTEGER) AS rank, ROUND(d2, 4) AS d2 FROM rk WHERE rank <= 12")
def _(spark, d):
    n = nearest(cells(spark, d), spots(spark, d), ["q"], ["id"], 12, None, leaf=10.0)
    return n.select("q", "id", "rank", r("d2", 4).alias("d2"))


@check("j7_nearest_label", "spot", "WITH " + CELLS.replace("{where}", " WHERE d2 < 506.25") + " SELECT q, id FROM rk WHERE rank = 1")
def _(spark, d):
    return nearest(cells(spark, d), spots(spark, d), ["q"], ["id"], 1, 15.0 * 1.5, leaf=10.0).select("q", "id")


@check("j4_knn_hot_spot", "", """WITH sp AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 404.25 ELSE c_custkey * 7919 % 10007 / 10.0 END AS x, CASE WHEN c_custkey % 3 = 0 THEN 404.25 ELSE c_custkey * 104729 % 10009 / 10.0 END AS y FROM customer),
    cl AS (SELECT o_orderkey AS q, (o_orderkey % 125) * 8.0 AS qx, (o_orderkey // 125) * 8.0 AS qy FROM orders),
    rk AS (SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY (x - qx) * (x - qx) + (y - qy) * (y - qy), id) AS rank FROM cl, sp WHERE (x - qx) * (x - qx) + (y - qy) * (y - qy) < 4900)
    SELECT q, id, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 12""")
def _(spark, d):
    hot = F.col("id") % 3 == 0
    p = spot(spark, d).select("id", F.when(hot, 404.25).otherwise(F.col("x")).alias("px"), F.when(hot, 404.25).otherwise(F.col("y")).alias("py"))
    return nearest(cells(spark, d), p, ["q"], ["id"], 12, 70.0, leaf=10.0).select("q", "id", "rank")


@check("j4_knn_crowded_tile", "", """WITH sp AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 404 + c_custkey * 7919 % 10007 / 20014.0 ELSE c_custkey * 7919 % 10007 / 10.0 END AS x, CASE WHEN c_custkey % 3 = 0 THEN 404 + c_custkey * 104729 % 10009 / 20018.0 ELSE c_custkey * 104729 % 10009 / 10.0 END AS y FROM customer),
    cl AS (SELECT o_orderkey AS q, (o_orderkey % 125) * 8.0 AS qx, (o_orderkey // 125) * 8.0 AS qy FROM orders),
    rk AS (SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY (x - qx) * (x - qx) + (y - qy) * (y - qy), id) AS rank FROM cl, sp WHERE (x - qx) * (x - qx) + (y - qy) * (y - qy) < 4900)
    SELECT q, id, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 5""")
def _(spark, d):
    # A third of the points lies at different places of half a metre, far below the tile size asked for.
    k, hot = F.col("id"), F.col("id") % 3 == 0
    px = F.when(hot, 404 + k * 7919 % 10007 / 20014.0).otherwise(F.col("x"))
    py = F.when(hot, 404 + k * 104729 % 10009 / 20018.0).otherwise(F.col("y"))
    return nearest(cells(spark, d), spot(spark, d).select("id", px.alias("px"), py.alias("py")), ["q"], ["id"], 5, 70.0, leaf=10.0).select("q", "id", "rank")


@check("g1_idw_radius", "spot", "WITH " + CELLS.replace("{where}", " WHERE d2 < 4900") + """ SELECT q, ROUND(least(greatest(sum(v / 200 / (d2 + 1e-6)) / sum(1 / (d2 + 1e-6)), 0), 50), 6) AS v, ROUND(sqrt(min(d2)), 6) AS nearest FROM rk WHERE rank <= 12 GROUP BY q""")
def _(spark, d):
    p = spots(spark, d).withColumn("v", F.col("v") / 200)
    g = idw(cells(spark, d), p, ["q"], ["id"], "v", 12, 70.0, leaf=10.0)
    v = F.greatest(F.lit(0.0), F.least(F.lit(50.0), "v"))
    return g.select("q", r(v).alias("v"), r("nearest").alias("nearest"))


@check("g2_idw_unbounded", "spot", "WITH " + CELLS.replace("{where}", "") + """, near AS (SELECT q FROM pr WHERE v > 0 GROUP BY q HAVING min(d2) <= 2500), g AS (SELECT q, ROUND(sum(v / greatest(d2, 1e-12)) / sum(1 / greatest(d2, 1e-12)), 5) AS v FROM rk WHERE rank <= 12 GROUP BY q)
    SELECT q, v FROM g SEMI JOIN near USING (q)""")
def _(spark, d):
    c = cells(spark, d)
    hit = nearest(c, spots(spark, d).where("v > 0"), ["q"], ["id"], 1, 50.0 * (1 + 1e-9), leaf=10.0).where("d2 <= 2500")
    c = c.join(hit.select("q"), "q", "left_semi")
    return idw(c, spots(spark, d), ["q"], ["id"], "v", 12, None, leaf=10.0, floor_distance=True).select("q", r("v", 5).alias("v"))


THICK = """cl AS (SELECT "row", col, col + 0.5::DOUBLE AS qx, n - ("row" + 0.5::DOUBLE) AS qy, CAST(floor(z) AS INTEGER) % 7 AS cls FROM raster, (SELECT max(o_orderkey) // 100 + 1 AS n FROM orders)),
    pk AS (SELECT id, x / 10 AS x, y / 7 AS y, abs(v) / 5000 AS t FROM spot),
    pr AS (SELECT "row", col, id, t, (x - qx) * (x - qx) + (y - qy) * (y - qy) AS d2 FROM cl JOIN pk ON abs(x - qx) <= 6 AND abs(y - qy) <= 6),
    nn AS (SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY d2, id) AS k FROM pr WHERE d2 < 36),
    me AS (SELECT "row", col, sum(t / (d2 + 1e-6)) / sum(1 / (d2 + 1e-6)) AS t FROM nn WHERE k <= 12 GROUP BY ALL),
    hy AS (SELECT cl."row", cl.col, coalesce(me.t, CASE cls WHEN 0 THEN 0.05 WHEN 1 THEN 0.15 WHEN 2 THEN 0.3 WHEN 3 THEN 0.5 WHEN 4 THEN 0.8 WHEN 5 THEN 1.2 ELSE 2.0 END::DOUBLE) AS z, CASE WHEN me.t IS NOT NULL THEN 1 ELSE 0 END AS source FROM cl LEFT JOIN me USING ("row", col))"""


@check("g3_thickness_layer", "raster spot", f"WITH {THICK}, " + blur_sql(2, 8, ROWS).replace("{src}", "hy") + """ SELECT "row", col, ROUND(s, 5) AS isopach, source FROM bl JOIN hy USING ("row", col)""")
def _(spark, d):
    from soundlake.checks.base import raster, raster_grid

    classes = raster(spark, d).select("row", "col", (F.floor("z") % 7).cast("int").alias("sediment_class"))
    picks = spot(spark, d).select("id", (F.col("x") / 10).alias("x"), (F.col("y") / 7).alias("y"), (F.abs("v") / 5000).alias("thickness"))
    out = jobs.thickness_layer(picks, ["id"], classes, raster_grid(spark, d), gap=6.0, sigma=2.0)
    return out.select("row", "col", r("isopach", 5).alias("isopach"), "source")


@check("g3_thickness_unmeasured", "raster spot", f"""WITH {THICK} SELECT "row", col, CASE cls WHEN 0 THEN 0.05 WHEN 1 THEN 0.15 WHEN 2 THEN 0.3 WHEN 3 THEN 0.5 WHEN 4 THEN 0.8 WHEN 5 THEN 1.2 ELSE 2.0 END::DOUBLE AS isopach, 0 AS source FROM cl""")
def _(spark, d):
    from soundlake.checks.base import raster, raster_grid

    classes = raster(spark, d).select("row", "col", (F.floor("z") % 7).cast("int").alias("sediment_class"))
    picks = spot(spark, d).select("id", (F.col("x") - 5000).alias("x"), F.col("y"), (F.abs("v") / 5000).alias("thickness"))  # all out of reach
    out = jobs.thickness_layer(picks, ["id"], classes, raster_grid(spark, d), gap=6.0, sigma=2.0)
    return out.select("row", "col", "isopach", "source")


@check("g4_confidence", "spot", "WITH " + CELLS.replace("{where}", "") + """, n AS (SELECT q, sqrt(min(d2)) AS d FROM pr GROUP BY q) SELECT q, CASE WHEN d <= 8 THEN 0 WHEN d < 40 THEN 1 END AS confidence FROM n""")
def _(spark, d):
    c = cells(spark, d)
    n = nearest(c, spots(spark, d), ["q"], ["id"], 1, 40.0, leaf=10.0).withColumn("d", F.sqrt("d2"))
    return c.select("q").join(n.select("q", "d"), "q", "left").select("q", confidence(F.col("d"), 8.0).alias("confidence"))


@check("g5_valid_cells", "raster spot", """SELECT "row", col, col + 5e-1 AS x, 150 - ("row" + 5e-1) AS y FROM raster""")
def _(spark, d):
    from soundlake.checks.base import raster
    from soundlake.operators.raster import Grid

    return Grid(0.0, 150.0, 1.0, 150, 100).centres(raster(spark, d).select("row", "col"))


@check("r9_hole_fill", "raster", f"""WITH kn AS (SELECT "row", col, z, CAST(floor(z) AS INTEGER) AS label FROM raster WHERE ("row" * 7 + col * 3) % 5 > 1 AND NOT (col BETWEEN 20 AND 30)),
    ho AS (SELECT "row", col FROM raster ANTI JOIN kn USING ("row", col)),
    pr AS (SELECT h."row", h.col, kn.z, kn.label, pow(kn.col - h.col, 2) + pow(kn."row" - h."row", 2) AS d2, row_number() OVER (PARTITION BY h."row", h.col ORDER BY pow(kn.col - h.col, 2) + pow(kn."row" - h."row", 2), kn."row", kn.col) AS k
      FROM ho h JOIN kn ON kn."row" BETWEEN h."row" - 5 AND h."row" + 5 AND kn.col BETWEEN h.col - 5 AND h.col + 5)
    SELECT "row", col, z, label, false AS filled FROM kn UNION ALL SELECT "row", col, {sql5('sum(z / (d2 + 1e-6)) FILTER (WHERE k <= 4 AND d2 < 9) / sum(1 / (d2 + 1e-6)) FILTER (WHERE k <= 4 AND d2 < 9)')}, max(label) FILTER (WHERE k = 1), true FROM pr GROUP BY "row", col HAVING min(d2) < 20.25""")
def _(spark, d):
    from soundlake.checks.base import raster
    from soundlake.operators.raster import fill_holes

    g = raster(spark, d)
    kn = g.where("(row * 7 + col * 3) % 5 > 1 and not (col between 20 and 30)").withColumn("label", F.floor("z").cast("int"))
    out = fill_holes(kn, g, "z", "label", 0.5)
    return out.select("row", "col", F.when(F.col("filled"), r5("z")).otherwise(F.col("z")).alias("z"), "label", "filled")
