"""Cube queries and features on a cube made of the orders raster."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.checks.base import along, check, r, r5, raster, raster_grid, spot, sql5, table, track
from soundlake.checks.scalars import PROJECT_SQL
from soundlake.operators import along as T
from soundlake.operators import cube as C
from soundlake.operators.raster import Grid
from soundlake.operators.targets import rank_targets

LEFT, TOP, RES = 227173.5, 2449210.5, 5.0
LAYERS = ["bathymetry", "sediment_class", "rl", "isopach"]
ROWS = "(SELECT max(o_orderkey) // 100 + 1 FROM orders)"

CUBE = f"""cb AS (SELECT "row", col, {LEFT}::DOUBLE + (col + 0.5) * {RES} AS x, {TOP}::DOUBLE - ("row" + 0.5) * {RES} AS y, z AS bathymetry,
    CASE WHEN col % 10 <> 0 THEN CAST(floor(z) AS INTEGER) % 9 END AS sediment_class, z * 0.7 AS rl, CASE WHEN "row" % 5 <> 0 THEN z / 30 END AS isopach FROM raster),
    nr AS (SELECT {ROWS} AS n)"""


def the_grid(spark, d):
    top = table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0]
    return Grid(LEFT, TOP, RES, top // 100 + 1, 100)


def the_cube(spark, d):
    z = F.col("z")
    return raster(spark, d).select(
        "row", "col", z.alias("bathymetry"), F.when(F.col("col") % 10 != 0, F.floor(z).cast("int") % 9).alias("sediment_class"),
        (z * 0.7).alias("rl"), F.when(F.col("row") % 5 != 0, z / 30).alias("isopach"))


LABEL = "CASE CAST(v AS INT) WHEN 0 THEN 'Coarse sand' WHEN 1 THEN 'Fine sand / Silty sand' WHEN 2 THEN 'Silt / Sandy silt' WHEN 3 THEN 'Sand-silt-clay' WHEN 4 THEN 'Compacted mud' WHEN 5 THEN 'Clayey silt / Silty clay' WHEN 6 THEN 'Fluid mud' ELSE 'class ' || CAST(v AS INT) END"

NEAR = f"""pt AS (SELECT *, {LEFT}::DOUBLE + 2.5 AS x0, {TOP}::DOUBLE - 2.5 AS y0, n FROM xy, nr),
    ix AS (SELECT *, least(greatest(CAST(ceil((x - x0) / 5 - 0.5) AS INT), 0), 99) AS c, least(greatest(CAST(ceil((y0 - y) / 5 - 0.5) AS INT), 0), n - 1) AS rr,
      NOT (x BETWEEN x0 AND x0 + 99 * 5 AND y BETWEEN y0 - (n - 1) * 5 AND y0) AS outside FROM pt)"""


@check("q1_point_query", "raster spot", f"""WITH {CUBE}, g AS (SELECT id, lon, lat FROM (SELECT id, 120.778 + x / 160000 AS lon, 22.1345 + y / 130000 AS lat FROM spot)), {PROJECT_SQL}, {NEAR},
    h AS (SELECT ix.*, cb.* EXCLUDE (x, y) FROM ix LEFT JOIN cb ON cb."row" = rr AND cb.col = c AND NOT outside),
    u AS (SELECT id, x, y, outside, unnest(['bathymetry', 'sediment_class', 'rl', 'isopach']) AS layer, unnest([bathymetry, sediment_class::DOUBLE, rl, isopach]) AS v FROM h)
    SELECT id, round_even(x, 1) AS x, round_even(y, 1) AS y, outside, layer, round_even(v, 4) AS value, CASE WHEN layer = 'sediment_class' AND v IS NOT NULL THEN {LABEL} END AS class_label FROM u""")
def _(spark, d):
    p = spot(spark, d).select("id", (F.lit(120.778) + F.col("x") / 160000).alias("lon"), (F.lit(22.1345) + F.col("y") / 130000).alias("lat"))
    return C.point_query(p, the_cube(spark, d), the_grid(spark, d), LAYERS, "sediment_class")


BOXES = f"""bx AS (SELECT n_nationkey AS box, {LEFT}::DOUBLE + n_nationkey * 17 AS x0, {TOP}::DOUBLE - n_nationkey * 23 AS y0, {LEFT}::DOUBLE + n_nationkey * 17 + (n_nationkey % 7 - 3) * 33.3 AS x1, {TOP}::DOUBLE - n_nationkey * 23 - 77.7 AS y1 FROM nation)"""


def boxes(spark, d):
    k = F.col("n_nationkey")
    x0, y0 = F.lit(LEFT) + k * 17, F.lit(TOP) - k * 23
    return table(spark, d, "nation").select(
        k.alias("box"), x0.alias("x0"), y0.alias("y0"), (x0 + (k % 7 - 3) * 33.3).alias("x1"), (y0 - 77.7).alias("y1"))


INBOX = """ib AS (SELECT box, cb.* FROM bx JOIN cb ON x BETWEEN least(x0, x1) AND greatest(x0, x1) AND y BETWEEN least(y0, y1) AND greatest(y0, y1)),
    ul AS (SELECT box, unnest(['bathymetry', 'sediment_class', 'rl', 'isopach']) AS layer, unnest([bathymetry, sediment_class::DOUBLE, rl, isopach]) AS v FROM ib)"""


REGION = f"""WITH {CUBE}, {BOXES}, {INBOX}, nm AS (SELECT box, layer, round_even(min(v), 4) AS vmin, round_even(max(v), 4) AS vmax, round_even(sum(v) / count(v), 4) AS vmean FROM ul WHERE v IS NOT NULL AND layer <> 'sediment_class' GROUP BY ALL),
    ct AS (SELECT box, v, count(*) AS n FROM ul WHERE v IS NOT NULL AND layer = 'sediment_class' GROUP BY ALL),
    dm AS (SELECT box, arg_max(v, (n, -v)) AS v, ROUND(100.0 * max(n) / sum(n), 1) AS purity FROM ct GROUP BY box),
    ls AS (SELECT box, x0, x1, y0, y1, unnest(['bathymetry', 'sediment_class', 'rl', 'isopach']) AS layer FROM bx)
    SELECT ls.box, ls.layer, round_even(abs(x1 - x0), 1) AS width_m, round_even(abs(y1 - y0), 1) AS height_m, vmin, vmax, vmean, CASE WHEN ls.layer = 'sediment_class' AND v IS NOT NULL THEN {LABEL} END AS dominant, CASE WHEN ls.layer = 'sediment_class' THEN purity END AS purity
    FROM ls LEFT JOIN nm ON nm.box = ls.box AND nm.layer = ls.layer LEFT JOIN dm ON dm.box = ls.box"""


@check("a13_region_stats", "raster", REGION)
def _(spark, d):
    q = C.region_query(boxes(spark, d), the_cube(spark, d), the_grid(spark, d), LAYERS, "sediment_class", tile=16)
    return q.select("box", "layer", "width_m", "height_m", "vmin", "vmax", "vmean", "dominant", "purity")


@check("a13_region_pyramid", "raster", REGION.replace("FROM nation)", "FROM nation UNION ALL SELECT 100 + r_regionkey, {LEFT}::DOUBLE - 7 + r_regionkey * 61, {TOP}::DOUBLE + 11, {LEFT}::DOUBLE + 460 + r_regionkey, {TOP}::DOUBLE - 690 + r_regionkey * 33 FROM region)".format(LEFT=LEFT, TOP=TOP)))
def _(spark, d):
    """Small boxes and five that cover most of the grid, from stored sums of tiles."""
    k = F.col("r_regionkey")
    large = table(spark, d, "region").select((100 + k).alias("box"), (LEFT - 7 + k * 61).alias("x0"), F.lit(TOP + 11).alias("y0"), (LEFT + 460 + k).alias("x1"), (TOP - 690 + k * 33).alias("y1"))
    c, g = the_cube(spark, d), the_grid(spark, d)
    q = C.region_query(boxes(spark, d).unionByName(large), c, g, LAYERS, "sediment_class", summed=C.pyramid(c, g, LAYERS, "sediment_class", side=8))
    return q.select("box", "layer", "width_m", "height_m", "vmin", "vmax", "vmean", "dominant", "purity")


@check("q2_region_corners", "raster", f"""WITH {BOXES}, g AS (SELECT box AS id, x0, y0, x1, y1, 0.0::DOUBLE AS lon, 0.0::DOUBLE AS lat FROM bx) SELECT id AS box, round_even(abs(x1 - x0), 1) AS width_m, round_even(abs(y1 - y0), 1) AS height_m, true AS round_trip FROM g""")
def _(spark, d):
    from soundlake.functions.geo import project

    q = C.region_query(boxes(spark, d), the_cube(spark, d), the_grid(spark, d), ["bathymetry"], None)
    x, y = project(F.col("west"), F.col("south"))
    b = boxes(spark, d).select("box", F.least("x0", "x1").alias("bx"), F.least("y0", "y1").alias("by"))
    ok = (F.abs(x - F.col("bx")) < 0.5) & (F.abs(y - F.col("by")) < 0.5)
    return q.join(b, "box").select("box", "width_m", "height_m", ok.alias("round_trip"))


PATHS = f"""sv AS (SELECT id, id // 10 AS path, id % 10 AS i, {LEFT}::DOUBLE + x / 2 - 10 AS px, {TOP}::DOUBLE - y / 1.5 AS py FROM spot)"""


@check("q3_profile", "raster spot", f"""WITH {CUBE}, {PATHS}, xy AS (SELECT path, i, CASE WHEN id % 9 <> 4 THEN px END AS x, CASE WHEN id % 9 <> 4 THEN py END AS y FROM sv), {NEAR}
    SELECT path, CAST(ix.i AS INTEGER) AS i, round_even(bathymetry, 4) AS bathymetry, round_even(sediment_class::DOUBLE, 4) AS sediment_class, round_even(rl, 4) AS rl, round_even(isopach, 4) AS isopach,
    ROUND(round_even(bathymetry, 4) + round_even(isopach, 4), 6) AS sub_bottom FROM ix LEFT JOIN cb ON ix.x IS NOT NULL AND cb."row" = rr AND cb.col = c""")
def _(spark, d):
    k = F.col("id")
    pair = F.concat_ws(",", F.lit(LEFT) + F.col("x") / 2 - 10, F.lit(TOP) - F.col("y") / 1.5)
    s = spot(spark, d).select(F.floor(k / 10).alias("path"), (k % 10).alias("i"), F.when(k % 9 == 4, "12.5,north").otherwise(pair).alias("p"))
    pts = F.array_sort(F.collect_list(F.struct("i", "p")))
    paths = s.groupBy("path").agg(F.array_join(F.transform(pts, lambda e: e["p"]), ";").alias("coords"))
    q = C.profile_query(paths, the_cube(spark, d), the_grid(spark, d), LAYERS, thickness="isopach", projected=True)
    return q.withColumn("sub_bottom", r("sub_bottom"))


BOX = (LEFT + 42.0, TOP - 31.0, LEFT + 480.0, TOP - 700.0)


@check("r10_strided_block", "raster", f"""WITH {CUBE}, b AS (SELECT * FROM (SELECT unnest(range(0, n)) AS r FROM nr), (SELECT unnest(range(0, 100)) AS c)),
    inb AS (SELECT r, c, b.r - 6 AS i0, b.c - 8 AS j0 FROM b WHERE {LEFT} + (c + 0.5) * 5 BETWEEN {BOX[0]} AND {BOX[2]} AND {TOP} - (r + 0.5) * 5 BETWEEN {BOX[3]} AND {BOX[1]}),
    st AS (SELECT CAST(greatest(1, ceil(greatest(max(r) - min(r) + 1, max(c) - min(c) + 1) / 40.0)) AS INT) AS s, min(r) AS r0, min(c) AS c0 FROM inb),
    pk AS (SELECT (r - r0) // s AS i, (c - c0) // s AS j, bathymetry AS z, isopach AS t FROM inb JOIN st ON (r - r0) % s = 0 AND (c - c0) % s = 0 LEFT JOIN cb ON cb."row" = r AND cb.col = c)
    SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, ROUND(coalesce(z, avg(z) OVER ()), 6) AS depth, {sql5('coalesce(z, avg(z) OVER ()) + coalesce(t, 0)')} AS bedrock FROM pk""")
def _(spark, d):
    b = C.block_query(the_cube(spark, d), the_grid(spark, d), BOX, "bathymetry", "isopach", max_side=40)
    return b.select("i", "j", r("depth").alias("depth"), r5("bedrock").alias("bedrock"))


@check("q4_block_texture", "raster", f"""WITH t AS (SELECT "row" AS i, col AS j, CASE WHEN col % 6 <> 0 THEN z ELSE 0 END AS v FROM raster)
    SELECT (SELECT max(i) FROM t) - i AS i, j, CAST(trunc((v - (SELECT min(v) FROM t)) / ((SELECT max(v) FROM t) - (SELECT min(v) FROM t)) * 255) AS INTEGER) AS byte FROM t""")
def _(spark, d):
    t = raster(spark, d).select(F.col("row").alias("i"), F.col("col").alias("j"), F.when(F.col("col") % 6 != 0, F.col("z")).alias("v"))
    return C.block_texture(t, "v", raster_grid(spark, d).nrows)


@check("q5_catalogue", "raster", f"""WITH {CUBE}, ul AS (SELECT unnest(['bathymetry', 'rl', 'isopach']) AS layer, unnest([bathymetry, rl, isopach]) AS v FROM cb)
    SELECT layer, {sql5('quantile_cont(v, 0.02)')} AS vmin, {sql5('quantile_cont(v, 0.98)')} AS vmax, true AS has_thickness FROM ul WHERE v IS NOT NULL GROUP BY layer""")
def _(spark, d):
    dim = spark.createDataFrame([(v, "m", "float32", "continuous", v) for v in LAYERS if v != "sediment_class"], C.LAYER_SCHEMA)
    c = C.catalogue(the_cube(spark, d), LAYERS, dim, the_grid(spark, d))
    return c.select("layer", r5("vmin").alias("vmin"), r5("vmax").alias("vmax"), "has_thickness")


@check("f12_bounds_guard", "raster spot", f"""WITH {CUBE}, xy AS (SELECT id, {LEFT}::DOUBLE + x / 1.5 - 50 AS x, {TOP}::DOUBLE - y AS y FROM spot), {NEAR} SELECT DISTINCT id, outside FROM ix""")
def _(spark, d):
    p = spot(spark, d).select("id", (F.lit(LEFT) + F.col("x") / 1.5 - 50).alias("x"), (F.lit(TOP) - F.col("y")).alias("y"))
    return C.point_query(p, the_cube(spark, d), the_grid(spark, d), ["rl"], projected=True).select("id", "outside")


@check("f11_region_box", "raster", f"""WITH {CUBE}, {BOXES} SELECT box, "row", col FROM cb JOIN bx ON x BETWEEN least(x0, x1) AND greatest(x0, x1) AND y BETWEEN least(y0, y1) AND greatest(y0, y1)""")
def _(spark, d):
    return C.cells_in_boxes(the_cube(spark, d), boxes(spark, d), the_grid(spark, d), [], 16).select("box", "row", "col")


THIN = """pc AS (SELECT *, CASE channel WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'error' THEN 2 WHEN 'signup' THEN 3 END AS p FROM track),
    one AS (SELECT * FROM pc WHERE p IS NOT NULL QUALIFY p = min(p) OVER (PARTITION BY line)),
    o AS (SELECT line, lon, lat, row_number() OVER (PARTITION BY line ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY line) AS n FROM one)"""


def features(spark, d):
    names = dict(zip(["click", "view", "error", "signup"], C.CHANNEL_ORDER))
    named = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    one = C.preferred_channel(track(spark, d).withColumn("channel", named[F.col("channel")]), ["line"])
    t = T.ordinals(one, along(), "ord", "n")
    return C.trackline_features(T.thin(t, 5), ["line"], "SSS")


@check("q6_tracklines", "track", f"""WITH {THIN} SELECT line, 'SSS' AS instrument, any_value(n) AS pings, CAST(count(*) AS INTEGER) AS points, ROUND(sum(lon), 6) AS lon_sum, ROUND(arg_min(lat, i), 9) AS first_lat
    FROM o WHERE n >= 2 AND (i - 1) % greatest(1, n // 5) = 0 GROUP BY line""")
def _(spark, d):
    f = features(spark, d)
    total = F.aggregate("coords", F.lit(0.0), lambda a, p: a + p["lon"])
    return f.select("line", "instrument", "pings", F.size("coords").alias("points"), r(total).alias("lon_sum"), r(F.get("coords", F.lit(0))["lat"], 9).alias("first_lat"))


@check("s13_line_features", "track", f"""WITH {THIN}, g AS (SELECT line, any_value(n) AS n, list([ROUND(lon + 1.23e-8, 6), ROUND(lat + 1.23e-8, 6)] ORDER BY i) AS c FROM o WHERE n >= 2 AND (i - 1) % greatest(1, n // 5) = 0 GROUP BY line)
    SELECT line, '{{"type":"Feature","properties":{{"file":' || line || ',"pings":' || n || '}},"geometry":{{"type":"LineString","coordinates":' || replace(CAST(c AS VARCHAR), ' ', '') || '}}}}' AS feature FROM g""")
def _(spark, d):
    f = features(spark, d)
    short = F.transform("coords", lambda p: F.struct(F.round(p["lon"] + 1.23e-8, 6).alias("lon"), F.round(p["lat"] + 1.23e-8, 6).alias("lat")))
    props = F.struct(F.col("line").alias("file"), F.col("pings").alias("pings"))
    return f.select("line", C.line_geojson(short, props).alias("feature"))


RANKED = """rk AS (SELECT *, row_number() OVER (ORDER BY abs(v) DESC, id) AS n FROM spot)"""
TID = "'T' || lpad(CAST(n AS VARCHAR), CAST(greatest(3, length(CAST(n AS VARCHAR))) AS INTEGER), '0')"


def ranked(spark, d):
    t = rank_targets(spot(spark, d), "v", ["id"])
    return t.select("target_id", (F.col("x") + 0.001).alias("x_m"), (F.col("y") + 0.001).alias("y_m"), (F.lit(120.7) + F.col("x") / 1e5).alias("lon"), (F.lit(22.1) + F.col("y") / 1e5).alias("lat"), (F.col("v") + 0.001).alias("anomaly_nT"), "polarity")


@check("s12_target_rows", "spot", f"""WITH {RANKED} SELECT {TID} AS target_id, printf('%.2f', x + 0.001) AS x_m, printf('%.2f', y + 0.001) AS y_m, printf('%.6f', 120.7 + x / 1e5) AS lon, printf('%.6f', 22.1 + y / 1e5) AS lat,
    printf('%+.1f', v + 0.001) AS "anomaly_nT", CASE WHEN v > 0 THEN '+' ELSE '-' END AS polarity FROM rk""")
def _(spark, d):
    return C.target_rows(ranked(spark, d))


@check("s12_target_features", "spot", f"""WITH {RANKED} SELECT {TID} AS target_id, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || (x + 0.5) || ',' || (y + 0.5) || ']}},"properties":{{"target_id":"' || {TID} || '","polarity":"' || CASE WHEN v > 0 THEN '+' ELSE '-' END || '"}}}}' AS feature FROM rk""")
def _(spark, d):
    t = rank_targets(spot(spark, d), "v", ["id"])
    return t.select("target_id", C.point_geojson(F.col("x") + 0.5, F.col("y") + 0.5, F.struct("target_id", "polarity")).alias("feature"))
