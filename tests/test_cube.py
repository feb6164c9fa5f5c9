import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from soundlake.operators import cube as C
from soundlake.operators.raster import Grid
from soundlake.plans import jobs
from soundlake.sources.text import read_targets, write_features, write_targets

GRID = Grid(0.0, 10.0, 1.0, 10, 10)


def cube(spark):
    i = F.col("row") * 10 + F.col("col")
    return GRID.cells(spark).select("row", "col", i.cast("double").alias("bathymetry"), (i % 3).alias("sediment_class"), F.when(i % 2 == 0, 1.5).alias("isopach"))


def test_points_ties_edges_and_outside(spark):
    pts = spark.createDataFrame([(1, 1.0, 9.5), (2, 0.4, 9.5), (3, 0.6, 9.4), (4, 50.0, 5.0)], "id int, x double, y double")
    got = {r["id"]: r for r in C.point_query(pts, cube(spark), GRID, ["bathymetry"], projected=True).collect()}
    assert got[1]["value"] == 0.0  # halfway between two centres: the lower column
    assert got[2]["outside"] and got[2]["value"] is None and got[4]["outside"]
    assert got[3]["value"] == 0.0


def test_profile_keeps_bad_pairs_and_clamps(spark):
    p = spark.createDataFrame([(1, "0.5,9.5;oops;-40,3.2;1,2,3")], "path int, coords string")
    got = C.profile_query(p, cube(spark), GRID, ["bathymetry", "isopach"], thickness="isopach", projected=True).orderBy("i").collect()
    assert [r["bathymetry"] for r in got] == [0.0, None, 60.0, None]
    assert got[0]["sub_bottom"] == 1.5


def test_region_swapped_corners_and_ties(spark):
    b = spark.createDataFrame([(1, 3.0, 10.0, 0.0, 8.0), (2, 90.0, 90.0, 95.0, 95.0)], "box int, x0 double, y0 double, x1 double, y1 double")
    got = {(r["box"], r["layer"]): r for r in C.region_query(b, cube(spark), GRID, ["bathymetry", "sediment_class"], "sediment_class", tile=4).collect()}
    assert (got[1, "bathymetry"]["vmin"], got[1, "bathymetry"]["vmax"]) == (0.0, 12.0)
    assert got[1, "sediment_class"]["dominant"] == "Coarse sand" and got[1, "sediment_class"]["purity"] == 33.3
    assert got[2, "bathymetry"]["vmin"] is None


def test_regions_from_tile_sums_equal_those_from_cells(spark):
    g = Grid(0.0, 90.0, 1.0, 90, 130)
    i = F.col("row") * 130 + F.col("col")
    c = g.cells(spark).where((F.col("row") + F.col("col")) % 11 != 3).select("row", "col", F.sqrt(i.cast("double")).alias("bathymetry"), F.when(i % 5 != 0, i % 7).alias("sediment_class"))
    sides = [(0.0, 0.0, 130.0, 90.0), (-50.0, -50.0, 500.0, 500.0), (0.5, 0.5, 129.5, 89.5), (3.2, 4.7, 100.1, 77.9), (16.0, 26.0, 48.0, 58.0), (16.5, 26.5, 47.5, 57.5), (50.0, 50.0, 50.0, 50.0), (50.5, 50.5, 50.5, 50.5),
             (200.0, 1.0, 300.0, 5.0), (129.9, 0.1, 127.0, 88.0)]
    b = spark.createDataFrame([(k, *s) for k, s in enumerate(sides)], "box int, x0 double, y0 double, x1 double, y1 double")
    layers = ["bathymetry", "sediment_class"]
    summed = C.pyramid(c, g, layers, "sediment_class", side=4)
    rows = lambda q: sorted(map(tuple, q.collect()), key=str)
    assert summed.levels == 4
    assert rows(C.region_query(b, c, g, layers, "sediment_class", summed=summed)) == rows(C.region_query(b, c, g, layers, "sediment_class", tile=16))
    only = C.region_query(b, c, g, ["bathymetry"], "sediment_class", summed=summed)
    assert {r["layer"] for r in only.collect()} == {"bathymetry"}


def test_cells_read_for_a_region_grow_with_its_edge(spark):
    g = Grid(0.0, 256.0, 1.0, 256, 256)
    c = g.cells(spark).withColumn("bathymetry", F.lit(1.0))
    summed = C.pyramid(c, g, ["bathymetry"], side=4)
    sides = (20, 60, 120, 240)
    b = spark.createDataFrame([(s, 3.0, 3.0, 3.0 + s, 3.0 + s) for s in sides], "box int, x0 double, y0 double, x1 double, y1 double")
    read = {r["box"]: r["count"] for r in C.rim_cells(b, c, g, summed).groupBy("box").count().collect()}
    assert all(0 < read[s] <= 4 * 4 * s for s in sides)
    tiles, _ = C._covering(b, g, summed.side, summed.levels)
    count = {r["box"]: r["count"] for r in tiles.groupBy("box").count().collect()}
    assert count[240] <= 3 * 4 * 240 / 4 and count[240] <= 2.5 * count[120]  # of 3600 that it covers


def test_strided_frame_has_only_its_cells(spark):
    g = Grid(0.0, 5000.0, 1.0, 5000, 4000)
    c = spark.createDataFrame([(7 + 34 * 2, 9 + 34 * 3, 4.0), (7, 9, 6.0), (8, 9, 100.0)], "row int, col int, bathymetry double")
    q = C.block_query(c, g, (9.0, 4993.0, 3990.0, 20.0), "bathymetry", max_side=150)
    assert "Range (0, 17346," in q._jdf.queryExecution().optimizedPlan().toString()  # 147 x 118 cells, not the grid's 20 million
    got = {(r["i"], r["j"]): r["depth"] for r in q.collect()}
    assert len(got) == 147 * 118 and got[2, 3] == 4.0 and got[0, 0] == 6.0 and got[1, 1] == 5.0


def test_block_fills_gaps_with_its_mean(spark):
    c = cube(spark).where("row > 0 or col > 0")
    got = C.block_query(c, GRID, (0.0, 10.0, 10.0, 0.0), "bathymetry", "isopach", max_side=5).collect()
    assert len(got) == 25
    mean = sum(20 * i + 2 * j for i in range(5) for j in range(5)) / 24
    first = [r for r in got if (r["i"], r["j"]) == (0, 0)][0]
    assert abs(first["depth"] - mean) < 1e-9 and abs(first["bedrock"] - mean) < 1e-9


def test_preferred_channel_stops_at_the_first_present(spark):
    df = spark.createDataFrame([(1, "LF_port"), (1, "HF_port"), (1, "HF_port"), (2, "LF_stbd"), (2, "HF_stbd")], "line int, channel string")
    got = {(r["line"], r["channel"]) for r in C.preferred_channel(df, ["line"]).collect()}
    assert got == {(1, "HF_port"), (2, "HF_stbd")}


def test_colours_are_white_without_class_or_depth(spark):
    cls = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (0, 2, None), (0, 3, 9)], "row int, col int, class_id int")
    depth = spark.createDataFrame([(0, 0), (0, 2), (0, 3)], "row int, col int")
    got = {r["col"]: (r["red"], r["green"], r["blue"]) for r in jobs.class_colours(cls, depth).collect()}
    assert got == {0: (160, 82, 45), 1: (255, 255, 255), 2: (255, 255, 255), 3: (255, 255, 255)}


def test_features_and_targets_files(spark, tmp_path):
    t = spark.createDataFrame([("T001", 1.234, 2.0, 120.5, 22.25, -150.04, "-")], "target_id string, x_m double, y_m double, lon double, lat double, anomaly_nT double, polarity string")
    f = t.select(C.point_geojson(F.col("lon"), F.col("lat"), F.struct("target_id")).alias("feature"))
    write_features(f, "feature", str(tmp_path / "f"))
    line = json.loads(spark.read.text(str(tmp_path / "f")).first()[0])
    assert line["geometry"] == {"type": "Point", "coordinates": [120.5, 22.25]} and line["properties"]["target_id"] == "T001"
    write_targets(C.target_rows(t), str(tmp_path / "t"))
    back = read_targets(spark, str(tmp_path / "t")).first()
    assert (back["x_m"], back["anomaly_nT"], back["polarity"]) == (1.23, -150.0, "-")


def test_curve_ranges_cover_the_box_and_little_else():
    def code(r, c):
        return sum(((r >> k & 1) << (2 * k + 1)) | ((c >> k & 1) << (2 * k)) for k in range(20))

    for r0, r1, c0, c1 in ((0, 0, 0, 0), (3, 9, 2, 30), (0, 63, 0, 63), (17, 18, 0, 63), (5, 60, 41, 41), (4, 3, 0, 9)):
        want = {code(r >> 1, c >> 1) for r in range(r0, r1 + 1) for c in range(c0, c1 + 1)}
        got = C.curve_ranges(r0, r1, c0, c1, bits=1)
        assert {k for a, b in got for k in range(a, b + 1)} == want and all(a[1] + 1 < b[0] for a, b in zip(got, got[1:]))
        few = C.curve_ranges(r0, r1, c0, c1, bits=1, most=2)
        assert len(few) <= 2 and want <= {k for a, b in few for k in range(a, b + 1)}
    assert len(C.curve_ranges(0, 10**9, 0, 10**9 - 5000)) <= 64


def test_a_box_opens_only_its_files(spark, tmp_path):
    from soundlake.checks.files import files_read

    g = Grid(0.0, 64.0, 1.0, 64, 64)
    C.write(g.cells(spark).withColumn("depth", F.col("row") * 1.0), str(tmp_path / "cube"), bits=3)
    q = C.read_box(spark, str(tmp_path / "cube"), g, (9.0, 60.0, 30.0, 45.0), bits=3)
    assert {(r["row"], r["col"]) for r in q.collect()} == {(r, c) for r in range(4, 19) for c in range(9, 30)}
    assert files_read(q) == 3 * 3  # of 64
    assert files_read(spark.read.parquet(str(tmp_path / "cube"))) == 64
    assert files_read(C.read_box(spark, str(tmp_path / "cube"), g, (900.0, 60.0, 930.0, 45.0), bits=3)) == 0


def test_a_box_lists_only_its_folders(spark, tmp_path):
    path, g = str(tmp_path / "cube"), Grid(0.0, 64.0, 1.0, 64, 64)
    C.write(g.cells(spark).where("row < 32").withColumn("depth", F.col("row") * 1.0), path, bits=3)

    def listed(*box):
        q = C.read_box(spark, path, g, box, bits=3)
        return q.count(), q.columns, len(q._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().inputFiles())

    columns = ["row", "col", "depth"]
    assert listed(9.0, 60.0, 30.0, 45.0) == (15 * 21, columns, 3 * 3)
    assert listed(9.0, 40.0, 30.0, 25.0) == (8 * 21, columns, 3)  # the lower parts are not there
    assert listed(9.0, 20.0, 30.0, 10.0) == (0, columns, 1) and listed(900.0, 60.0, 930.0, 45.0) == (0, columns, 1)


def test_small_parts_are_written_by_many_tasks(spark, tmp_path):
    path, g = str(tmp_path / "cube"), Grid(0.0, 64.0, 1.0, 64, 64)
    C.write(g.cells(spark).withColumn("depth", F.col("row") * 1.0), path, bits=3)
    tasks = spark.read.parquet(path).select(F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1)).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_small_parts_start_no_processes(spark, tmp_path):
    """Page faults of processes that the JVM started and waited for: Hadoop starts some for every file that it writes or lists on a local file system."""
    path, g = str(tmp_path / "cube"), Grid(0.0, 64.0, 1.0, 64, 64)
    stat = f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/stat"

    def faults():
        with open(stat) as f:
            return int(f.read().rpartition(")")[2].split()[8])

    before = faults()
    C.write(g.cells(spark).withColumn("depth", F.col("row") * 1.0), path, bits=1)
    assert C.stored_files(spark, path).count() == 1024
    assert faults() - before < 1024


def test_parts_are_as_spark_writes_them(spark, tmp_path):
    here, there = str(tmp_path / "here"), str(tmp_path / "there")
    cells = spark.range(3000).select(
        F.when(F.col("id") % 97 != 0, (F.col("id") / 40).cast("int") - 3).alias("row"), F.when(F.col("id") % 89 != 0, F.col("id") % 40).cast("int").alias("col"),
        F.when(F.col("id") % 3 != 0, F.col("id") / 7).alias("depth"), F.timestamp_seconds("id").alias("t"), F.array(F.col("id"), F.lit(None)).alias("a"), F.col("id").cast("decimal(12,3)").alias("d"))
    cells = cells.unionByName(cells.where("row = 5"))
    C.on_curve(cells, 2).write.partitionBy("curve").parquet(there)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # parts run over many batches
    try:
        C.write(cells, here, 2)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    a, b = spark.read.parquet(here), spark.read.parquet(there)
    assert a.schema == b.schema and a.count() == 3040
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {p.name for p in (tmp_path / "here").iterdir()} == {p.name for p in (tmp_path / "there").iterdir() if not p.name.startswith(".")}
    assert all(len(list(p.iterdir())) == 1 for p in (tmp_path / "here").glob("curve=*"))
    found = {r["file"]: r["rows"] for r in C.stored_files(spark, here).collect()}
    assert found == {r["f"].removeprefix("file://"): r["count"] for r in a.groupBy(F.input_file_name().alias("f")).count().collect()}


def test_a_large_part_has_several_row_groups(spark, tmp_path):
    path, g = str(tmp_path / "cube"), Grid(0.0, 700.0, 1.0, 700, 400)
    C.write(g.cells(spark).withColumn("depth", F.col("row") * 1.0), path)
    (name, rows), = [tuple(r) for r in C.stored_files(spark, path).collect()]
    about = pq.read_metadata(name)
    assert rows == 280_000 and about.num_row_groups == 2 and about.row_group(0).num_rows >= C.GROUP_ROWS
    assert C.read_box(spark, path, g, (10.0, 20.0, 13.0, 10.0)).count() == 30


def test_a_write_that_fails_leaves_the_cube_as_it_was(spark, tmp_path):
    path, g = str(tmp_path / "cube"), Grid(0.0, 8.0, 1.0, 8, 8)
    C.write(g.cells(spark).withColumn("depth", F.lit(1.0)), path, bits=1)
    bad = g.cells(spark).withColumn("depth", F.when(F.col("row") == 7, F.raise_error(F.lit("broken"))).otherwise(F.lit(2.0)).cast("double"))
    with pytest.raises(Exception, match="broken"):
        C.write(bad, path, bits=1)
    assert [tuple(r) for r in C.read(spark, path).groupBy("depth").count().collect()] == [(1.0, 64)]
    assert [p.name for p in tmp_path.iterdir()] == ["cube"]
    C.write(g.cells(spark).withColumn("depth", F.lit(2.0)).where("row < 2"), path, bits=1)
    assert [tuple(r) for r in C.read(spark, path).groupBy("depth").count().collect()] == [(2.0, 16)]


def test_layers_are_read_by_box(spark, tmp_path):
    from soundlake.operators import raster as R

    path = str(tmp_path / "layers")
    cells = Grid(0.0, 4.0, 1.0, 4, 5000).cells(spark).withColumn("value", F.col("col") * 1.0)
    R.write_layer(cells, "depth", path)
    R.write_layer(cells, "other", path)
    got = C.within(R.read_layer(spark, path, "depth"), 1, 2, 2040, 2060)
    assert got.count() == 2 * 21 and got.agg(F.min("value")).first()[0] == 2040.0
