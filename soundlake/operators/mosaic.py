"""Best-sample rasterising."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.functions.acoustic import angle_weight
from soundlake.operators.cube import PART_BITS, on_curve
from soundlake.operators.lineage import cut, release
from soundlake.operators.raster import Grid, fill_holes, masked


def _winners(df: DataFrame, tie: list[str]) -> DataFrame:
    """Per cell the row (db, label, weight, angle, ties) with the lowest score; merges with itself in any order."""
    score = F.struct(F.abs(F.col("angle") - K.REFERENCE_ANGLE), *tie)
    win = F.struct("db", "label", "weight", "angle", *tie)
    return df.groupBy("row", "col").agg(F.min_by(win, score).alias("w")).select("row", "col", "w.*")


def _candidates(df: DataFrame, grid: Grid, db: str, angle: str, label: str, tie: list[str]) -> tuple[DataFrame, list[str]]:
    a, keys = F.col(angle), [f"tie{i}" for i in range(len(tie))]
    ok = F.col(db).isNotNull() & grid.inside(F.col("row"), F.col("col"))
    named = [F.col(t).alias(k) for t, k in zip(tie, keys, strict=True)]
    return df.where(ok).select("row", "col", F.col(db).alias("db"), F.col(label).alias("label"), angle_weight(a).alias("weight"), a.alias("angle"), *named), keys


def best_sample(df: DataFrame, grid: Grid, db: str, angle: str, label: str, tie: list[str]) -> DataFrame:
    """Per cell, the sample whose angle is nearest to 45 degrees; ties go to the lowest ``tie`` key.

    ``df`` has (row, col). ``min_by`` leaves one candidate per cell and task before the exchange, so a
    crowded cell ships no more than a sparse one.
    """
    return _winners(*_candidates(df, grid, db, angle, label, tie)).select("row", "col", "db", "label", "weight", "angle")


def add_samples(path: str, df: DataFrame, grid: Grid, db: str, angle: str, label: str, tie: list[str], bits: int = PART_BITS) -> None:
    """Merge the samples of a new line into the stored winners of a growing survey.

    The winners lie in parts of the grid's space-filling curve. Only parts that the line touches are read and written again, by dynamic
    partition overwrite from a finished table. A winner is a minimum, so a line that is added twice, or again after a run that broke off, changes
    nothing, and lines may come in any order.
    """
    spark = df.sparkSession
    candidates, keys = _candidates(df, grid, db, angle, label, tie)
    new = cut(on_curve(_winners(candidates, keys), bits), "line")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    both = new
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        touched = [r[0] for r in new.select("curve").distinct().collect()]  # parts under one line
        old = spark.read.schema(new.schema).parquet(path).where(F.col("curve").isin(touched))
        both = old.unionByName(new)
    merged = cut(on_curve(_winners(both, keys), bits), "winners")
    merged.repartition("curve").sortWithinPartitions("curve", "row", "col").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("curve").parquet(path)
    release(new, merged)


def stored_winners(spark: SparkSession, path: str) -> DataFrame:
    """The growing mosaic as :func:`best_sample` gives it."""
    return spark.read.parquet(path).select("row", "col", "db", "label", "weight", "angle")


def mosaic(df: DataFrame, grid: Grid, depth: DataFrame, db: str, angle: str, label: str, tie: list[str]) -> DataFrame:
    """Best samples within the depth layer, small holes filled, confidence 0 where filled."""
    best = cut(masked(best_sample(df, grid, db, angle, label, tie), depth), "best")
    filled = fill_holes(best, depth, "db", "label", grid.res)
    conf = best.select("row", "col", "weight")
    out = depth.select("row", "col").join(filled, ["row", "col"], "left").join(conf, ["row", "col"], "left")
    return out.select("row", "col", "db", "label", F.coalesce("weight", F.lit(0.0)).alias("confidence"))
