"""The growing mosaic and the bootstrap: equal to the batch result, whatever the order, and no more rewritten than needed."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from soundlake.operators import mosaic as M
from soundlake.operators import stats as S
from soundlake.operators.along import Track
from soundlake.operators.raster import Grid

GRID = Grid(0.0, 64.0, 1.0, 64, 64)


def samples(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    line = rng.integers(0, 5, n)
    p = pd.DataFrame({"line": line, "seq": np.arange(n), "row": rng.integers(0, 64, n), "col": (line * 12 + rng.integers(0, 14, n)) % 70, "db": rng.normal(0, 5, n), "angle": rng.integers(30, 60, n) * 1.0, "label": rng.integers(0, 7, n)})
    p.loc[p["seq"] % 17 == 0, "db"] = np.nan
    return spark.createDataFrame(p).withColumn("db", F.when(~F.isnan("db"), F.col("db")))


def rows(df):
    return sorted(map(tuple, df.select("row", "col", "db", "label", "weight", "angle").collect()))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_lines_one_by_one_equal_the_batch(spark, tmp_path):
    s, path = samples(spark), str(tmp_path / "mosaic")
    args = (GRID, "db", "angle", "label", ["seq"])
    for i in (3, 0, 4, 0, 1, 2):  # one of them twice
        M.add_samples(path, s.where(F.col("line") == i), *args, bits=3)
    assert rows(M.stored_winners(spark, path)) == rows(M.best_sample(s, *args))


def test_only_touched_parts_are_written_again(spark, tmp_path):
    s, path = samples(spark), str(tmp_path / "mosaic")
    args = (GRID, "db", "angle", "label", ["seq"])
    M.add_samples(path, s, *args, bits=3)
    before, kept = files(path), rows(M.stored_winners(spark, path))
    near = s.where("row between 8 and 15 and col between 16 and 23").withColumn("angle", F.lit(45.0)).withColumn("seq", F.col("seq") - 10_000)
    M.add_samples(path, near, *args, bits=3)
    after = files(path)
    assert len(before) == 64 and {os.path.dirname(f) for f in before - after} == {os.path.dirname(f) for f in after - before} and len(after - before) == 1
    moved = {r[:2] for r in set(rows(M.stored_winners(spark, path))) - set(kept)}
    assert moved and all(8 <= r <= 15 and 16 <= c <= 23 for r, c in moved)
    M.add_samples(path, s.limit(0), *args, bits=3)
    assert files(path) == after


def test_bootstrap_by_held_values_equals_the_join(spark, monkeypatch):
    rng = np.random.default_rng(3)
    for n in (2, 3, 8, 51):
        p = pd.DataFrame({"g": 0, "id": rng.permutation(n), "v": rng.normal(-30, 3, n).round(2)})
        d, track = spark.createDataFrame(p), Track(("g",), ("id",), F.floor(F.col("id") / 7))
        held = S.bootstrap_median(d, "v", track, reps=40).first()
        monkeypatch.setattr(S, "HELD", 0)
        joined = S.bootstrap_median(d, "v", track, reps=40).first() if n >= 3 else held
        monkeypatch.undo()
        assert held == joined and held["n"] == n
        if n < 3:
            assert held["ci_lo"] is None
            continue
        v = p.sort_values("id")["v"].to_numpy()
        j = np.arange(n, dtype=np.int64)
        draw = lambda r: (((r * 2000003 + j * 7919 + 42) % 2147483647 * 48271 % 2147483647) * 48271 + 12345) % 2147483647 % n  # noqa: E731, B023
        medians = [np.median(v[draw(r)]) for r in range(40)]
        assert np.allclose([held["ci_lo"], held["ci_hi"], held["median"], held["std"]], [*np.quantile(medians, [0.025, 0.975]), np.median(v), v.std()])
