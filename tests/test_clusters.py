"""Optimal one-dimensional clusters: against all ways to cut small data, and never worse than seeded rounds."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from soundlake.operators import radiometry as R
from soundlake.operators.stats import small_median


def frame(spark, v):
    return spark.createDataFrame(pd.DataFrame({"z": v})).repartition(3)


def squares(v, centres):
    return float(np.min((np.asarray(v)[:, None] - np.asarray(centres)[None, :]) ** 2, axis=1).sum())


def best(v, k):
    v = np.sort(v)
    cuts = itertools.combinations(range(1, len(v)), k - 1)
    return min(sum(((v[a:b] - v[a:b].mean()) ** 2).sum() for a, b in zip((0, *c), (*c, len(v)))) for c in cuts)


def seeded(v, k, rng):
    c = rng.choice(v, k, replace=False)
    for _ in range(100):
        own = np.argmin((v[:, None] - c[None, :]) ** 2, axis=1)
        c = np.array([v[own == i].mean() if (own == i).any() else c[i] for i in range(k)])
    return squares(v, c)


def test_best_splits_of_all():
    rng = np.random.default_rng(0)
    for _ in range(50):
        m = int(rng.integers(1, 9))
        n = rng.integers(1, 5, m).astype(float)
        s = n * np.sort(rng.normal(size=m))
        gain = lambda cut: sum(s[a:b].sum() ** 2 / n[a:b].sum() for a, b in zip((0, *cut), (*cut, m)))  # noqa: E731, B023
        for c, cut in enumerate(R.best_splits(n, s, 4), 1):
            assert abs(gain(cut) - max(map(gain, itertools.combinations(range(1, m), c - 1)))) < 1e-9


@pytest.mark.parametrize("k", [2, 3, 4])
def test_small_data_reach_the_optimum(spark, k):
    rng = np.random.default_rng(k)
    for v in (rng.normal(size=14), np.round(rng.normal(size=14), 1), np.append(rng.normal(size=12), [1e6, 1e6 + 1])):
        centres, sizes = R.optimal_clusters(frame(spark, v), "z", k)
        assert sum(sizes) == len(v) and squares(v, centres) <= best(v, k) * (1 + 1e-6) + 1e-9


def test_never_above_seeded_rounds(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.normal(m, s, n) for m, s, n in ((-4, 0.3, 900), (0, 1.0, 2500), (0.5, 0.05, 400), (9, 0.5, 60))])
    centres, sizes = R.optimal_clusters(frame(spark, v), "z", 6)
    assert sum(sizes) == len(v) and centres == sorted(centres)
    assert squares(v, centres) <= min(seeded(v, 6, rng) for _ in range(20)) * (1 + 1e-6)


def test_few_values_hot_values_and_none(spark):
    centres, sizes = R.optimal_clusters(frame(spark, [2.0] * 500 + [3.0]), "z", 4)
    assert (centres, sizes) == ([2.0, 3.0], [500, 1])
    nothing = spark.createDataFrame([(None,)], "z double")
    assert R.optimal_clusters(nothing, "z", 3) == ([], []) and R.cluster(nothing, "z", 3) == []
    hidden = np.concatenate([[1e9], np.repeat([0.0, 1.0], 300), np.linspace(0.4, 0.6, 50)])
    centres, _ = R.optimal_clusters(frame(spark, hidden), "z", 4)
    assert len(centres) == 4 and abs(centres[0]) < 0.1 and 0.45 < centres[1] < 0.55 and centres[3] == 1e9


def test_waterfall_inside_pings_equals_that_of_samples(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "HF", rng.uniform(10, 80, n).round(1).tolist(), [None if x < -7 else float(x) for x in rng.normal(-5, 1, n).round(2)]) for i, n in enumerate((0, 1, 7, 400, 2000, 30))]
    rows += [(6, "HF", [20.0, 69.9, 70.0, 19.9, 45.0, 45.5], [1.0, 2.0, 3.0, 4.0, 5.0]), (7, "HF", None, [1.0]), (8, "HF", [30.0, None, float("nan")], [1.0, 2.0, 3.0])]
    pings = spark.createDataFrame(rows, "ping long, side string, angle array<double>, db array<double>")
    found = R.ping_waterfall(pings, ["ping", "side"], "db", "angle")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    samples = pings.select("ping", "side", F.explode(F.arrays_zip("angle", "db")).alias("s")).select("ping", "side", "s.angle", "s.db").where("not isnan(angle)")
    want = R.waterfall(samples, ["ping", "side"], "db", "angle")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.select("ping", "side", "bin", "bs").collect()))
    assert R.ping_waterfall(pings.limit(0), ["ping"], "db", "angle").count() == 0


def test_smoothed_labels_equal_the_full_image(spark, monkeypatch):
    """Sparse pings with missing and unlabelled bins, in blocks of a few pings, without a row for every place of the image."""
    monkeypatch.setattr(R, "PING_BLOCK", 7)
    rng = np.random.default_rng(8)
    cells = {(int(p) * 3, int(b)): None if u < 0.2 else int(u * 5) for p, b, u in zip(rng.integers(0, 60, 900), rng.choice([0, 1, 2, 3, 20, 21, 47, 48, 49], 900), rng.random(900))}
    wf = spark.createDataFrame([(p, b, v) for (p, b), v in cells.items()], "ping long, bin int, label int")
    want = R.label_image(R.full_image(wf, "ping"), "ping", "label").select("ping", "bin", "smoothed").collect()
    got = R.smoothed_labels(wf, "ping", "label")
    assert sorted(got.collect()) == sorted(want) and len(want) == sum(v is not None for v in cells.values())
    assert "explode(sequence" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_small_medians_are_dealt_out_whatever_their_bytes(spark):
    rows = spark.range(4000).selectExpr("id % 500 AS ping", "CAST(id % 3 AS INT) AS bin", "CASE WHEN id % 11 <> 0 THEN CAST(id * 37 % 101 AS DOUBLE) END AS v")
    found = small_median(rows, ["ping", "bin"], "v", "m")
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = rows.groupBy("ping", "bin").agg(F.median("v").alias("m")).where("m is not null")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
