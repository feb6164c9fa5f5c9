import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from soundlake.operators.knn import idw, nearest
from soundlake.operators.targets import greedy_thin


def cloud(n, seed, hot=0.0):
    rng = np.random.default_rng(seed)
    x, y = rng.uniform(0, 200, n), rng.uniform(0, 200, n)
    k = int(n * hot)
    x[:k], y[:k] = 77.25 + rng.normal(0, 0.01, k), 31.5 + rng.normal(0, 0.01, k)
    return pd.DataFrame({"id": np.arange(n), "px": x, "py": y, "v": rng.normal(0, 300, n)})


def brute(q, p, k, r):
    out = set()
    for i, (a, b) in zip(q["q"], zip(q["qx"], q["qy"])):
        d = (p["px"] - a) ** 2 + (p["py"] - b) ** 2
        near = [(x, j) for x, j in zip(d, p["id"]) if r is None or x < r * r]
        out |= {(i, j, n + 1) for n, (_, j) in enumerate(sorted(near)[:k])}
    return out


def grid():
    g = [(i, float(i % 15) * 14, float(i // 15) * 14) for i in range(225)]
    return pd.DataFrame(g, columns=["q", "qx", "qy"])


def check(spark, p, k, r, leaf):
    q = grid()
    n = nearest(spark.createDataFrame(q), spark.createDataFrame(p), ["q"], ["id"], k, r, leaf)
    got = {(x["q"], x["id"], x["rank"]) for x in n.select("q", "id", "rank").collect()}
    assert got == brute(q, p, k, r)


def test_radius(spark):
    check(spark, cloud(400, 1), 5, 20.0, 2.0)


def test_unbounded(spark):
    check(spark, cloud(60, 2), 7, None, 4.0)


def test_fewer_points_than_k(spark):
    check(spark, cloud(3, 3), 5, None, 4.0)


def test_dense_cluster(spark):
    check(spark, cloud(600, 4, hot=0.5), 4, 30.0, 0.5)


def test_identical_positions(spark):
    p = cloud(300, 5)
    p.loc[p["id"] % 3 == 0, ["px", "py"]] = 50.0
    check(spark, p, 4, 25.0, 2.0)


def test_dense_cluster_pairs_stay_few(spark):
    """Queries away from a cluster of 5000 points do not pair with all of it."""
    p = cloud(5000, 6, hot=0.9)
    n = nearest(spark.createDataFrame(grid()), spark.createDataFrame(p), ["q"], ["id"], 4, 60.0, 0.05)
    assert n.count() == 225 * 4


def test_idw_on_a_point_returns_its_value(spark):
    p = cloud(50, 7)
    q = p.rename(columns={"id": "q", "px": "qx", "py": "qy"})[["q", "qx", "qy"]]
    out = idw(spark.createDataFrame(q), spark.createDataFrame(p), ["q"], ["id"], "v", 12, None, 5.0).toPandas().set_index("q")
    for i, v in zip(p["id"], p["v"]):
        assert abs(out.loc[i, "v"] - v) < 0.05


def sequential(p, radius):
    kept = []
    for _, a in p.assign(s=-p["v"].abs()).sort_values(["s", "id"]).iterrows():
        if all((a.px - b.px) ** 2 + (a.py - b.py) ** 2 >= radius**2 for b in kept):
            kept.append(a)
    return {int(a.id) for a in kept}


def test_thinning_equals_sequential(spark):
    p = cloud(250, 8, hot=0.4)
    out = greedy_thin(spark.createDataFrame(p), ["id"], "px", "py", "v", 15.0)
    assert {r["id"] for r in out.select("id").collect()} == sequential(p, 15.0)


def test_thinning_of_nothing(spark):
    p = spark.createDataFrame(cloud(5, 9)).where(F.lit(False))
    assert greedy_thin(p, ["id"], "px", "py", "v", 15.0).count() == 0


def test_crowded_queries_and_points_meet_in_blocks(spark, monkeypatch):
    """Most queries and most points in one small spot, blocks and crowds of few."""
    from soundlake.operators import knn

    monkeypatch.setattr(knn, "BLOCK", 50)
    monkeypatch.setattr(knn, "CROWD", 4)
    monkeypatch.setattr(knn, "CROWD_LEAST", 20)
    p = cloud(900, 11, hot=0.7)
    rng = np.random.default_rng(12)
    q = pd.DataFrame({"q": np.arange(400), "qx": rng.uniform(-50, 250, 400), "qy": rng.uniform(-50, 250, 400)})
    q.loc[q["q"] % 2 == 0, ["qx", "qy"]] = 77.25 + rng.normal(0, 0.02, (200, 2)) * [1, 0] + [0, 31.5 - 77.25]
    for k, r in ((3, 40.0), (5, None)):
        n = nearest(spark.createDataFrame(q), spark.createDataFrame(p), ["q"], ["id"], k, r, 0.001)
        assert {(x["q"], x["id"], x["rank"]) for x in n.select("q", "id", "rank").collect()} == brute(q, p, k, r)


def test_far_apart_one_sided_and_missing_positions(spark):
    p = pd.DataFrame({"id": [1, 2, 3, 4], "px": [0.0, 1e6, np.nan, 5.0], "py": [0.0, -1e6, 1.0, 5.0], "v": [1.0] * 4})
    q = pd.DataFrame({"q": [1, 2, 3], "qx": [1e7, 0.1, np.nan], "qy": [3.0, 0.2, 0.0]})
    n = nearest(spark.createDataFrame(q), spark.createDataFrame(p), ["q"], ["id"], 2, None, 1.0)
    assert {(x["q"], x["id"], x["rank"]) for x in n.collect()} == brute(q[:2], p[p["id"] != 3], 2, None)
    empty = spark.createDataFrame(p).limit(0)
    assert nearest(spark.createDataFrame(q), empty, ["q"], ["id"], 2, None, 1.0).count() == 0
    assert nearest(spark.createDataFrame(q).limit(0), spark.createDataFrame(p), ["q"], ["id"], 2, 5.0, 1.0).count() == 0


def test_a_table_with_itself(spark):
    p = cloud(80, 13).rename(columns={"px": "qx", "py": "qy"})
    t = spark.createDataFrame(p)
    n = nearest(t.withColumnRenamed("id", "q"), t, ["q"], ["id"], 3, None, 5.0, pxy=("qx", "qy"))
    assert {(x["q"], x["id"], x["rank"]) for x in n.collect()} == brute(p.rename(columns={"id": "q"}), p.rename(columns={"qx": "px", "qy": "py"}), 3, None)


def test_thinning_of_a_ramp_ends_in_few_rounds(spark, monkeypatch):
    from soundlake.operators import targets

    rounds = []
    monkeypatch.setattr(targets, "cut", lambda df, name="cut", real=targets.cut: (rounds.append(name), real(df, name))[1])
    n = 900
    p = pd.DataFrame({"id": np.arange(n), "px": np.arange(n) * 0.7, "py": np.arange(n) % 3 * 0.5, "v": 5000.0 - np.arange(n)})
    out = greedy_thin(spark.createDataFrame(p), ["id"], "px", "py", "v", 2.0)
    assert {r["id"] for r in out.select("id").collect()} == sequential(p, 2.0)
    assert rounds.count("won") <= 900 * 0.7 / (targets.SPAN * 2 / 2**0.5) + 2  # survivors of the ramp: more than 200


def test_thinning_of_a_crowd_with_few_per_round(spark, monkeypatch):
    from soundlake.operators import targets

    monkeypatch.setattr(targets, "MOST", 2)
    monkeypatch.setattr(targets, "SPAN", 5)
    monkeypatch.setattr(targets, "HALO", 4)
    p = cloud(500, 21, hot=0.6)
    p.loc[p["id"] % 50 == 0, "v"] = 300.0  # ties
    p.loc[p["id"] % 7 == 0, ["px", "py"]] = 77.25  # one place
    out = greedy_thin(spark.createDataFrame(p).repartition(3), ["id"], "px", "py", "v", 9.0)
    assert {r["id"] for r in out.select("id").collect()} == sequential(p, 9.0)


def test_far_queries_meet_a_thin_rim_of_points(spark, monkeypatch):
    """Thousands of queries far above all points: few rows move, although each tile of queries sees the whole upper edge."""
    from soundlake.operators import knn

    monkeypatch.setattr(knn, "CROWD", 16)
    monkeypatch.setattr(knn, "CROWD_LEAST", 64)
    monkeypatch.setattr(knn, "BLOCK", 256)
    tables = {}
    kept = knn.cut
    monkeypatch.setattr(knn, "cut", lambda d, name="cut": tables.setdefault(name, []).append(kept(d, name)) or tables[name][-1])
    p = cloud(3000, 21)
    q = pd.DataFrame({"q": np.arange(2000), "qx": np.arange(2000) % 20 * 10.0, "qy": np.arange(2000) // 20 * 400.0})
    n = nearest(spark.createDataFrame(q), spark.createDataFrame(p), ["q"], ["id"], 4, None, 1.0)
    some = q[q["q"] % 7 == 0]
    assert {(x["q"], x["id"], x["rank"]) for x in n.where("q % 7 = 0").select("q", "id", "rank").collect()} == brute(some, p, 4, None)
    assert max(t.count() for t in tables["reach"]) < 4000


def test_magnetic_layers_need_one_search_for_each_value(spark, monkeypatch):
    from soundlake.operators import knn
    from soundlake.operators.raster import Grid
    from soundlake.plans import magnetics

    calls = []

    def counted(*a, search=nearest, **b):
        calls.append(a)
        return search(*a, **b)

    monkeypatch.setattr(knn, "nearest", counted)
    monkeypatch.setattr(magnetics, "nearest", counted)
    g, rng = Grid(0.0, 40.0, 1.0, 40, 60), np.random.default_rng(5)
    p = pd.DataFrame({"id": np.arange(60), "x": np.append(rng.uniform(0, 20, 59), 45.5), "y": np.append(rng.uniform(0, 40, 59), 20.5), "background": rng.normal(0, 1, 60), "anomaly": rng.normal(0, 9, 60)})
    depth = spark.createDataFrame([(i, j) for i in range(40) for j in range(60)], "row int, col int")
    got = magnetics.layers(spark.createDataFrame(p), ["id"], depth, g, reach=4.0, k=3, sigma_m=3.0).toPandas()
    bg = p[p.background.abs() < 2 * p.background.std(ddof=0)]
    want = {}
    for i in range(40):
        for j in range(60):
            d2 = [((q.x - j - 0.5) ** 2 + (q.y - (39.5 - i)) ** 2).to_numpy() for q in (bg, p)]
            if d2[0].min() <= 16:
                near = np.argsort(d2[1], kind="stable")[:3]
                w = 1 / np.maximum(d2[1][near], 1e-12)
                want[i, j] = (w * p.anomaly.to_numpy()[near]).sum() / w.sum()
    assert len(got) == len(want) and all(abs(want[r.row, r.col] - r.anomaly) < 1e-9 for r in got.itertuples())
    assert len(calls) == 2


def test_queries_around_points(spark):
    p, q = cloud(40, 3), grid()
    found = {r.q for r in knn_around(spark, q, p, 9.0)}
    d2 = {i: ((p.px - a) ** 2 + (p.py - b) ** 2).min() for i, a, b in q.itertuples(index=False)}
    assert {i for i, d in d2.items() if d <= 81} <= found and all(d2[i] < 27**2 for i in found)


def knn_around(spark, q, p, reach):
    from soundlake.operators.knn import around

    return around(spark.createDataFrame(q), spark.createDataFrame(p), reach).collect()
