import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.operators import along as T
from soundlake.operators import altitude
from soundlake.operators.stats import quantiles


def line(n=300, seed=0):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"line": 1, "seq": np.arange(n), "t": np.arange(n) * 0.5, "v": rng.normal(20, 2, n)})


def track():
    return T.Track(("line",), ("seq",), F.floor(F.col("seq") / 37))


def test_ordinals_and_running_sum(spark):
    p = line()
    d = T.running_sum(T.ordinals(spark.createDataFrame(p), track(), "ord", "n"), track(), F.col("v"), "s")
    got = d.orderBy("seq").toPandas()
    assert (got["ord"] == p["seq"] + 1).all() and (got["n"] == 300).all()
    assert np.allclose(got["s"], p["v"].cumsum())


def test_reach_skips_empty_stretches(spark):
    p = line(200)
    p = p[(p["seq"] < 30) | (p["seq"] > 150)]
    d = T.reach(spark.createDataFrame(p), track(), {"b": (F.col("seq"), True)}, {"a": (F.col("seq"), True)})
    got = d.orderBy("seq").toPandas()
    s = p["seq"].reset_index(drop=True)
    assert got["b"].dropna().tolist() == s.iloc[:-1].tolist()
    assert got["a"].dropna().tolist() == s.iloc[1:].tolist()


def test_interpolation_matches_numpy_and_splits_a_stuck_clock(spark):
    k = pd.DataFrame({"line": 1, "t": [0.0, 10.0, 40.0, 90.0], "v": [0.0, 5.0, -5.0, 7.0]})
    q = pd.DataFrame({"line": 1, "seq": range(400), "t": [25.0] * 300 + list(np.linspace(-5, 95, 100))})
    for crowd in (1_000_000, 50):
        out = T.interpolate(
            spark.createDataFrame(q), spark.createDataFrame(k), ["line"], "t", ["v"], F.floor(F.col("t") / 20), crowd=crowd
        )
        got = out.orderBy("seq").toPandas()
        want = np.interp(q["t"], k["t"], k["v"], left=np.nan, right=np.nan)
        assert len(got) == 400 and np.allclose(got["v"], want, equal_nan=True)


def test_one_known_gives_nothing(spark):
    k = pd.DataFrame({"line": [1], "t": [0.0], "v": [1.0]})
    q = pd.DataFrame({"line": [1, 2], "t": [0.0, 1.0]})
    out = T.interpolate(spark.createDataFrame(q), spark.createDataFrame(k), ["line"], "t", ["v"], F.floor("t"))
    assert [r["v"] for r in out.collect()] == [None, None]


def medians(v, w, reflect):
    h = w // 2
    a = np.pad(v, h, mode="symmetric" if reflect else "constant")
    return np.median(np.lib.stride_tricks.sliding_window_view(a, w), axis=1)


def test_rolling_medians_cross_blocks(spark):
    p = line(100)
    d = T.ordinals(spark.createDataFrame(p), track(), "ord", "n")
    z = T.median_zero(d, ["line"], "v", 9, "m").orderBy("seq").toPandas()["m"]
    assert np.allclose(z, medians(p["v"].to_numpy(), 9, False))
    for reflect in (False, True):
        r = T._running_median(d, ["line"], "v", 9, "m", reflect, block=16).orderBy("seq").toPandas()["m"]
        assert np.allclose(r, medians(p["v"].to_numpy(), 9, reflect))


def test_reflection_of_a_short_line(spark):
    p = line(5)
    d = T.ordinals(spark.createDataFrame(p), track(), "ord", "n")
    got = T.median_reflect(d, ["line"], "v", 21, "m").orderBy("seq").toPandas()["m"]
    assert np.allclose(got, medians(p["v"].to_numpy(), 21, True))


def one_pass(z, carry):
    """Ping by ping, as the filter is defined."""
    x, p, out = np.nanmedian(z), 10.0, []
    for v in z:
        p += K.KALMAN_Q
        s = p + K.KALMAN_R
        take = bool(v == v and abs(v - x) < K.KALMAN_GATE * max(np.sqrt(s), 1e-6))
        if take:
            g = p / s
            x += g * (v - x)
            p = (1 - g) * (1 - g) * p + g * g * K.KALMAN_R
        out.append(x if take or carry else np.nan)
    return np.array(out)


def test_chunked_filter_equals_one_pass(spark):
    p = line(400, 3)
    p.loc[p["seq"] % 17 == 0, "v"] = 60.0
    p.loc[p["seq"] % 23 == 0, "v"] = np.nan
    d = spark.createDataFrame(p).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    for carry in (False, True):
        out = altitude.smooth(d, track(), "v", carry=carry, chunk=90, out="s").orderBy("seq").toPandas()["s"]
        assert np.array_equal(out.to_numpy(dtype=float), one_pass(p["v"].to_numpy(), carry), equal_nan=True)


def test_many_lines_in_lockstep(spark, monkeypatch):
    monkeypatch.setattr(altitude, "TOGETHER", 300)
    rng = np.random.default_rng(4)
    parts = [line(n, i).assign(line=i) for i, n in enumerate((3, 5, 41, 90, 91, 250, 700))]
    p = pd.concat(parts, ignore_index=True)
    p.loc[rng.random(len(p)) < 0.1, "v"] = 90.0
    d = spark.createDataFrame(p).repartition(5)
    out = altitude.smooth(d, track(), "v", carry=True, chunk=40, out="s").toPandas().sort_values(["line", "seq"])
    for i, part in enumerate(parts):
        v = p.loc[p["line"] == i].sort_values("seq")["v"].to_numpy()
        got = out.loc[out["line"] == i, "s"].to_numpy(dtype=float)
        assert np.array_equal(got, v if len(v) < 5 else one_pass(v, True))


def test_few_values_stay_unchanged(spark):
    p = line(4)
    out = altitude.smooth(spark.createDataFrame(p), track(), "v", out="s").orderBy("seq").toPandas()
    assert np.allclose(out["s"], p["v"])


def test_quantiles_exact_for_hard_values(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([np.full(500, 1.0), 1 + rng.uniform(0, 1e-9, 300), -rng.lognormal(0, 3, 300), [0.0] * 50, rng.normal(0, 1e-3, 200)])
    d = spark.createDataFrame(pd.DataFrame({"g": np.arange(len(v)) % 2, "v": v}))
    probs = {f"q{i}": i / 10 for i in range(11)}
    for row in quantiles(d, ["g"], "v", probs, count="n").collect():
        part = v[np.arange(len(v)) % 2 == row["g"]]
        assert row["n"] == len(part)
        for name, q in probs.items():
            assert np.isclose(row[name], np.quantile(part, q), rtol=1e-12, atol=0)


def test_quantiles_of_nothing(spark):
    d = spark.createDataFrame([(1, None)], "g int, v double")
    assert quantiles(d, ["g"], "v", {"m": 0.5}).count() == 0
    assert quantiles(d, [], "v", {"m": 0.5}).count() == 0


def test_zero_padded_medians_need_no_masks(monkeypatch):
    from soundlake.operators.along import _block_median

    rng = np.random.default_rng(3)
    for n, half in ((1, 3), (2, 3), (5, 3), (40, 3), (40, 17)):
        v = np.where(rng.random(n) < 0.2, np.nan, rng.normal(size=n).round(1))
        reach = (min(2 * half + 1, n) - 1) // 2
        padded = np.concatenate([np.zeros(reach), np.nan_to_num(v), np.zeros(reach)])
        want = [np.nanmedian(padded[i : i + 2 * reach + 1]) for i in range(n)]
        with monkeypatch.context() as m:
            m.setattr(np, "nanmedian", None)
            got = _block_median(np.arange(1, n + 1), v, np.ones(n, bool), n, half, False)
        assert got.tolist() == want
