import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from soundlake.functions import blocks
from soundlake.operators import radiometry as R
from soundlake.operators import trace as T


def test_envelope_of_a_tone():
    n = np.arange(400)
    a = np.stack([3 * np.cos(2 * np.pi * n / 20), 2 * np.sin(2 * np.pi * n / 40)])
    assert np.allclose(blocks.envelope(a), [[3.0], [2.0]])
    assert np.allclose(blocks.envelope(a[:1, :399]), np.abs(np.fft.ifft(np.fft.fft(a[0, :399]) * np.where(np.arange(399) == 0, 1, np.where(np.arange(399) < 200, 2, 0)))))


def peaks(v, distance, least_prominence, least_width):
    """Sample by sample, for one trace."""
    found = []
    i = 1
    while i < len(v) - 1:
        j = i
        while j + 1 < len(v) and v[j + 1] == v[i]:
            j += 1
        if v[i - 1] < v[i] and j + 1 < len(v) and v[j + 1] < v[i]:
            found.append((i + j) // 2)
        i = j + 1
    kept = []
    for p in sorted(found, key=lambda p: (-v[p], -p)):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        sides, crossings = [], []
        for step in (-1, 1):
            q, low = p, v[p]
            while 0 <= q + step < len(v) and v[q + step] <= v[p]:
                q += step
                low = min(low, v[q])
            sides.append(low)
        prominence = v[p] - max(sides)
        level = v[p] - prominence / 2
        for step in (-1, 1):
            q = p
            while v[q] > level:
                q += step
            crossings.append(q - step * (level - v[q]) / (v[q - step] - v[q]) if v[q] < level else q)
        if prominence >= least_prominence and crossings[1] - crossings[0] >= least_width:
            out.append((p, prominence))
    return out


def block_peaks(block, distance, least_prominence, least_width):
    row, at = blocks.tops(block)
    keep = blocks.spaced(row, at, block[row, at], distance)
    row, at = row[keep], at[keep]
    prom, width = blocks.prominences(block, row, at)
    good = (prom >= least_prominence) & (width >= least_width)
    return [[(int(a), float(p)) for r, a, p, g in zip(row, at, prom, good) if g and r == i] for i in range(len(block))]


def test_peaks_spacing_prominence_and_plateau():
    v = np.zeros(60)
    v[10:13] = 5.0  # plateau, counted at 11
    v[30], v[29], v[31] = 9.0, 4.0, 4.0
    v[34] = 6.0  # too close to the higher peak at 30
    v[50] = 1.0
    assert block_peaks(v[None], 8, 2.0, 0.0) == [[(11, 5.0), (30, 9.0)]]
    assert block_peaks(v[None], 1, 0.5, 2.5) == [[(11, 5.0)]]


def test_block_peaks_against_sample_by_sample():
    rng = np.random.default_rng(3)
    block = np.round(np.cumsum(rng.normal(size=(60, 90)), axis=1) * 2) / 2
    for distance, prominence, width in ((1, 0.5, 0.0), (5, 1.0, 2.0), (12, 2.0, 3.0)):
        assert block_peaks(block, distance, prominence, width) == [[(p, x) for p, x in peaks(v, distance, prominence, width)] for v in block]


def test_detrending_and_running_median():
    rng = np.random.default_rng(4)
    block = rng.normal(size=(5, 40)) + np.arange(40) * 0.7
    for v, d in zip(block, blocks.detrended(block)):
        assert np.allclose(d, v - np.polyval(np.polyfit(np.arange(40), v, 1), np.arange(40)))
    for v, m in zip(block, blocks.running_median(block, 5)):
        wide = np.concatenate([[0, 0], v, [0, 0]])
        assert np.allclose(m, [np.median(wide[i : i + 5]) for i in range(40)])


def synthetic(depth_m, vp=1500.0, n=500, level=60000.0):
    rng = np.random.default_rng(1)
    a = rng.normal(0, 50, n)
    dz = 20480e-9 * vp / 2
    for at, amp in ((120, 20000.0), (120 + round(depth_m / dz), level)):
        i = np.arange(n) - at
        a += amp * np.exp(-0.5 * (i / 4) ** 2) * np.cos(np.pi * i / 2)
    return a


def test_picks_find_a_reflector(spark):
    got = T.picks([synthetic(2.0), None, synthetic(2.0)[:130]], np.full(3, 120), np.full(3, 1500.0))
    assert abs(got[0, 0] - 2.0) < 0.06 and got[0, 1] >= 5 and np.isnan(got[1:]).all()
    rows = spark.createDataFrame(pd.DataFrame({"id": [1, 2], "amps": [synthetic(2.0).tolist(), synthetic(1.04).tolist()], "idx_b": [120, 120], "vp": [1500.0, 1500.0]}))
    out = T.pick_reflector(rows, ["id"]).collect()
    assert [r["id"] for r in out] == [1]  # the second lies where the draft's multiple is


def test_flat_trace_has_no_pick():
    flat = [np.full(500, 10.0), np.full(125, 10.0)]
    for strict in (True, False):
        assert np.isnan(T.picks(flat, np.full(2, 120), np.full(2, 1500.0), strict)).all()


def test_first_return(spark):
    a = np.full(400, 1.0)
    a[90:] = 50.0
    df = spark.createDataFrame([(a.tolist(), 0.1), ([0.0] * 400, 0.1), ([1.0] * 20, 0.1), (None, 0.1)], "amps array<double>, pix double")
    got = [r["first_return"] for r in T.with_first_return(df, "amps", "pix").collect()]
    assert got[0] == pytest.approx(8.9) and got[1:] == [None, None, None]


def test_samples_lie_inside_the_window(spark):
    df = spark.createDataFrame([(1, [float(i) for i in range(300)], 0.1, 8.0, 90.0, 22.0, 120.0)], "id int, amps array<double>, pix double, alt double, heading double, lat double, lon double")
    s = T.project_samples(df, "amps", "pix", "alt", F.lit(65.0), ["id", "lat", "lon"], "heading", F.lit(-90.0)).toPandas()
    i = np.arange(300) * 0.1
    want = np.flatnonzero((i > 8 / np.cos(np.radians(15))) & (i < 8 / np.cos(np.radians(65))))
    assert s["sample"].tolist() == want.tolist() and (s["bs_linear"] == s["sample"]).all()
    assert np.allclose(s["ground_m"], np.sqrt(i[want] ** 2 - 64)) and (s["lat"] > 22.0).all() and np.allclose(s["lon"], 120.0)


def test_calibration_pads_short_pings(spark):
    a = [0.0] * 70 + [10.0] + [0.0] * 70 + [2.0] + [0.0] * 18
    df = spark.createDataFrame([(1, a), (1, a[:100])] * 20, "seg int, amps array<double>")
    c = T.calibration(df, ["seg"]).first()
    assert (c["idx_b"], c["idx_bsb"]) == (70, 141) and c["cc"] == pytest.approx(100.0 / 1.0)


def test_constant_amplitudes_do_not_break_the_density(spark):
    from soundlake.operators.stats import unimodality

    assert unimodality(spark.createDataFrame([(1.0,)] * 5, "v double"), "v").count() <= 1


def test_kmeans_merges_close_clusters(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(m, 0.05, 400) for m in (-5, 0, 5)])
    centres = R.cluster(spark.createDataFrame(pd.DataFrame({"z": v})), "z", 3)
    assert np.allclose(centres, [-5, 0, 5], atol=0.05)
    assert R.merged_count([0.0, 0.01, 5.0], [100, 100, 1], 10.0) == 1


def test_a_run_without_amplitude_has_no_variation(spark, tmp_path):
    import datetime

    from soundlake.checks import registry

    rows = [(i, datetime.datetime(2024, 1, 1, 0, i), 1, "a", 0.0 if i < 13 else 40.0, "{}") for i in range(10, 16)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    found = registry()[0]["a8_segment_stats"](spark, str(tmp_path)).collect()
    assert any(x.amp_mean == 0 and x.amp_cv is None for x in found)
    assert registry()[0]["f9_accept_segment"](spark, str(tmp_path)).collect() == []


def test_degree_minutes_round_as_c_does(spark):
    import random

    from soundlake.functions.geo import degree_minute

    rng = random.Random(5)
    some = [22.125 / 60, 10.245 / 60, 7 + 0.375 / 60, -3 - 59.999 / 60, 0.0] + [rng.randrange(-180 * 60000, 180 * 60000) / 60000 + 0.005 / 60 * rng.randrange(2) for _ in range(5000)]
    got = spark.createDataFrame([(v,) for v in some], "v double").select("v", degree_minute(F.col("v"), "lon").alias("s")).collect()
    for x in got:
        a = abs(x.v)
        assert x.s == f"{int(a)}°{(a - int(a)) * 60:05.2f}′{'E' if x.v >= 0 else 'W'}"


def test_longitudes_of_the_check_tables_are_those_of_the_sql(spark):
    import compare

    from soundlake.checks.base import VIEWS, track

    d = "/root/testdata/sf0.01"
    want = dict(compare.duck(d).execute(f"SELECT seq, lon FROM ({VIEWS['track']})").fetchall())
    assert {x.seq: x.lon for x in track(spark, d).select("seq", "lon").collect()} == want


def test_running_median_copies_the_windows_of_some_rows_only():
    block = np.random.default_rng(3).normal(size=(4000, 64))
    tracemalloc.start()
    got = blocks.running_median(block, 21)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6 and np.array_equal(got[7], blocks.running_median(block[7:8], 21)[0])
    assert blocks.running_median(block[:0], 21).shape == (0, 64)


def test_waterfall_layout_needs_no_rows_but_the_counts_per_bin(spark):
    rows = [("a", s, side, b, 0.0 if b > 6 else 1.0) for s in range(3) for side in ("port", "stbd") for b in range(s, 9)]
    ground = spark.createDataFrame([*rows, ("b", 0, "stbd", 4, 2.0)], "line string, seq int, side string, bin int, value double")
    pings = spark.createDataFrame([("a", 3), ("b", 1)], "line string, n_pings long")
    cells, layout = T.merge_sides(ground, ["line"], "side", pings, gap=4, bins=10)
    assert all("soundlake-places" in f for f in layout.inputFiles())
    assert {tuple(r) for r in layout.select("line", "nadir_col", "n_cols").collect()} == {("a", 7, 14), ("b", -2, 1)}
    for line, nadir, n in layout.select("line", "nadir_col", "n_cols").collect():
        cols = {r.col for r in cells.where(F.col("line") == line).collect()}
        assert min(cols) == 0 and max(cols) == n - 1
