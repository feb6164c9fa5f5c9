"""Contour lines: against a walk along the segments, over tiles of any size, with rings through many tiles and lines that end at holes."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from soundlake.operators import lines as L
from soundlake.operators.raster import Grid, contour_segments


def layer(spark, a):
    r, c = np.nonzero(np.isfinite(a))
    return spark.createDataFrame(pd.DataFrame({"row": r.astype("int32"), "col": c.astype("int32"), "z": a[r, c]}), "row int, col int, z double")


def grid_of(a):
    return Grid(100.0, 900.0, 2.0, *a.shape)


def walked(segments):
    """{(level, line): (closed, [(x, y), ...])} by following (lev, a, b, ax, ay, bx, by) one by one."""
    out = {}
    for lev in {s.lev for s in segments}:
        after = {s.a: s for s in segments if s.lev == lev}
        ends = {s.b for s in after.values()}
        left = set(after)
        for head in sorted(left - ends) + sorted(left):
            if head in left:
                at, points = after[head], [(after[head].ax, after[head].ay)]
                while True:
                    left.discard(at.a)
                    points.append((at.bx, at.by))
                    if at.b == head or at.b not in after:
                        break
                    at = after[at.b]
                out[lev, head] = (at.b == head, points)
    return out


def surface(kind):
    y, x = np.mgrid[0:41, 0:37]
    if kind == "hill":
        return 40.3 - np.hypot(y - 20, x - 18) * 1.7
    if kind == "spiral":  # one band that winds through all tiles
        angle, radius = np.arctan2(y - 20, x - 18), np.hypot(y - 20, x - 18)
        return 12 + 4 * np.sin(angle + radius * 0.9)
    a = np.random.default_rng(4).normal(15, 5, y.shape)
    a[np.random.default_rng(5).random(a.shape) < 0.04] = np.nan
    return a.round(0) if kind == "steps" else a


@pytest.mark.parametrize(("kind", "tile"), [("hill", 5), ("spiral", 5), ("noise", 5), ("steps", 7), ("noise", 256)])
def test_lines_equal_a_walk(spark, monkeypatch, kind, tile):
    monkeypatch.setattr(L, "TILE", tile)
    a = surface(kind)
    df, grid = layer(spark, a), grid_of(a)
    want = walked(L.directed_segments(df, grid, "z").collect())
    found = {}
    for p in L.contour_lines(df, grid, "z").collect():
        found.setdefault((p.depth_m, p.line), []).append((p.ord, p.x, p.y, p.n, p.closed))
    assert set(found) == set(want) and want
    for k, points in found.items():
        points.sort()
        closed, line = want[k]
        assert [p[0] for p in points] == list(range(len(line))) and {p[3:] for p in points} == {(len(line), closed)}
        assert np.allclose([p[1:3] for p in points], [(100 + (x + 0.5) * 2, 900 - (y + 0.5) * 2) for x, y in line])
    loose = contour_segments(df, grid, "z").count()
    assert loose == sum(len(p) - 1 for p in found.values())


def test_higher_ground_is_on_the_right(spark):
    a = surface("hill")
    rings = {}
    for p in L.contour_lines(layer(spark, a), grid_of(a), "z").collect():
        if p.closed:
            rings.setdefault((p.depth_m, p.line), []).append((p.ord, p.x, p.y))
    assert rings
    for points in rings.values():
        x, y = np.array([p[1:] for p in sorted(points)]).T
        assert np.sum(x[:-1] * y[1:] - x[1:] * y[:-1]) < 0  # clockwise round the top


def test_long_lines_become_parts_that_share_a_point(spark, monkeypatch):
    monkeypatch.setattr(L, "PART", 7)
    a = surface("spiral")
    points = L.contour_lines(layer(spark, a), grid_of(a), "z")
    n = {(p.depth_m, p.line): p.n for p in points.where("ord = 0").collect()}
    parts = {}
    for f in L.contour_features(points).collect():
        g = json.loads(f.feature)
        assert g["geometry"]["type"] == "LineString" and g["properties"] == {"depth_m": float(f.depth_m), "level": f.kind} and len(g["geometry"]["coordinates"]) == f.n <= 8
        parts.setdefault((f.depth_m, f.line), {})[f.part] = g["geometry"]["coordinates"]
    for k, of in parts.items():
        assert sorted(of) == list(range(len(of)))
        assert all(of[i][-1] == of[i + 1][0] for i in range(len(of) - 1))
        assert sum(len(c) - 1 for c in of.values()) == n[k] - 1
    assert max(map(len, parts.values())) > 2


def test_no_data_no_lines(spark):
    a = surface("hill")
    df = layer(spark, a)
    assert L.contour_lines(df.limit(0), grid_of(a), "z").count() == 0
    assert L.contour_features(L.contour_lines(df.withColumn("z", F.lit(3.0)), grid_of(a), "z")).count() == 0


def test_linked_lists():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 333):
        order = rng.permutation(n)
        before, low = np.full(n, -1), rng.permutation(n)
        cuts = np.sort(rng.choice(n, min(n, 6), replace=False))
        want = {}
        for part in np.split(order, cuts):
            if len(part):
                ring = len(part) > 1 and rng.random() < 0.5
                before[part[1:]] = part[:-1]
                if ring:
                    before[part[0]] = part[-1]
                    part = np.roll(part, -int(np.argmin(low[part])))
                want |= {int(i): (int(part[0]), k, ring) for k, i in enumerate(part)}
        first, steps, ring = L.ranks(before, low)
        assert {i: (int(first[i]), int(steps[i]), bool(ring[i])) for i in range(n)} == want


def test_chains_keep_their_points_in_one_row():
    import pyarrow as pa

    # On a grid of 9 columns: an open chain of two segments, and a ring of four that starts at its smallest crossing.
    key = lambda row, col, up: (row * 10 + col) * 2 + up
    open_, ring = [key(0, 1, 0), key(0, 1, 1), key(2, 0, 1)], [key(4, 3, 0), key(4, 4, 1), key(5, 3, 0), key(4, 3, 1)]
    a, b = [open_[1], open_[0], *ring], [open_[2], open_[1], *ring[1:], ring[0]]
    along = {k: 0.25 + (k // 20 if k % 2 else k // 2 % 10) for k in (*open_, *ring)}
    t = pa.table({"lev": [5] * 6, "tile": [0] * 6, "a": a, "b": b, "at": [along[k] for k in a], "bt": [along[k] for k in b]})
    first, second = L._chains(t, 9).to_pylist()
    assert first == {"lev": 5, "id": open_[0], "to": open_[2], "n": 2, "low": open_[0], "low_place": 0, "xs": [1.25, 1.0, 0.0], "ys": [0.0, 0.25, 2.25]}
    assert second == {"lev": 5, "id": ring[0], "to": ring[0], "n": 4, "low": ring[0], "low_place": 0, "xs": [3.25, 4.0, 3.25, 3.0, 3.25], "ys": [4.0, 4.25, 5.0, 4.25, 4.0]}


def test_rings_within_a_tile_do_not_meet(spark, monkeypatch):
    met = []
    ranked = L._ranked
    monkeypatch.setattr(L, "_ranked", lambda state: met.append(state.count()) or ranked(state))
    y, x = np.mgrid[0:30, 0:30]
    a = 30.0 - np.hypot(x - 14.3, y - 15.1)
    a[a < 17] = 17.0
    points = L.contour_lines(layer(spark, a), grid_of(a), "z")
    assert points.where("closed").select("depth_m").distinct().count() == 2 and points.where("not closed").count() == 0
    assert met == [0, 0]
