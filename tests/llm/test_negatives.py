"""Hard negatives: against all scores sorted, with ties, copies, changed labels and unusable rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundlake.llm import grid
from soundlake.llm import negatives as N
from soundlake.llm.queries.negatives import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, is_anchor, scale, few=5, low=80, high=100):
    """rows (vec_id, embedding, label)."""
    fine = [(i, v, [math.floor(scale * x) for x in e], k) for i, (v, e, k) in enumerate(rows)
            if v is not None and k is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, a, x, k in fine:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), v, m) for j, v, y, m in fine if i != j and len(x) == len(y))
        for s, p, _ in [t for t in scored if t[2] == k][:few]:
            hit = [t for t in scored if t[2] != k and low * -s <= 100 * -t[0] <= high * -s][:few]
            out += [(a, p, n + 1, v, -s, -t) for n, (t, v, _) in enumerate(hit)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_query_on_given_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, lambda v: v % 100 == 0, 256)
    assert got(QUERIES["op12_hard_negatives"](spark, SF)) == want and want


@pytest.mark.parametrize("scale", [3, 100_000])
def test_ties_and_copies_over_small_blocks(spark, monkeypatch, scale):
    monkeypatch.setattr(grid, "ROWS", 40)
    monkeypatch.setattr(grid, "QUERIES", 5)
    rng = np.random.default_rng(scale)
    rows = [(int(i), rng.normal(size=11).round(2).tolist(), int(i) % 3) for i in rng.permutation(200)]
    rows += [(300 + i, rows[0][1], i % 2) for i in range(120)] + [(rows[3][0], *rows[3][1:]), (400, rows[0][1], 1), (400, rows[0][1], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(7)
    want = brute(rows, lambda v: v % 10 == 0, scale, 4, 30)
    assert got(N.hard_negatives(df, F.col("vec_id") % 10 == 0, scale, 4, 4, 30)) == want and want


def test_messy_rows(spark):
    one, nan, inf = [1.0, 0.5, -2.0], float("nan"), float("inf")
    rows = [(0, one, 1), (0, one, 1), (1, one, 2), (2, None, 1), (3, [], 1), (100, [], 1), (4, [], 2), (5, [nan, 0.0, 1.0], 1), (6, [inf, 0.0, 1.0], 2), (7, [None, 1.0, 1.0], 1),
            (8, [0.0, 0.0, 0.0], 2), (9, [1.0, 2.0], 1), (None, one, 2), (10, one, None), (200, [-1e9, 1.0, 3.0], 1), (11, [1.0, 0.5, -1.9], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"node": F.lit(1), "vec": F.lit("v"), "class": F.lit(2), "is_anchor": F.lit(True)})
    want = brute(rows, lambda v: v % 100 == 0, 256)
    assert got(N.hard_negatives(df, F.col("vec_id") % 100 == 0, 256)) == want and want
    assert N.hard_negatives(df.limit(0), F.col("vec_id") == 0, 256).count() == 0


def test_look_ups_give_inner_products():
    rng = np.random.default_rng(1)
    for top, kind in ((100, np.int32), (10**6, np.int64), (2**62, object)):
        for dim in (1, 8, 13):
            a, c = rng.integers(-top, top, (4, dim)), rng.integers(-top, top, (50, dim))
            found = N.scores(a, N.subset_sums(a.astype(kind)), N.plane_bytes(c), kind)
            assert found.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in c] for r in a]
    assert N.subset_sums(np.array([[1, 2, 4, 8]]))[0, 0, 5] == 5
