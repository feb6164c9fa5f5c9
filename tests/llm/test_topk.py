"""Exact top-k search: against all scores sorted, with ties, copies, wide score ranges and unusable vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundlake.llm import grid, topk
from soundlake.llm.queries.topk import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, is_query, k, scale):
    fine = [(i, v, [math.floor(scale * x) for x in e]) for i, (v, e) in enumerate(rows) if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, q, a in fine:
        if is_query(q):
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), v) for j, v, b in fine if i != j and len(a) == len(b))[:k]
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(found)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_query_on_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(QUERIES["op11_exact_top_k"](spark, SF)) == brute(rows, lambda v: v % 20 == 0, 20, 64)


@pytest.mark.parametrize("scale", [2, 5000])
def test_ties_copies_and_many_passes(spark, monkeypatch, scale):
    monkeypatch.setattr(grid, "ROWS", 40)
    monkeypatch.setattr(grid, "QUERIES", 7)
    monkeypatch.setattr(topk, "BINS", 16)
    rng = np.random.default_rng(scale)
    rows = [(int(i), rng.normal(size=6).round(2).tolist()) for i in rng.permutation(200)]
    rows += [(300 + i, rows[0][1]) for i in range(120)] + [(rows[3][0], rows[3][1]), (400, rows[0][1]), (400, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    assert got(topk.top_k(df, F.col("vec_id") % 10 == 0, 9, scale)) == brute(rows, lambda v: v % 10 == 0, 9, scale)


def test_messy_rows(spark):
    one, nan, inf = [1.0, 0.5, -2.0], float("nan"), float("inf")
    rows = [(0, one), (0, one), (1, one), (2, None), (3, []), (20, []), (4, [nan, 0.0, 1.0]), (5, [inf, 0.0, 1.0]), (6, [None, 1.0, 1.0]), (7, [0.0, 0.0, 0.0]), (8, [1.0, 2.0]), (None, one), (40, [-1e9, 1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"node": F.lit(1), "vec": F.lit("v"), "dim": F.lit(2), "is_query": F.lit(True), "rank": F.lit(0)})
    want = brute(rows, lambda v: v % 20 == 0, 3, 64)
    assert got(topk.top_k(df, F.col("vec_id") % 20 == 0, 3, 64)) == want and want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0, 3, 64).count() == 0
    assert topk.top_k(df, F.col("vec_id") == 99, 3, 64).count() == 0


def test_scores_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for top in (100, 10**6, 2**40, 2**62):
        a, b = rng.integers(-top, top, (5, 9)), rng.integers(-top, top, (7, 9))
        want = [[min(max(sum(int(x) * int(y) for x, y in zip(r, s, strict=True)), -(2**63)), 2**63 - 1) for s in b] for r in a]
        assert topk.scores(a, b).tolist() == want


def test_blocks_leave_only_counts(spark):
    """A block of n rows sends no more intervals than a query still needs."""
    import pyarrow as pa

    vec = pa.array([[x] for x in range(1000)], pa.list_(pa.int64()))
    rows = pa.table({"node": pa.array(range(1000)), "vec": vec})
    asked = pa.table({"node": pa.array([5000]), "vec": pa.array([[1]], pa.list_(pa.int64())), "low": pa.array([-1024]), "need": pa.array([20])})
    out = topk._histogram(4)(rows, asked)
    assert sum(out["n"].to_pylist()) >= 20 and out.num_rows <= 6 and max(out["bin"].to_pylist()) == (999 + 1024) // 4
