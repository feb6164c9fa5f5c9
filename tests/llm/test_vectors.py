"""Near-duplicate vectors: against brute force, with copies, crowded buckets and unusable vectors."""

import math

import numpy as np
from pyspark.sql import functions as F

from soundlake.llm import vectors
from soundlake.llm.graph import components
from soundlake.llm.queries.vectors import QUERIES
from tests.llm.brute import classes

SF = "/root/testdata/sf0.01"


def brute(rows, cosine=0.93):
    """{position: (links, component)} over rows (vec_id, embedding, label)."""
    fine = []
    for i, (_, e, label) in enumerate(rows):
        if e is not None and label is not None and all(x is not None and math.isfinite(x) for x in e) and any(e):
            fine.append((i, np.array(e, np.float64), label))
    linked = []
    for n, (i, x, k) in enumerate(fine):
        for j, y, m in fine[n + 1 :]:
            if k == m and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                linked.append((i, j))
    of = classes(range(len(rows)), linked)
    first = {}
    for i, c in of.items():
        first[c] = min(first.get(c, rows[i][0]), rows[i][0])
    return [(rows[i][0], sum(i in p for p in linked), first[of[i]]) for i in range(len(rows))]


def test_query_on_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in QUERIES["op7_embedding_near_dedup"](spark, SF).collect())
    assert got == sorted(brute(rows))


def built(n=500, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(n):
        c = centres[int(rng.integers(12)) if i % 3 else 0]
        v = (c + rng.normal(size=16) * rng.choice([0.1, 0.2, 0.3])).astype(np.float32).tolist()
        rows.append((i * 2 + 1, v, int(i % 2)))
    rows += [(10_000 + i, rows[5][1], rows[5][2]) for i in range(40)]
    return rows


def test_recall_and_no_false_links(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 30)
    rows = built()
    got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)).collect()}
    want = {k: (n, c) for k, n, c in brute(rows)}
    assert all(got[k].n_links <= n for k, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert all(got[k].n_links >= 40 for k in (rows[5][0], *range(10_000, 10_040)))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert sum(got[k].component_id == c for k, (_, c) in want.items()) >= 0.97 * len(want)


def test_messy_rows(spark):
    one = [1.0, 0.0, 2.0]
    rows = [(1, one, 1), (2, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, -0.0], 1), (8, [1.0, None, 2.0], 1), (9, [float("nan"), 0.0, 2.0], 1),
            (10, [float("inf"), 0.0, 2.0], 1), (11, [1.0, 0.0], 1), (12, [2.0, 0.0, 4.0], 1), (13, [-1.0, 0.0, -2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"node": F.lit(1), "vec": F.lit("v"), "n": F.lit(2)})
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect())
    assert got == sorted(brute(rows))
    assert vectors.near_duplicates(df.limit(0)).count() == 0
    assert sorted(r.n_links for r in vectors.near_duplicates(df.where("vec_id in (5, 7)")).collect()) == [0, 0]


def test_tables_reach_the_recall():
    for largest in (1, 500, 50_000, 10**9):
        bits, tables = vectors.plan(largest)
        p = 1 - math.acos(0.93) / math.pi
        assert 1 - (1 - p**bits) ** tables >= 0.99


def test_components_of_paths_stars_and_loops(spark):
    rng = np.random.default_rng(0)
    path = [(i, i + 1) for i in range(100, 400)]
    star = [(1000, 1000 + int(i)) for i in rng.permutation(300)]
    rest = [(int(a), int(b)) for a, b in rng.integers(2000, 2400, (250, 2))]
    edges = path + star + rest + [(7, 7), (9, 8), (8, 9), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    real = [e for e in edges if e[0] is not None and e[0] != e[1]]
    assert got == classes({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
