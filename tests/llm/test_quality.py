"""Quality scores: held-out accuracy, what the model is made of, and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from soundlake.llm import quality as Q
from soundlake.llm.quality import FEATURES, _split, features, fit, quality_scores, text_features
from soundlake.llm.queries.quality import QUERIES

SF = "/root/testdata/sf0.01"
PLAIN = "/root/testdata/sf0.001"


def test_query_on_held_out_documents(spark):
    rows = QUERIES["op5_quality"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    good = [r.predicted for r in held if labels[r.doc_id] == 1]
    bad = [r.predicted for r in held if labels[r.doc_id] == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x, y)
    new = rng.random((1000, 3))
    assert (0, 1) in model.pairs
    assert np.mean((model.score(new) > 0.5) == ((new[:, 0] > 0.5) ^ (new[:, 1] > 0.5))) > 0.9


def test_scores_are_sums_of_looked_up_numbers():
    rng = np.random.default_rng(1)
    x = rng.random((500, 4))
    model = fit(x, (x[:, 2] > 0.3).astype(float))
    row = x[7]
    total = model.bias + sum(t[np.searchsorted(c, v, "right")] for c, t, v in zip(model.cuts, model.tables, row, strict=True))
    for (i, j), g in zip(model.pairs, model.grids, strict=True):
        total += g[np.searchsorted(model.coarse[i], row[i], "right"), np.searchsorted(model.coarse[j], row[j], "right")]
    assert np.isclose(model.score(x)[7], 1 / (1 + np.exp(-total)))
    assert np.mean((model.score(x) > 0.5) == (x[:, 2] > 0.3)) > 0.98


def test_split_against_all_splits():
    rng = np.random.default_rng(2)
    g, h, n = rng.normal(size=20), rng.random(20) + 0.1, np.full(20, 10)
    gain, k, left, right = _split(g, h, n)
    best = max(range(1, 20), key=lambda k: g[:k].sum() ** 2 / (h[:k].sum() + 1) + g[k:].sum() ** 2 / (h[k:].sum() + 1))
    assert k == best and np.isclose(left, g[:k].sum() / (h[:k].sum() + 1)) and np.isclose(right, g[k:].sum() / (h[k:].sum() + 1)) and gain > 0


def test_features_by_hand():
    import pyarrow as pa

    got = dict(zip(FEATURES, features(pa.array(["Ab ab ab! 12\n", None, ""]))[0], strict=True))
    assert np.isclose(got["log_bytes"], np.log1p(13)) and np.isclose(got["log_words"], np.log1p(4)) and got["word_bytes"] == 9 / 4
    assert got["upper"] == 1 / 13 and got["digit"] == 2 / 13 and got["mark"] == 1 / 13 and got["line"] == 1 / 13 and got["same_next"] == 1 / 4
    assert got["distinct_words"] == 3 / 4 and got["top_word"] == 2 / 4 and got["first_upper"] == 1 / 4 and got["last_mark"] == 1 / 4


def test_messy_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "w" * 300_000), (4, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"x": F.lit(1), "score": F.lit("s"), "quality": F.lit(1)})
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, None), (None, 1), (99, 1)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).count() == 0 and text_features(docs.limit(0)).count() == 0


def test_query_equals_a_plain_sum_of_table_entries(spark):
    """Every score of op5 again, row by row in plain Python, from the fitted tables."""
    import math
    from bisect import bisect_right

    docs, labels = (spark.read.parquet(f"{PLAIN}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    table = Q.text_features(docs).persist()
    model = Q.fit_labelled(table, labels.where(fold != 0))
    want = {}
    for row in table.select("doc_id", "x").collect():
        total = model.bias
        for v, cuts, entries in zip(row.x, model.cuts, model.tables, strict=True):
            total += entries[bisect_right(cuts.tolist(), v)]
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            total += grid[bisect_right(model.coarse[i].tolist(), row.x[i])][bisect_right(model.coarse[j].tolist(), row.x[j])]
        want[row.doc_id] = 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))
    table.unpersist()
    got = QUERIES["op5_quality"](spark, PLAIN).collect()
    assert len(got) == len(want) == docs.count() and model.pairs
    for r in got:
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-9, abs_tol=1e-12) and r.predicted == int(r.score >= 0.3)
