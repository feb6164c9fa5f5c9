"""Ranked lexical search: against scores of all documents, with ties, repeats, long and empty texts, and the limit on accumulators."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from soundlake.llm import lexical
from soundlake.llm.queries.lexical import QUERIES
from tests.llm.brute import LOWER

SF = "/root/testdata/sf0.001"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in counts if c]
    n, length, df = len(held), sum(s for _, _, s in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if df[t]}
        scored = []
        for d, c, size in held:
            m = 50 + 50 * size * n // length
            s = sum(x * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t, x in w.items() if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_query_on_given_tables(spark):
    read = lambda t, k: [(r[k], r.text) for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
    assert got(QUERIES["op13_ranked_search"](spark, SF)) == brute(read("documents", "doc_id"), read("benchmark", "item_id"), 50)


def corpus(n=600, seed=5):
    rng = np.random.default_rng(seed)
    pool = [f"w{i}" for i in range(400)]
    p = 1 / np.arange(1, 401)
    p /= p.sum()
    docs = [(int(i), " ".join(rng.choice(pool, int(rng.integers(1, 60)), p=p))) for i in rng.permutation(n)]
    items = [(i, " ".join(rng.choice(pool, 25, p=p))) for i in range(12)] + [(50 + i, docs[i][1]) for i in range(4)]
    docs += [(2000 + i, docs[0][1]) for i in range(70)]
    return docs, items


def test_small_slices(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 500)
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(lexical.ranked_search(d, spark.createDataFrame(items, "item_id long, text string"), 7)) == brute(docs, items, 7)


def test_messy_rows(spark):
    long = " ".join(f"x{i % 5000}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, ".,;\x00\x7f"), (4, "Ärger É naïve Straße 42"), (5, "ärger É"), (6, long), (7, "the the the"), (7, "the the the"), (None, "the the the"), (None, "x1 the"), (8, "THE-End_of the1")]
    items = [(1, "ÄRGER Ärger naïve"), (2, None), (3, "  "), (4, "the end"), (4, "the end"), (5, "x1 x2 unknown"), (None, "42")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"term": F.lit(1), "terms": F.lit("t"), "n": F.lit(3), "id": F.lit(0), "node": F.lit(2), "score": F.lit(1.5)})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({"id": F.lit("x"), "weights": F.lit(1)})
    want = brute(docs, items, 5)
    assert got(lexical.ranked_search(d, i, 5)) == want and len(want) > 10
    assert lexical.ranked_search(d.limit(0), i, 3).count() == 0
    assert lexical.ranked_search(d, i.limit(0), 3).count() == 0
    assert lexical.ranked_search(d.where("doc_id < 4"), i, 3).count() == 0


def test_accumulators_are_limited():
    """Rare terms settle who can win: documents that hold only common ones get no accumulator, and the best are exact all the same."""
    rng = np.random.default_rng(2)
    n, k = 5000, 10
    rare = (np.arange(0, 200, 10), rng.integers(9_000, 10_000, 20))
    lists = [rare, (np.arange(5, 400), rng.integers(100, 900, 395)), (np.arange(n), rng.integers(1, 50, n))]
    docs, total, created = lexical.accumulate(lists, n, k)
    whole = np.zeros(n, np.int64)
    for at, score in lists:
        whole[at] += score
    assert created <= 20 and (whole[docs] == total).all()
    best = np.lexsort((np.arange(n), -whole))[:k]
    assert set(best.tolist()) <= set(docs.tolist())
    # a tie with the k-th score is no reason to stop
    docs, _, created = lexical.accumulate([(np.array([1, 2]), np.array([5, 5])), (np.array([0]), np.array([5]))], 9, 2)
    assert created == 3 and set(docs.tolist()) == {0, 1, 2}
