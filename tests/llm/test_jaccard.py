"""N-gram Jaccard join: against all pairs, on given and on built tables."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from soundlake.llm.jaccard import Threshold, drop_similar, similar_documents
from soundlake.llm.queries.jaccard import QUERIES
from tests.llm.brute import jaccard_classes

SF = "/root/testdata/sf0.001"


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert result(QUERIES["op1_ngram_jaccard"](spark, SF)) == jaccard_classes(docs, 3, 90, 100)


def corpus():
    """Near copies around one text, a chain in which only neighbours link, a passage that many share, short texts and copies."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    texts = []
    base = some(160)
    for _ in range(40):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts.append(t)
    link = some(120)
    for i in range(15):
        link = list(link)
        link[8 * i : 8 * i + 2] = some(2)
        texts.append(link)
    passage = some(60)
    texts += [some(rng.randint(5, 120)) + passage + some(rng.randint(5, 120)) for _ in range(40)]
    texts += [passage + some(rng.randint(0, 4)) for _ in range(20)]
    texts += [some(n) for n in (1, 2, 3, 4, 9, 10, 11) for _ in range(3)]
    texts += [list(texts[3]), list(texts[60]), ["A"] * 50, ["a"] * 90]
    rng.shuffle(texts)
    return {i * 3 + 7: " ".join(t).upper() if i % 5 == 0 else "\t".join(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize(("width", "num", "den", "crowded"), [(3, 90, 100, 8), (5, 80, 100, 8), (3, 90, 100, 2), (2, 70, 100, 3)])
def test_built_table_against_all_pairs(spark, width, num, den, crowded):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert result(similar_documents(docs, width, num, den, crowded=crowded)) == jaccard_classes(texts, width, num, den)


def test_messy_rows(spark):
    rows = [(4, None), (2, ""), (9, " \t "), (8, "one two"), (5, "ONE  two"), (5, "ONE two"), (None, "one two"), (6, "Ünë two"), (7, "x " * 50_000), (1, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit(1), "n": F.lit("n"), "prefix": F.lit(2), "node": F.lit(3)})
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in similar_documents(docs).collect())
    assert got == [(-1, 1, 5), (1, 1, 1), (2, 0, 2), (4, 0, 4), (5, 1, 5), (5, 1, 5), (6, 1, 6), (7, 1, 1), (8, 1, 5), (9, 0, 9)]
    kept = drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null and doc_id <> 5").collect()) == [1, 2, 4, 6, 9]
    assert similar_documents(docs.limit(0)).count() == 0 and drop_similar(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=60), st.sets(st.integers(0, 400), max_size=8), st.sets(st.integers(0, 400), max_size=8), st.sampled_from([(90, 100), (80, 100), (70, 100)]))
def test_linked_sets_share_more_than_they_may_spare(a, add, drop, by):
    """If two sets link, their prefixes share more columns than either may leave out."""
    limit, b = Threshold(*by), (a | add) - drop
    common = len(a & b)
    if b and a != b and by[1] * common >= by[0] * len(a | b):
        x, y = (sorted(s)[: limit.prefix(len(s))] for s in (a, b))
        assert len(set(x) & set(y)) > max(limit.spare(len(a)), limit.spare(len(b)))
