"""Language identification: held-out accuracy, the filters, odd rows."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from soundlake.llm.language import SLOTS, Filters, fit, grams, identify, known_language, slots
from soundlake.llm.queries.language import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_documents(spark):
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.99


def test_filters_return_every_language_that_has_an_n_gram(spark):
    docs = spark.createDataFrame([("shared words here and alpha", "a"), ("shared words here and omega", "b"), ("wholly other stuff", "c")] * 3, "text string, lang string")
    filters = fit(docs)
    assert filters.languages == ["a", "b", "c"] and np.allclose(filters.chance, [(np.count_nonzero(filters.masks & np.uint64(1 << k)) / SLOTS) ** 3 for k in range(3)])

    def has(text):
        value, _ = grams(pa.array([text]))
        mask = np.full(len(value), 7, np.uint64)
        for s in slots(value):
            mask &= filters.masks[s]
        return mask

    assert (has("shared words") & np.uint64(3) == 3).all()
    assert (has("omega") & np.uint64(2) == 2).all() and (has("alpha") & np.uint64(1) == 1).all()


def test_score_is_the_share_of_n_grams_beyond_chance(spark):
    """All languages' slots empty but for one text's n-grams: brute-force counting gives the score."""
    value, _ = grams(pa.array(["abcdef"]))
    masks = np.zeros(SLOTS, np.uint64)
    for s in slots(value):
        masks[s] |= np.uint64(1)
    filters = Filters(["x", "y"], masks, np.array([0.25, 0.0]))
    docs = spark.createDataFrame([(1, "abcdef"), (2, "abcdefzzzzzz"), (3, "123 !!"), (4, None), (5, "qqqqqq")], "doc_id int, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, filters).collect()}
    n, _ = grams(pa.array(["abcdefzzzzzz"]))
    assert got[1] == ("x", 1.0) and got[3] == got[4] == ("und", 0.0) and got[5] == ("x", 0.0)
    assert got[2][0] == "x" and np.isclose(got[2][1], (len(value) / len(n) - 0.25) / 0.75)


def test_messy_rows(spark):
    rows = [(1, "the quick brown fox", "en"), (1, "the quick brown fox", "en"), (2, None, "en"), (3, "", None), (4, "der schnelle braune fuchs", "de"), (None, "der braune", "de"), (5, "é", None),
            (6, "the quick " * 30_000, "en"), (7, "12 34 !?", "de"), (8, "жжжж", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("old"), "gram": F.lit(1), "l": F.lit(2)})
    filters = fit(docs)
    got = [(r.doc_id, r.lang_pred) for r in identify(docs, filters).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "de"), (None, "de"), (5, "de"), (6, "en"), (7, "und"), (8, "de")], key=str)
    kept = known_language(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {1, 4, 6, None} and {r.score for r in kept.collect()} == {"old"}
    assert known_language(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in identify(docs, fit(docs.limit(0))).collect()} == {"und"}
