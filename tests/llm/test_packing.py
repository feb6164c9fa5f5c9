"""Packing: ids against the tokenizer, sequences without gaps, and the open bins."""

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from soundlake.llm.packing import OpenBins, encoder, pack, pack_documents, pieces
from soundlake.llm.queries.packing import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)


def brute(text, length=4096):
    ids = TOK.encode(text or "", add_special_tokens=False).ids + [1]
    return [(k, s, len(ids[s : s + length]), zlib.crc32(np.array(ids[s : s + length], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), length))]


def check_places(rows, length=4096):
    of = {}
    for r in rows:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in of.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(of)


def test_query_against_the_tokenizer(spark):
    rows = QUERIES["op6_best_fit_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = sorted((k, *p) for k, t in texts.items() for p in brute(t))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences, tokens = check_places(rows), sum(r.length for r in rows)
    assert sequences <= -(-tokens // 4096) * 1.05 + 1


def test_messy_rows(spark):
    texts = [None, "", "a b", "a b", "w" * 9000, "it's <|endoftext|> 'S", "é" * 5000, "x\x1cy z\u0085q", "Σας ΑΣ İ ǅ", "tail " * 9000]
    docs = spark.createDataFrame([(i // 2 if i else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, length int").withColumn("offset", F.lit(7))
    rows = pack_documents(docs, PATH).collect()
    want = sorted((-1 if i == 0 else i // 2, *p) for i, t in enumerate(texts) for p in brute(t))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    check_places(rows)
    assert pack_documents(docs.limit(0), PATH).count() == 0


def test_ids_leave_with_the_pieces(spark):
    docs = spark.createDataFrame([(1, "the cat " * 9)], "doc_id long, text string")
    found = pieces(docs, PATH, length=5).orderBy("piece").collect()
    assert np.frombuffer(b"".join(r.ids for r in found), "<u4").tolist() == TOK.encode("the cat " * 9, add_special_tokens=False).ids + [1]


def test_encoder_on_odd_texts():
    rng = random.Random(3)
    letters = "abcXYZ'stre  \n\t.,!*é ÉßñÑ019ªº½ǅİΣσςａ́ \u0085\x1c<|>梦"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder(PATH)(texts)] == [TOK.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120), st.integers(1, 6))
def test_open_bins(sizes, most):
    """A plain version: all open bins in a list."""
    bins, opened, made = OpenBins(50, most), [], 0
    for n in sizes:
        fits = [b for b in opened if b[1] >= n]
        number, offset = bins.put(n)
        if fits:
            room = min(b[1] for b in fits)
            assert 50 - offset == room and number in [b[0] for b in fits if b[1] == room]
            opened = [b for b in opened if b[0] != number]
        else:
            if len(opened) >= most and n < 50:
                opened.remove(min(opened, key=lambda b: (b[1], -opened.index(b))))
            assert (number, offset) == (made, 0)
            room, made = 50, made + 1
        if room > n:
            opened.append((number, room - n))
        assert sorted(b[1] for b in opened) == sorted(r for r, bs in bins.by_free.items() for _ in bs)


def test_packing_is_the_same_again(spark):
    items = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") * 37 % 4000 + 1).alias("length"), F.lit(0).alias("ids_crc32"))
    a, b = (sorted(map(tuple, pack(items.repartition(n), per_task=1000).collect())) for n in (2, 7))
    assert a == b
