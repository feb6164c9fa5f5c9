"""SentencePiece ids against the library's own encoder, and back."""

import hashlib
import pickle
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from soundlake.llm import pieces
from soundlake.llm.pieces import decode, encode, merge_tree
from soundlake.llm.queries.pieces import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_query_against_the_library(spark):
    texts = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    rows = QUERIES["op4_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows:
        ids = SP.encode(texts[r.conv_id, r.turn])
        assert r.n_pieces == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_all_documents_against_the_library(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_documents"](spark, SF).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows:
        ids = SP.encode(texts[r.doc_id])
        assert r.n_pieces == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_messy_rows(spark):
    rng = random.Random(1)
    texts = ["a  b", "", " ", "   x   y  ", None, "hello wörld 梦梦 𝄞\n\ttab", "x" * 700, "abc" * 300, " " * 40 + "a", "Internationalization, don't! 12345 http://x.y/z?q=1", " a", "<s>hi</s>", "\u0000z"]
    texts += ["".join(rng.choice("abeinorst  éñ.,\n019") for _ in range(rng.randint(1, 80))) for _ in range(120)]
    texts += [texts[5]] * 3
    docs = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "i long, text string")
    docs = docs.withColumns({"ids": F.lit("x"), "pos": F.lit(1), "unit": F.lit(2), "decoded": F.lit(3)})
    coded = encode(docs, PATH)
    assert set(coded.columns) == set(docs.columns)
    got = sorted((r.text or "", tuple(r.ids), r.decoded) for r in decode(coded, PATH).collect())
    assert got == sorted((t or "", tuple(SP.encode(t or "")), t or "") for t in texts)
    assert encode(docs.limit(0), PATH).count() == 0 and decode(coded.limit(0), PATH).count() == 0


def test_merges_take_the_best_rank_then_the_leftmost():
    rank = {"ab": 0, "bc": 1, "abc": 2, "aa": 3}
    assert [t[0] for t in merge_tree("abcaaa", rank)] == ["abc", "aa", "a"]


def test_words_that_are_not_common_are_joined(spark, monkeypatch):
    texts = ["one two three four five", "two two three", "five 梦 four two", None, "", " two  two ", "é" * 70 + " two"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for most in (0, 1, 3, 1 << 17):
        monkeypatch.setattr(pieces, "COMMON", most)
        got = {r.i: (r.ids, r.decoded) for r in decode(encode(docs, PATH), PATH).collect()}
        assert got == {i: (SP.encode(t or ""), t or "") for i, t in enumerate(texts)}


def test_common_words_are_placed_without_an_exchange(spark):
    docs = spark.createDataFrame([(1, "one two three")], "i long, text string")
    plan = decode(encode(docs, PATH), PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_letters_are_cut_from_other_characters_only_where_no_piece_holds_both(spark):
    assert pieces.mixed(["▁a1"]) and not pieces.mixed(["▁a", "▁1", "▁", "..", "12"])
    row = spark.createDataFrame([("  die.\nVerein,12 ñé 梦",)], "t string").select(pieces.units(F.col("t")).alias("a"), pieces.units(F.col("t"), True).alias("b")).first()
    assert row.a == ["▁▁▁die.\nVerein,12", "▁ñé", "▁梦"] and row.b == ["▁▁▁die", ".\n", "Verein", ",12", "▁ñé", "▁梦"]


def test_words_that_are_not_common_are_placed_without_an_exchange(spark, monkeypatch):
    texts = ["one two three " * 5 + "Zwölf 梦梦 x", None, "", " two  four", "q" * 70 + " two", "a▁b 𝄞 " * 6 + "𝄞𝄞 <s>"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    monkeypatch.setattr(pieces, "COMMON", 2)
    back = decode(encode(docs, PATH), PATH)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert {r.i: r.ids for r in back.collect()} == {i: SP.encode(t or "") for i, t in enumerate(texts)}


def test_units_of_a_task_are_those_of_a_column(spark):
    texts = ["  die.\nVerein,12 ñé 梦", None, "", " ", "a", "▁▁b1▁", "x" * 300 + "  ", "\u0000z 𝄞a", "1 2  3"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    for split in (False, True):
        flat, ends = pieces.units_of(pa.array(texts, pa.string()), split)
        got = [flat.to_pylist()[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        assert got == [r.u for r in rows.select(pieces.units(F.col("t"), split).alias("u")).collect()]


def test_paths_of_many_words_at_once(spark):
    rng = random.Random(2)
    table, zero = pieces.piece_table(PATH)
    words = [pieces.SPACE + "".join(rng.choice("abeinorstñ梦𝄞") for _ in range(n)) for n in [*range(1, 60), 5000]]
    lattices, joints = pieces.Lattices(table), pieces.Joints(table)
    assert pieces.folded_here(words, lattices, joints, zero).to_pylist() == [SP.encode(w[1:]) for w in words]


def test_a_worker_holds_little_of_the_model():
    table, _ = pieces.piece_table(PATH)
    sent = pickle.dumps(pieces.Joints(table))
    tracemalloc.start()
    try:
        joints = pickle.loads(sent)
        assert tracemalloc.get_traced_memory()[0] < 15e6
    finally:
        tracemalloc.stop()
    assert all(joints._spine(side, r[1]) == [list(x) for x in r[4 + side]] for r in table for side in (0, 1))


def test_joints_of_a_model_without_pieces():
    assert pieces.Joints([]).free(-1, -1)
