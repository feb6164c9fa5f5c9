"""The pipeline: stage by stage and as a whole against plain versions."""

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from soundlake.llm.language import KEEP_SCORE, fit, identify, training
from soundlake.operators.lineage import cut
from tests.llm.brute import jaccard_classes, personal
from tests.llm.test_packing import check_places

SF = "/root/testdata/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def redacted(text):
    spans = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in personal(text)[1].split(",") if s)]
    out, at = "", 0
    for a, b, k in sorted(spans):
        if a >= at:
            out += text[at:a] + f"[{k.upper()}]"
        at = max(at, b)
    return out + text[at:]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        before = docs
        docs = cut(stage(spark, docs, SF))
        out.append((name, before, docs))
    return out


def test_stages(steps):
    assert [n for n, _, _ in steps] == ["language ID", "exact dedup", "n-gram Jaccard join", "PII", "best-fit packing"]
    assert all(after.columns == before.columns for _, before, after in steps[:-1])


def test_language_keeps_what_the_model_knows(steps):
    _, before, after = steps[0]
    scored = identify(before, fit(training(before)))
    assert texts(after) == texts(scored.where((F.col("lang_pred") != "und") & (F.col("score") >= KEEP_SCORE)))
    assert after.count() == scored.where("lang_pred <> 'und'").count()


def test_exact(steps):
    _, before, after = steps[1]
    first = {}
    for k, t in sorted(texts(before).items()):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), (k, t))
    assert texts(after) == dict(first.values())


def test_near(steps):
    _, before, after = steps[2]
    docs = texts(before)
    assert texts(after) == {k: docs[k] for k, (_, c) in jaccard_classes(docs, 5, 80, 100).items() if k == c}


def test_personal_data(steps):
    _, before, after = steps[3]
    assert texts(after) == {k: redacted(t) for k, t in texts(before).items()}
    assert after.where(F.char_length("text") != F.col("n_chars")).count() == before.where(F.char_length("text") != F.col("n_chars")).count()


def test_packed(steps):
    _, before, after = steps[4]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = after.collect()
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {k: len(tok.encode(t, add_special_tokens=False).ids) + 1 for k, t in texts(before).items()}
    check_places(rows)


def test_run_gives_the_last_stage(spark, steps):
    drop = ["sequence_id", "offset"]
    assert sorted(map(tuple, P.run(spark, SF).drop(*drop).collect())) == sorted(map(tuple, steps[-1][2].drop(*drop).collect()))
