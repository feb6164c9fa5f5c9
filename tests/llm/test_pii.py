"""Personal data: base spans against plain patterns, and what bootstrapping adds."""

import random

from pyspark.sql import functions as F

from soundlake.llm.pii import KINDS, base_spans, learn, marked, personal_data, redact
from soundlake.llm.queries.pii import QUERIES
from tests.llm.brute import personal, sha

SF = "/root/testdata/sf0.001"


def test_query_against_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op2_pii"](spark, SF).collect():
        counts, spans = personal(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == sha(spans)
        assert set(filter(None, spans.split(","))) <= set(filter(None, r.spans.split(",")))


def joined(text):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base_spans(text))


def test_base_spans_on_odd_texts():
    rng = random.Random(11)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1112", "a@b.c", "a@b", "@x.y", "x.y@z-.q.r.", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "001.02.3.4", "٣.1.1.1", "+1 (202) 555-0100",
             "+12345678", "+1+12345678", "+1 2 3", " ", "é", "-", ".", "5", "12 34", "..", "%_+a@b-c.d", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert joined(text) == personal(text)[1], text


def test_long_runs_take_linear_time():
    for run in ("1" * 200_000, "a" * 200_000, "1 " * 100_000, "1." * 100_000, "a@" * 100_000, "+1 " * 50_000):
        base_spans(run)


def built():
    """An address follows 'mail me:' nearly always, once in a form the patterns miss; numbers also follow ordinary words."""
    rng = random.Random(4)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta".split())
    rows = []
    for i in range(60):
        rows.append(f"{word()} {word()} mail me: user{i}@mail{i}.example.com {word()}")
        rows.append(f"{word()} {word()} order {rng.randint(10**6, 10**7)} {word()} in {word()} 2024 {word()}")
    rows.append("alpha mail me: jane(at)host99 beta")
    rows.append("nothing here, jane(at)host99 gamma")
    return rows


def test_a_reliable_context_finds_an_unseen_identifier(spark):
    rows = built()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string").repartition(4)
    patterns = learn(docs)
    assert patterns and all(set(k) == {0} for k in patterns.values())
    found = {r.doc_id: [(s.kind, rows[r.doc_id][s.start : s.end]) for s in r.spans] for r in marked(docs, patterns).collect()}
    assert found[120] == [(0, "jane(at)host99")]
    assert found[121] == [] and all(found[i] == [] for i in range(1, 120, 2))


def test_a_rare_reliable_context_counts_among_many_common_ones(spark):
    often = [" ".join(f"w{i} a{j}@x{i}.de w{i} b w{i} c" for j in range(4)) for i in range(4200)]
    rare = [f"call her: user{i}@mail{i}.de" for i in range(3)] + ["call her: jane(at)host99"]
    docs = spark.createDataFrame(list(enumerate(often + rare)), "doc_id int, text string").repartition(4)
    found = [(r.doc_id, s.kind, s.start, s.end) for r in personal_data(docs.where("doc_id >= 0")).where("doc_id >= 4200").collect() for s in r.spans]
    assert (4203, 0, 10, 24) in found and len(found) == 4


def test_new_identifiers_are_marked_everywhere_and_lead_to_others(spark):
    rows = built() + [f"c0: u{i}@m{i}.de" for i in range(15)]
    for stage in range(3):  # each context leads to three words, which support the next context
        rows += [f"c{stage}: p{stage}x{i}(at)h" for i in range(3)]
        rows += [f"c{stage + 1}: p{stage}x{i}(at)h" for i in range(3) for _ in range(5)]
    rows += ["some p2x1(at)h there"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string").repartition(4)
    got = personal_data(docs).collect()
    found = {r.doc_id: [(s.kind, rows[r.doc_id][s.start : s.end]) for s in r.spans] for r in got}
    assert found[120] == found[121] == [(0, "jane(at)host99")] and all(found[i] == [] for i in range(1, 120, 2))
    assert all(len(found[i]) == 1 for i in range(122, len(rows))) and found[len(rows) - 1] == [(0, "p2x1(at)h")]
    assert {r.doc_id: r.redacted for r in got}[121] == "nothing here, [EMAIL] gamma"


def test_messy_rows(spark):
    rows = [(1, None), (2, ""), (3, "x a@b.cd 1.2.3.4"), (3, "x a@b.cd 1.2.3.4"), (None, "é+1 202 555 0100é"), (5, "4" * 100_000), (6, "é" * 50_000 + " a@b.cd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kind": F.lit(1), "n_chars": F.char_length("text"), "value": F.lit("v")})
    got = personal_data(docs).collect()
    assert sorted((r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == sorted(tuple(personal(t)[0]) for _, t in rows)
    clean = redact(docs)
    assert clean.columns == docs.columns
    texts = [(r.doc_id, r.text, r.n_chars) for r in clean.where("doc_id is null or doc_id in (1, 3, 6)").collect()]
    assert sorted(texts, key=str) == sorted([(1, None, None), (3, "x [EMAIL] [IP]", 14), (3, "x [EMAIL] [IP]", 14), (None, "é[PHONE]é", 9), (6, "é" * 50_000 + " [EMAIL]", 50_008)], key=str)
    assert personal_data(docs.limit(0)).count() == 0 and redact(docs.limit(0)).count() == 0
