"""Web archives: the round trip, the records, and transactions."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from soundlake.llm.queries.warc import QUERIES
from soundlake.llm.warc import archive_round_trip, assemble, read_archives, sha1_base32, transactions, write_archives

SF = "/root/testdata/sf0.001"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def want(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) by plain grouping."""
    data = [(k, (h or "").encode()) for k, h in rows]
    out = []
    for k, p in data:
        ids = [i for i, q in data if q == p and i is not None]
        again = bool(ids) and k != max(ids) and len(p) >= least
        out.append((k, len(p), digest(p), "revisit" if again else "response", max(ids) if again else None))
    return sorted(out, key=str)


def test_query_against_plain_grouping(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op10_warc"](spark, SF).collect()), key=str) == want(rows)


ROWS = [(1, "http://a.b/x\r\nEvil: 1", "one"), (2, None, "one"), (3, "u", None), (4, "u", ""), (5, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb"), (6, "u", "é\u0000" * 100_000), (5, "v", "other"),
        (7, "u", "twice"), (7, "u", "twice"), (None, "u", "one"), (None, "u", "lone"), (8, "u", "\r\n"), (9, "ü", "ü")]


@pytest.mark.parametrize("least", [0, 4])
def test_messy_rows(spark, tmp_path, least):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "last": F.lit("x"), "record_id": F.lit(2)})
    got = archive_round_trip(pages.repartition(3), str(tmp_path / "w"), least)
    rows = got.select("page_id", "response.payload_bytes", "response.payload_digest", F.col("response.warc_type"), "refers_to").collect()
    assert sorted(map(tuple, rows), key=str) == want([(k, h) for k, _, h in ROWS], least)
    assert got.where("response.digest_matches is null or not response.digest_matches").where("response.warc_type = 'response'").count() == 0
    assert got.where("request is null or metadata is null").count() == 0
    assert archive_round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_payloads_come_back_whole(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[:6], "page_id long, url string, html string")
    write_archives(transactions(pages), str(tmp_path / "w"), per_file=4)
    files = list((tmp_path / "w").glob("*.gz"))
    assert {gzip.open(f).read(8) for f in files} - {b""} == {b"WARC/1.1"}
    found = assemble(read_archives(spark, str(tmp_path / "w")))
    back = {r.metadata.body.split()[1]: bytes(r.response.payload) for r in found.collect() if r.response.warc_type == "response"}
    assert back == {str(k): (h or "").encode() for k, _, h in ROWS[1:6] if k != 3}


def test_foreign_archives(spark, tmp_path):
    """Records of others: in any order, without request, with binary payload; plain and compressed."""
    payload = bytes(range(256)) * 3
    block = b"HTTP/1.0 200 OK\r\n\r\n" + payload
    answer = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nContent-Length: 3\r\n\r\nx\n\n\r\n\r\n"
    note = b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <m>\r\nWARC-Concurrent-To: <a>\r\nContent-Length: 4\r\n\r\nk: v\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(note + info)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(answer))
    (row,) = assemble(read_archives(spark, str(tmp_path))).collect()
    assert bytes(row.response.payload) == payload and row.response.payload_digest == digest(payload) and row.response.digest_matches is None
    assert row.request is None and row.metadata.body == "k: v"


def test_base32(spark):
    rows = spark.createDataFrame([(s,) for s in ("", "a", "é", "x" * 1000)], "s string").select("s", sha1_base32(F.col("s").cast("binary")).alias("d")).collect()
    assert all(r.d == digest(r.s.encode()) for r in rows)
