"""Exact duplicates: against SQL, on messy tables, and the directory of the index."""

import duckdb
import pytest
from pyspark.sql import functions as F

from soundlake.llm.exact import directory, drop_exact_duplicates, exact_duplicates
from soundlake.llm.queries.exact import ORACLE, QUERIES
from tests.llm.brute import sha

SF = "/root/testdata/sf0.001"


def test_query_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = sorted(map(tuple, QUERIES["op8_exact_dedup"](spark, SF).collect()))
    assert got == sorted(con.execute(ORACLE["op8_exact_dedup"]).fetchall())


ROWS = [
    (5, "a b", 1), (3, "a \t b", 2), (9, " a b", 3), (7, None, 4), (2, "", 5), (8, " ", 6), (4, "\n", 7), (3, "a b", 8), (None, "a b", 9), (None, "z", 10),
    (11, "x" * 300_000, 11), (10, "x" * 300_000, 12), (12, "a b", 13),
]


def test_messy_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, key int").withColumns({"body": F.lit(1), "keep_id": F.lit("c")})
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in exact_duplicates(docs).collect()}
    assert got[5, sha("a b")] == (3, 4, False)
    assert got[3, sha("a b")] == (3, 4, True)
    assert got[None, sha("a b")] == (3, 4, False)
    assert got[9, sha(" a b")] == (9, 1, True)
    assert got[7, sha("")] == (2, 2, False)
    assert got[8, sha(" ")] == (4, 2, False)
    assert got[None, sha("z")] == (None, 1, True)
    assert got[11, sha("x" * 300_000)] == (10, 2, False)
    assert got[12, sha("a b")] == (12, 1, True)


def test_kept_rows_keep_their_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, key int").withColumnsRenamed({"key": "_sha"})
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id or -1 for r in rows) == [-1, 2, 3, 4, 9, 10, 12]
    assert {r._sha for r in rows if r.doc_id == 3} <= {2, 8}
    assert {r._sha for r in rows if r.doc_id == 9} == {3}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates(docs).count() == 0
    assert drop_exact_duplicates(docs).count() == 0


@pytest.mark.parametrize("skewed", [False, True])
def test_buckets_split_only_where_overfull(spark, skewed):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    if skewed:
        keys = keys.unionByName(spark.range(3000).select((F.xxhash64("id") % 1000).alias("key")))
    slots = directory(keys, 100)
    bits = slots.first().bits
    dealt = keys.withColumn("slot", F.shiftrightunsigned("key", 64 - bits)).join(slots, "slot")
    sizes = dealt.groupBy("bucket", "depth").count().collect()
    assert sum(r["count"] for r in sizes) == keys.count()
    assert all(r["count"] <= 100 or r.depth == bits for r in sizes)
    assert not skewed or min(r.depth for r in sizes) < max(r.depth for r in sizes)
