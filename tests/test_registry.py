"""Every query that has SQL agrees with it on the smallest tables; the others give rows."""

import compare
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ALL = sorted(entry.queries())
# Every whole job and every loop, and a sample across modules; tools/compare.py runs all of them. Corpus queries have tests of their own.
OWN = [n for n in ALL if not n.startswith("op") and n != "pipeline"]
FAST = [n for i, n in enumerate(OWN) if i % 5 == 0 or n.startswith(("job_", "m1_kmeans", "m2_", "t2_", "p2_", "p3_", "p4_"))]


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_agrees(spark, con, name):
    ok, msg = compare.compare(spark, con, name, SF)
    assert ok, msg


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(ALL)


def test_flagship_schema(spark):
    df = entry.entry(spark)
    assert "vmedian" in df.columns and df.count() == 1
