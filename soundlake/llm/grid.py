"""A stated set of queries against all rows, block by block.

Rows are dealt into slices and queries into blocks by a hash of their number; every slice meets every block of its group in one cell. A cell holds about
``ROWS`` rows and ``QUERIES`` queries whatever the table's size, and a lost one is made again from the stored tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from soundlake.operators.lineage import cut

ROWS, QUERIES = 8192, 512
LEAST, MOST = -(2**63), 2**63 - 1


def finite(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as array<long>, in double precision; beyond a long its ends."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def cells(rows: DataFrame, queries: DataFrame, by: str, row_columns: list[str], query_columns: list[str], a_slice: int = ROWS) -> PandasCogroupedOps:
    """Slices of ``rows`` cogrouped with blocks of ``queries`` (both with node and ``by``), for applyInArrow; a cell's two tables have the named columns.

    Only rows and queries with equal ``by`` meet; rows of one node share a slice. Each row is copied once per block of queries, each query once per slice.
    """
    some = queries.groupBy(by).agg(F.count(F.lit(1)).alias("_q"))
    sizes = cut(rows.groupBy(by).agg(F.count(F.lit(1)).alias("_r")).join(some, by), "sizes")
    sizes = sizes.select(by, F.ceil(F.col("_r") / a_slice).cast("int").alias("_slices"), F.ceil(F.col("_q") / QUERIES).cast("int").alias("_blocks"))
    dealt = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = rows.join(sizes, by).withColumn("_slice", dealt("_slices")).withColumn("_block", every("_blocks"))
    right = queries.join(sizes, by).withColumn("_block", dealt("_blocks")).withColumn("_slice", every("_slices"))
    key = [by, "_slice", "_block"]
    fresh = lambda df, columns: df.select(*key, *columns).toDF(*key, *columns)  # noqa: E731  both may come from one table
    return fresh(left, row_columns).groupBy(*key).cogroup(fresh(right, query_columns).groupBy(*key))


def numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column without nulls."""
    return table[name].combine_chunks().to_numpy(zero_copy_only=False)


def matrix(table: pa.Table, name: str) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    lists = table[name].combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), len(flat) // max(1, len(lists)))


def reach(a: np.ndarray, b: np.ndarray) -> int:
    """A bound of every inner product of a row of ``a`` with one of ``b`` and of all its partial sums."""
    largest = lambda x: max(abs(int(x.max())), abs(int(x.min()))) + 1 if x.size else 0
    return a.shape[1] * largest(a) * largest(b)


def to_long(x: np.ndarray) -> np.ndarray:
    """As int64; Python integers beyond it become its ends."""
    return np.clip(x, LEAST, MOST).astype(np.int64) if x.dtype == object else x.astype(np.int64)
