"""Exact top-k search by inner product: distributed histogram selection.

Everything is scored, block by block; only counts of scores leave a block. Global histograms of the scores, one per query, locate the interval that holds the
k-th score; a finer histogram of that interval follows, until an interval is one score. Then the rows from that score on are kept, ties by vec_id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundlake.llm.grid import LEAST, cells, finite, integers, matrix, numbers, reach, to_long
from soundlake.llm.tables import positional
from soundlake.operators.lineage import cut, release

#: Intervals of one histogram; queries scored at once within a block.
BINS, AT_ONCE = 1024, 64


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in single or double precision where that holds every sum, else with Python integers."""
    most = reach(q, c)
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else object
    return to_long(q.astype(kind) @ c.astype(kind).T)


def _scored(rows: pa.Table, queries: pa.Table):
    """Per run of queries: their positions, scores, and which scores are not a query's own."""
    c, node = matrix(rows, "vec"), numbers(rows, "node")
    q, own = matrix(queries, "vec"), numbers(queries, "node")
    for at in range(0, len(own), AT_ONCE):
        run = slice(at, at + AT_ONCE)
        yield run, scores(q[run], c), node[None, :] != own[run, None]


def _histogram(width: int):
    """Counts per query and interval; a block leaves out intervals below which it has enough by itself, since the k-th score is not there."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and queries.num_rows:
            node, low, need = (numbers(queries, n) for n in ("node", "low", "need"))
            for run, s, other in _scored(rows, queries):
                with np.errstate(over="ignore"):
                    bins = (s - low[run, None]).view(np.uint64) // np.uint64(width)
                inside = other & (s >= low[run, None]) & (bins < BINS)
                q, _ = np.nonzero(inside)
                count = np.bincount(q * BINS + bins[inside].astype(np.int64), minlength=len(s) * BINS).reshape(len(s), BINS)
                above = np.cumsum(count[:, ::-1], axis=1)[:, ::-1] - count
                at, b = np.nonzero((count > 0) & (above < need[run, None]))
                found.append((node[run][at], b.astype(np.int32), count[at, b]))
        columns = zip(*found, strict=True) if found else [[np.zeros(0, t)] for t in (np.int64, np.int32, np.int64)]
        return pa.table([pa.array(np.concatenate(x)) for x in columns], names=["node", "bin", "n"])

    return run


def _kept(rows: pa.Table, queries: pa.Table) -> pa.Table:
    """Rows above the k-th score, and of those that tie with it as many as are needed, smallest vec_id first."""
    found = []
    if rows.num_rows and queries.num_rows:
        ids, names = numbers(rows, "vec_id"), [numbers(queries, n) for n in ("node", "vec_id")]
        low, need = numbers(queries, "low"), numbers(queries, "need")
        for run, s, other in _scored(rows, queries):
            take = other & (s > low[run, None])
            tie = other & (s == low[run, None])
            for i in np.flatnonzero(tie.any(axis=1)).tolist():
                at = np.flatnonzero(tie[i])
                take[i, at[np.argsort(ids[at], kind="stable")[: need[run][i]]]] = True
            q, c = np.nonzero(take)
            found.append((names[0][run][q], names[1][run][q], ids[c], s[q, c]))
    columns = zip(*found, strict=True) if found else [[np.zeros(0, np.int64)]] * 4
    return pa.table([pa.array(np.concatenate(x)) for x in columns], names=["node", "query_id", "vec_id", "score"])


def _narrowed(queries: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """``queries`` with low at the interval that holds the k-th score and need what is still to be found from there."""
    down = Window.partitionBy("node").orderBy(F.desc("bin"))
    total = counts.groupBy("node", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down))
    at = total.join(queries.select("node", "need"), "node").where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
    at = at.select("node", "bin", (F.col("need") - F.col("upto") + F.col("n")).alias("rest"))
    joined = queries.join(at, "node", "left")
    start = F.expr(f"CAST(CAST(low AS DECIMAL(20, 0)) + CAST(bin AS DECIMAL(6, 0)) * {width}BD AS BIGINT)")
    low = F.when(F.col("bin").isNull(), F.lit(LEAST)).otherwise(start)
    return joined.select("node", "dim", "vec_id", "vec", low.alias("low"), F.coalesce("rest", "need").alias("need"))


def top_k(vectors: DataFrame, query: Column, k: int, scale: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest integer inner products of each query row with all other rows (all, if fewer).

    ``vectors`` has vec_id and embedding, ``query`` says which rows are queries. Components become floor(scale * x). Equal scores go by ascending vec_id.
    The number of passes over the scores is the logarithm of their range to base ``BINS``, and one to keep rows.

    Null vectors, vectors with null or non-finite components and rows without vec_id take no part. Vectors of unlike length are not compared; those without
    components score 0 with each other. Rows that repeat a vec_id are different rows: each is a query, and a candidate for the others. Scores beyond 64 bits
    become the ends of a long. Empty tables give no rows; extra columns are not read.
    """
    table, names = positional(vectors)
    vec_id, vec = F.col(names["vec_id"]), F.col(names["embedding"])
    marked = vectors.select(F.coalesce(query, F.lit(False)).alias("is_query"), "*").toDF("is_query", *table.columns)
    fine = marked.where(finite(vec) & vec_id.isNotNull())
    fine = fine.select(F.monotonically_increasing_id().alias("node"), vec_id.alias("vec_id"), F.size(vec).alias("dim"), integers(vec, scale).alias("vec"), "is_query")
    rows = cut(fine, "vectors")
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    most = min(math.ceil((rows.agg(F.max(norm)).first()[0] or 0.0) * (1 + 1e-9)) + 1, 2**63)
    passes = 1
    while BINS**passes < 2 * most + 1:
        passes += 1
    state = rows.where("is_query").select("node", "dim", "vec_id", "vec", F.lit(max(-most, LEAST)).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    old = None
    for p in reversed(range(passes)):
        met = cells(rows, state, "dim", ["node", "vec"], ["node", "vec", "low", "need"])
        counts = met.applyInArrow(_histogram(BINS**p), "node long, bin int, n long")
        state = cut(_narrowed(state, counts, BINS**p), "kth")
        if old is not None:
            release(old)
        old = state
    kept = cells(rows, state, "dim", ["node", "vec_id", "vec"], ["node", "vec_id", "vec", "low", "need"]).applyInArrow(_kept, "node long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "vec_id"))
    return kept.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
