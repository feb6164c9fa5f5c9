"""Connected components of an edge table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundlake.operators.lineage import cut, release


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns), root being the smallest node reachable.

    Large stars and small stars by turns: every node ties its larger neighbours, then its smaller ones, to the smallest it knows, until all
    edges lead to roots. Rounds grow with the logarithm of the size; each writes its edges to the shared folder. Minima are taken map-side, and a node with very
    many edges is only a hot join key, which the planner splits. Loops, null ends and repeated edges are ignored.
    """
    a, b = (F.col(c) for c in edges.columns)
    e = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = cut(e, "edges")
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("lo")).select("v", F.least("v", "lo").alias("lo"))
        large = e.join(low, "v").select("u", F.col("lo").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("lo"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("lo").alias("v")), F.struct(F.col("v").alias("u"), F.col("lo").alias("v")))).alias("e"))
        new = cut(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        release(e)
        e, before, state = new, state, _state(new)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    """Changes whenever the set of edges does."""
    mark = F.xxhash64("u", "v")
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(F.shiftright(mark, 20))).first())
