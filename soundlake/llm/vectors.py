"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundlake.llm.graph import components
from soundlake.operators.lineage import cut

LEAST_COSINE = 0.93
#: Chance that a pair just at the threshold meets in some table; closer pairs meet more often.
RECALL = 0.99
#: Vectors of one label that a bucket holds on average; rows of one block of a crowded bucket.
BUCKET, BLOCK = 32, 1024
SEED = 20240607


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def plan(largest: int, cosine: float = LEAST_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): about ``BUCKET`` vectors of the largest label per bucket, and as many tables as the recall needs."""
    bits = min(60, max(4, math.ceil(math.log2(max(1, largest) / BUCKET + 1))))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def signatures(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """``nodes`` (node, label, vec, ...) with sigs: one ``bits``-bit number per table. Planes follow from a fixed seed and the dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {}
        for batch in batches:
            vec = batch.column("vec")
            sigs = np.zeros((batch.num_rows, tables), np.int64)
            size = np.diff(vec.offsets.to_numpy())
            for d in np.unique(size).tolist():
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED, d]).standard_normal((d, tables * bits))
                rows = np.flatnonzero(size == d)
                x = vec.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), d).astype(np.float64)
                signs = (x @ planes[d] >= 0).reshape(len(rows), tables, bits)
                sigs[rows] = signs @ (1 << np.arange(bits, dtype=np.int64))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(sigs.ravel()))], names=[*batch.schema.names, "sigs"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{kinds}, sigs array<long>")


def _block_links(x: np.ndarray, table: int, sigs: np.ndarray, weight: np.ndarray, side: np.ndarray | None, cosine: float):
    """Links of one block that no earlier table has: (row, linked weight, row of the tree's root)."""
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    near = (x @ x.T) / np.outer(norm, norm) >= cosine
    near[np.tril_indices(len(x))] = False
    if side is not None:
        near &= side[:, None] != side[None, :]
    a, b = np.nonzero(near)
    if table:
        new = np.ones(len(a), bool)
        for t in range(table):
            new &= sigs[a, t] != sigs[b, t]
        a, b = a[new], b[new]
    if not len(a):
        return None
    count = np.bincount(a, weight[b], len(x)) + np.bincount(b, weight[a], len(x))
    link = np.zeros((len(x), len(x)), bool)
    link[a, b] = link[b, a] = True
    root = np.full(len(x), -1)
    for start in np.unique(a).tolist():
        if root[start] < 0:
            front = np.zeros(len(x), bool)
            front[start] = True
            while front.any():
                root[front] = start
                front = link[front].any(0) & (root < 0)
    rows = np.flatnonzero(root >= 0)
    return rows, count[rows].astype(np.int64), root[rows]


def bucket_links(rows: DataFrame, cosine: float) -> DataFrame:
    """(node, n, root) for each node of a block: weight of its links there, and a node it is connected with.

    Rows (label, dim, tab, sig, i, j, node, weight, side, vec, sigs) come sorted by block; a block is at most twice ``BLOCK`` rows or about a bucket.
    """
    key = ["label", "dim", "tab", "sig", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            change = _changes(table, key)
            held = table.slice(change[-1])
            out = _all(table, change)
            if out is not None:
                yield out
        if held is not None and held.num_rows:
            out = _all(held, [*_changes(held, key), held.num_rows])
            if out is not None:
                yield out

    def _changes(table: pa.Table, names: list[str]) -> list[int]:
        differ = np.zeros(table.num_rows, bool)
        differ[:1] = True
        for n in names:
            v = table[n].to_numpy()
            differ[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(differ).tolist()

    def _all(table: pa.Table, change: list[int]) -> pa.RecordBatch | None:
        if len(change) < 2:
            return None
        node, weight, side, tab = (table[c].to_numpy() for c in ("node", "weight", "side", "tab"))
        i, j, dim = (table[c].to_numpy() for c in ("i", "j", "dim"))
        vec, sigs = table["vec"].combine_chunks(), table["sigs"].combine_chunks()
        at = vec.offsets.to_numpy()
        values, marks = vec.values.to_numpy(zero_copy_only=False), sigs.flatten().to_numpy().reshape(table.num_rows, -1)
        found = []
        for a, b in zip(change[:-1], change[1:], strict=True):
            if b - a > 1:
                x = values[at[a] : at[b]].reshape(b - a, dim[a]).astype(np.float64)
                got = _block_links(x, int(tab[a]), marks[a:b], weight[a:b], side[a:b] if i[a] != j[a] else None, cosine)
                if got is not None:
                    found.append((node[a:b][got[0]], got[1], node[a:b][got[2]]))
        if not found:
            return None
        return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["node", "n", "root"])

    columns = [*key, "node", "weight", "side", "vec", "sigs"]
    return rows.select(*columns).mapInArrow(run, "node long, n long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = LEAST_COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Equal vectors of a label are one node with a weight, so copies are never paired. Nodes meet in ``tables`` buckets; a bucket above ``BLOCK`` rows is cut into
    blocks that are compared two by two, so no group is held whole. A pair that meets several times counts in its first table only, which its signatures tell;
    counts and trees leave the blocks, never pairs. Every link's cosine is computed in double precision.

    Vectors that are null, zero, or hold null or non-finite components, and rows without label, link with nothing and are kept. Vectors of unlike
    length are not compared. Rows that repeat a vec_id are different rows that link as copies. Empty tables give no rows; extra columns are not read.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vec"), (usable(F.col("embedding")) & F.col("label").isNotNull()).alias("ok"))
    classes = rows.where("ok").groupBy("label", "vec").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"))
    nodes = cut(classes.select("label", F.size("vec").alias("dim"), "vec", "first", "weight", F.monotonically_increasing_id().alias("node")), "nodes")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, cosine, recall)
    signed = cut(signatures(nodes.select("node", "label", "dim", "weight", "vec"), bits, tables), "signed")
    spread = signed.select("*", F.posexplode("sigs").alias("tab", "sig"))
    bucket = ["label", "dim", "tab", "sig"]
    sizes = signed.select("label", "dim", F.posexplode("sigs").alias("tab", "sig")).groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    cells = F.ceil(F.col("size") / BLOCK).cast("int")
    met = spread.join(sizes, bucket).withColumn("cells", cells).withColumn("side", F.pmod(F.xxhash64("node"), "cells").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    met = met.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})
    keys = [*bucket, "i", "j"]
    links = cut(bucket_links(met.repartition(*keys).sortWithinPartitions(*keys, "node"), cosine), "links")
    roots = components(links.select("node", "root"))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    named = nodes.select("node", "first", "weight").join(roots, "node", "left").join(counts, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = cut(named.join(least, "root").select("node", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"), "of")
    of = nodes.select("node", F.col("label").alias("_label"), F.col("vec").alias("_vec")).join(of, "node").drop("node")
    found = rows.where("ok").join(of, (F.col("label") == F.col("_label")) & (F.col("vec") == F.col("_vec"))).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
