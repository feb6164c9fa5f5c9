"""Hard negatives of anchor vectors: exact scores by the method of the Four Russians.

For each group of eight dimensions an anchor has a table of 256 subset sums of its components. A candidate's components are split into bit planes; eight bits
of one plane are one byte, which looks up the sum of the anchor's components at its set bits. Planes are added up by shifts, highest (the sign) first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundlake.llm.grid import LEAST, MOST, cells, finite, integers, matrix, numbers, reach, to_long
from soundlake.llm.tables import positional
from soundlake.operators.lineage import cut

#: Anchors scored at once within a block.
AT_ONCE = 32


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(anchors, groups, 256): sum of a group's components at the bits of the index."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    padded = np.zeros((n, groups * 8), anchors.dtype)
    padded[:, :dim] = anchors
    padded = padded.reshape(n, groups, 8)
    sums = np.zeros((n, groups, 256), anchors.dtype)
    for bit in range(8):
        half = 1 << bit
        sums[:, :, half : 2 * half] = sums[:, :, :half] + padded[:, :, bit : bit + 1]
    return sums


def plane_bytes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, rows): bytes of the bit planes in two's complement, the sign's plane last."""
    n, dim = rows.shape
    groups = -(-dim // 8)
    planes = max(int(x).bit_length() for x in (rows.max(), ~rows.min(), 0)) + 1 if rows.size else 1
    out = np.zeros((planes, groups, n), np.intp)
    for p in range(planes):
        bits = ((rows >> p) & 1).astype(np.uint8)
        out[p] = np.packbits(bits, axis=1, bitorder="little").T
    return out


def scores(anchors: np.ndarray, sums: np.ndarray, planes: np.ndarray, kind: type) -> np.ndarray:
    """(anchors, rows): exact inner products, by look-ups, sums over groups and one shift a plane."""
    total = np.zeros((len(anchors), planes.shape[2]), kind)
    for p in reversed(range(len(planes))):
        total = total * 2 if kind is object else total << 1
        for g in range(planes.shape[1]):
            part = np.take(sums[:, g], planes[p, g], axis=1)
            total = total - part if p == len(planes) - 1 else total + part
    return total


def _runs(rows: pa.Table, anchors: pa.Table, pick=None):
    """Runs of anchors: (positions of anchors, positions of rows, scores); ``pick`` gives pairs of such positions that are to be scored."""
    a, c = matrix(anchors, "vec"), matrix(rows, "vec")
    most = reach(a, c)
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    planes = plane_bytes(c)
    whole = np.arange(len(c))
    for these, those in pick if pick is not None else [(np.arange(len(a)), whole)]:
        part = planes if len(those) == len(c) else planes[:, :, those]
        for at in range(0, len(these), AT_ONCE):
            run = these[at : at + AT_ONCE]
            yield run, those, to_long(scores(a[run], subset_sums(a[run].astype(kind)), part, kind))


def _positives(count: int):
    """The first ``count`` other rows of each anchor's label in a block."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            node, ids, label = (numbers(rows, n) for n in ("node", "vec_id", "class"))
            own, names, of = (numbers(anchors, n) for n in ("node", "vec_id", "class"))
            pick = [(np.flatnonzero(of == x), np.flatnonzero(label == x)) for x in np.intersect1d(of, label)]
            for run, those, s in _runs(rows, anchors, pick):
                for i, a in enumerate(run.tolist()):
                    at = np.flatnonzero(node[those] != own[a])
                    first = at[np.lexsort((ids[those][at], ~s[i, at]))[:count]]
                    found.append((np.full(len(first), own[a]), np.full(len(first), names[a]), ids[those][first], s[i, first]))
        columns = zip(*found, strict=True) if found else [[np.zeros(0, np.int64)]] * 4
        return pa.table([pa.array(np.concatenate(x)) for x in columns], names=["node", "anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(count: int, low: int, high: int):
    """The first ``count`` rows of other labels within the bounds of each positive in a block."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            ids, label = numbers(rows, "vec_id"), numbers(rows, "class")
            own, of, tops = numbers(anchors, "node"), numbers(anchors, "class"), anchors["tops"].to_pylist()
            for run, _, s in _runs(rows, anchors):
                for i, a in enumerate(run.tolist()):
                    # low * top <= 100 * score <= high * top in whole numbers
                    bounds = [(max(-(-low * t // 100), LEAST), min(high * t // 100, MOST)) for t in tops[a]]
                    bounds = [(k, lo, hi) for k, (lo, hi) in enumerate(bounds) if lo <= hi]
                    if not bounds:
                        continue
                    least, most = min(lo for _, lo, _ in bounds), max(hi for _, _, hi in bounds)
                    at = np.flatnonzero((s[i] >= least) & (s[i] <= most) & (label != of[a]))
                    at = at[np.lexsort((ids[at], ~s[i, at]))]
                    falling = ~s[i, at]  # ascending
                    for k, lo, hi in bounds:
                        first = at[np.searchsorted(falling, ~hi) :][:count]
                        first = first[s[i, first] >= lo]
                        found.append((np.full(len(first), own[a]), np.full(len(first), k), ids[first], s[i, first]))
        columns = zip(*found, strict=True) if found else [[np.zeros(0, np.int64)]] * 4
        return pa.table([pa.array(np.concatenate(x)) for x in columns], names=["node", "nth", "negative_id", "negative_score"])

    return run


def hard_negatives(vectors: DataFrame, anchor: Column, scale: int, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label; ``anchor`` says which rows are anchors. Components become floor(scale * x), a score is the integer inner
    product with the anchor; higher ones come first, equal ones by ascending vec_id. An anchor's positives are its first ``positives`` other rows of the same
    label; for each, the first ``negatives`` rows of other labels with low * positive <= 100 * negative <= high * positive are returned. Positives without
    such rows give none.

    Rows without vec_id or label, null vectors and vectors with null or non-finite components take no part. Vectors of unlike length are not compared. Rows
    that repeat a vec_id are different rows. Scores beyond 64 bits become the ends of a long. Empty tables give no rows; extra columns are not read.
    """
    table, names = positional(vectors)
    vec_id, vec, label = (F.col(names[c]) for c in ("vec_id", "embedding", "label"))
    marked = vectors.select(F.coalesce(anchor, F.lit(False)).alias("is_anchor"), "*").toDF("is_anchor", *table.columns)
    fine = marked.where(finite(vec) & vec_id.isNotNull() & label.isNotNull())
    fine = fine.select(F.monotonically_increasing_id().alias("node"), vec_id.alias("vec_id"), F.size(vec).alias("dim"), integers(vec, scale).alias("vec"),
                       label.cast("long").alias("class"), "is_anchor")
    rows = cut(fine, "vectors")
    anchors = rows.where("is_anchor").drop("is_anchor")
    columns = ["node", "vec_id", "vec", "class"]
    best = cells(rows, anchors, "dim", columns, columns).applyInArrow(_positives(positives), "node long, anchor_id long, positive_id long, positive_score long")
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("positive_score"), "positive_id"))
    best = cut(best.withColumn("nth", first - 1).where(F.col("nth") < positives), "positives")
    tops = best.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "positive_score"))), lambda x: x["positive_score"]).alias("tops"))
    found = cells(rows, anchors.join(tops, "node"), "dim", columns[1:], ["node", "vec", "class", "tops"])
    found = found.applyInArrow(_negatives(negatives, low, high), "node long, nth long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("node", "nth").orderBy(F.desc("negative_score"), "negative_id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return found.join(best.withColumn("nth", F.col("nth").cast("long")), ["node", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
