"""N-gram Jaccard join: a sparse product of documents by n-grams, restricted to the columns that can decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundlake.llm.graph import components
from soundlake.llm.tables import positional, restored
from soundlake.llm.words import mix, parts, shingle_sets
from soundlake.operators.lineage import cut, release

#: A column with more documents than this counts as crowded.
CROWDED = 8


class Threshold:
    """Jaccard similarity of at least num / den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, size: int) -> int:
        """Least overlap of a set of this size with any partner."""
        return -(-self.num * size // self.den)

    def slack(self, size: int) -> int:
        """Columns beyond the shortest sound prefix: half as many again."""
        return -(-(self.den - self.num) * size // (2 * self.den))

    def prefix(self, size: int) -> int:
        """How many of a set's smallest hashes go into the product.

        Two sets that link share all but a few of their elements, so of these prefixes they share one element, and one more for
        each element of slack that both have.
        """
        return min(size, size - self.overlap(size) + 1 + self.slack(size))

    def spare(self, size: int) -> int:
        """How many of its columns a set may leave out and still share one with every partner: the slack of the smallest
        partner, but never all of the shared elements."""
        least = self.overlap(size)
        return max(0, min(self.slack(least), least - 1))


def sketches(docs: DataFrame, width: int, limit: Threshold, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (distinct shingles), s1 and s2 (signature of the whole set), spare, prefix (smallest hashes, ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, 1):
            n, s1, s2, spare, ends, prefix = [], [], [], [], [0], []
            with np.errstate(over="ignore"):
                for u in shingle_sets(part.column(1), width):
                    size = len(u)
                    n.append(size), spare.append(limit.spare(size))
                    s1.append(mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)), s2.append(np.bitwise_xor.reduce(mix(u)) if size else np.uint64(0))
                    prefix.append(u[: limit.prefix(size)] >> np.uint64(1))
                    ends.append(ends[-1] + len(prefix[-1]))
            flat = np.concatenate(prefix).view(np.int64) if prefix else np.zeros(0, np.int64)
            signs = [pa.array(np.array(s, np.uint64).view(np.int64)) for s in (s1, s2)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), *signs, pa.array(spare, pa.int64()), lists], names=["doc_id", "n", "s1", "s2", "spare", "prefix"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, spare long, prefix array<long>")


def whole_sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id and items: all distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, 1):
            sets = list(shingle_sets(part.column(1), width))
            ends = pa.array(np.concatenate([[0], np.cumsum([len(u) for u in sets])]).astype(np.int32))
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(ends, pa.array(flat))], names=["doc_id", "items"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, items array<long>")


def _bound(overlap, n_a, n_b, limit: Threshold):
    """Whether an overlap of at most ``overlap`` can link sets of these sizes; in whole numbers."""
    return overlap * (limit.num + limit.den) >= limit.num * (n_a + n_b)


def _fits(x, y, limit: Threshold):
    return (x * limit.den >= y * limit.num) & (y * limit.den >= x * limit.num)


def light_pairs(cells: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs (a, b) that the product over uncrowded columns leaves, from cells (col, rep, n, left, heavy).

    Their overlaps are added up over these columns. Crowded columns can add at most the fewer of both sides' crowded cells, and columns beyond the prefixes at
    most what is left of a set; pairs that cannot reach the overlap which their sizes ask for are discarded.
    """
    x, y = cells.alias("x"), cells.alias("y")
    met = x.join(y, (F.col("x.col") == F.col("y.col")) & (F.col("x.rep") < F.col("y.rep")) & _fits(F.col("x.n"), F.col("y.n"), limit))
    sums = met.groupBy(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).agg(
        F.count(F.lit(1)).alias("met"), *[F.first(f"{s}.{c}").alias(f"{c}_{s}") for s in "xy" for c in ("n", "left", "heavy")]
    )
    most = F.col("met") + F.least("heavy_x", "heavy_y") + F.greatest("left_x", "left_y")
    return sums.where(_bound(most, F.col("n_x"), F.col("n_y"), limit)).select("a", "b")


def rare_first(sets: DataFrame, limit: Threshold) -> DataFrame:
    """Cells (col, rep, n, pos) of the shortest sound prefixes when columns are ordered by how many of these sets have them, the rarest first."""
    cells = sets.select("rep", F.size("items").alias("n"), F.explode("items").alias("col"))
    often = cut(cells.groupBy("col").agg(F.count(F.lit(1)).alias("k")), "often")
    order = Window.partitionBy("rep").orderBy("k", "col")  # one set
    placed = cells.join(often, "col").withColumn("pos", F.row_number().over(order) - 1)
    reach = F.col("n") - F.ceil(F.col("n") * limit.num / limit.den - 1e-9)
    return placed.where((F.col("pos") <= reach) & (F.col("k") > 1)).select("col", "rep", "n", "pos")


def verified(pairs: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("items").alias("y")), "b")
    both = both.select("a", "b", (F.size("x") + F.size("y")).alias("sizes"), F.size(F.array_intersect("x", "y")).alias("common"))
    return cut(both.where(limit.den * F.col("common") >= limit.num * (F.col("sizes") - F.col("common"))).select("a", "b").distinct(), "links")


def similar_documents(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the classes of documents linked by a Jaccard similarity of at least num / den.

    1. Equal sets are one class, named by its smallest doc_id, so copies are never paired.
    2. The incidence matrix keeps, of each class, the columns (shingles) with the smallest hashes, a sixth to a third of all. Columns with one class fall away.
    3. Uncrowded columns are multiplied: overlaps of the pairs are accumulated, and pairs below their size-derived bounds discarded.
    4. Crowded columns, such as those of a passage that many documents share, can be spared by most classes: even without them they share a column with every
       partner. Classes that cannot spare them, such as those of large groups of near copies, get a matrix of their own, with all their columns ordered
       by rarity; a class that differs much from its group then has rare columns only. There each class first meets the most central one of a column; links found
       join classes to components, and only classes of different components meet afterwards, if their places in the order leave enough overlap. So a
       group of near copies costs about its size, not its square, and no link between components is missed.
    5. What is left is verified on the whole sets, built from the texts for these documents only.

    Texts that are null or without words have no shingles and link with nothing. doc_id is taken to be unique: rows that repeat it with equal texts
    are copies; rows that repeat it with unlike texts follow their own text's class, but of the links between such classes and others some may be missed. A null id joins the component of its text's class. Empty tables give no rows; extra
    columns are not read.
    """
    limit = Threshold(num, den)
    rows = cut(sketches(docs, width, limit, id_col, text_col), "sketches")
    signature = ["s1", "s2", "n"]
    classes = cut(rows.where("n > 0").groupBy(*signature).agg(F.min("doc_id").alias("rep")), "classes")
    named = classes.where("rep is not null").select("rep", F.col("s1").alias("_s1"), F.col("s2").alias("_s2"))
    heads = rows.where("n > 0").join(named, (F.col("doc_id") == F.col("rep")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")), "left_semi")
    heads = heads.select(F.col("doc_id").alias("rep"), "n", "spare", "prefix")
    cells = heads.select("rep", F.col("n").cast("int").alias("n"), F.col("spare").cast("int").alias("spare"), (F.col("n") - F.size("prefix")).cast("int").alias("left"), F.explode("prefix").alias("h"))
    cells = cut(cells.withColumn("col", F.col("h").bitwiseAND(0x7FFFFFFF).cast("int")).drop("h"), "cells")
    columns = cells.groupBy("col").agg(F.count(F.lit(1)).alias("k"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    columns = cut(columns.select("col", (F.col("k") > crowded).alias("full")), "columns")
    shared = cut(cells.join(columns, "col"), "shared")
    release(cells, columns)
    heavy = cut(shared.where("full").groupBy("rep").agg(F.count(F.lit(1)).cast("int").alias("heavy"), F.max("spare").alias("spare")), "heavy")
    held = cut(heavy.where("heavy > spare").select("rep").distinct(), "held")
    light = shared.where("not full").select("col", "rep", "n", "left").join(heavy.select("rep", "heavy"), "rep", "left").fillna(0, ["heavy"])
    pairs = cut(light_pairs(light, limit), "pairs")
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("_w")).unionByName(held.select(F.col("rep").alias("_w"))).distinct(), "wanted")
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(wanted, F.col("doc_id") == F.col("_w"), "left_semi")
    sets = cut(whole_sets(chosen, width, "doc_id", "text").withColumnRenamed("doc_id", "rep"), "sets")
    release(shared, heavy, wanted)
    near = verified(pairs, sets, limit)
    matrix = cut(rare_first(sets.join(held, "rep", "left_semi"), limit), "matrix")
    degree = cut(matrix.groupBy("rep").agg(F.count(F.lit(1)).alias("degree")), "degree")
    centre = matrix.join(degree, "rep").groupBy("col").agg(F.max(F.struct("degree", (-F.col("rep")).alias("minus"), "n")).alias("c"))
    centre = cut(centre.select("col", (-F.col("c.minus")).alias("hub"), F.col("c.n").alias("hub_n")), "centre")
    first = matrix.join(centre, "col").where((F.col("rep") != F.col("hub")) & _fits(F.col("n"), F.col("hub_n"), limit))
    first = cut(first.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct(), "pairs")
    near = cut(near.unionByName(verified(first, sets, limit)), "links")
    joined = cut(components(near), "joined")
    placed = matrix.join(joined, F.col("rep") == F.col("node"), "left").select("rep", "n", "col", "pos", F.coalesce("root", "rep").alias("part"))
    placed = cut(placed, "placed")
    open_columns = placed.groupBy("col").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("col")
    open_columns = cut(open_columns, "columns")
    x, y = (cut(placed.join(open_columns, "col", "left_semi"), "open").alias(s) for s in "xy")
    apart = (F.col("x.col") == F.col("y.col")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.part") != F.col("y.part")) & _fits(F.col("x.n"), F.col("y.n"), limit)
    reach = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    rest = x.join(y, apart & _bound(reach, F.col("x.n"), F.col("y.n"), limit))
    rest = rest.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    more = verified(cut(rest, "pairs"), sets, limit)
    release(matrix, placed, sets)
    final = cut(components(near.unionByName(more)), "components")
    roots = classes.join(final, F.col("rep") == F.col("node"), "left").select(*signature, F.coalesce("root", "rep").alias("root"))
    mine = rows.select("doc_id", *signature).join(cut(roots, "roots"), signature, "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    return mine.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(alone, F.col("root")).alias("component_id"))


def drop_similar(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest doc_id; documents without words all stay. Columns stay as they are."""
    rows, names = positional(docs)
    found = similar_documents(rows, width, num, den, names["doc_id"], names["text"])
    gone = cut(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")), "gone")
    return restored(rows.join(gone, F.col(names["doc_id"]) == F.col("_gone"), "left_anti"), names)
