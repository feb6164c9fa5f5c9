"""Ranked lexical search: accumulator-limited, term at a time.

Documents are read into postings of the items' terms; counts over all documents give the weights. Slices of documents are searched one by one for blocks of
items: an item's terms go rarest first, and each adds what it scores to the accumulators of its documents. Once what is left to come cannot lift a new document
to the k-th partial score, no accumulator is created any more; those that can still get there are updated exactly with the remaining terms. The k best of each
slice meet in a last ranking.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundlake.llm.grid import MOST, cells, numbers
from soundlake.llm.tables import positional
from soundlake.llm.words import parts
from soundlake.operators.lineage import cut, release

#: 0-9, a-z and all bytes of other letters stay, A-Z become small, all else a space.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Saturation of a term's count: halves at twice (LIFT) the mean length; half (SHARE of 100) of the length counts.
LIFT, SHARE, UNIT = 20, 50, 1_000_000_000
#: Postings of one slice, about.
SLICE = 1 << 20


def terms(texts: DataFrame) -> DataFrame:
    """(key..., text) as (key..., n, terms, tfs): all terms with repeats counted, the different ones and how often each stands. Null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, batch_text):
            seen, many, size, n = [], [], [0], []
            for text in batch.column(batch_text).cast(pa.large_binary()).fill_null(b""):
                words = text.as_py().translate(_TERMS).split()
                count = Counter(words)
                seen.extend(count)
                many.extend(count.values())
                size.append(len(seen))
                n.append(len(words))
            offsets = pa.array(size, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((seen, pa.string()), (many, pa.int64()))]
            yield pa.record_batch([*batch.columns[:-1], pa.array(n, pa.int64()), *lists], names=[*batch.schema.names[:-1], "n", "terms", "tfs"])

    batch_text = len(texts.columns) - 1
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    return texts.mapInArrow(run, f"{kinds}, n long, terms array<string>, tfs array<long>")


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, accumulators created) of one item: exact scores of a set that holds its ``k`` best documents with scores above 0.

    ``lists`` has for each term, rarest first, its documents and what it adds to them.
    """
    best = np.array([int(score.max()) if len(score) else 0 for _, score in lists], np.int64)
    left = np.append(np.cumsum(best[::-1])[::-1], 0)
    held = np.zeros(documents, np.int64)
    survivors, top = None, 0
    for i, (at, score) in enumerate(lists):
        if survivors is not None:
            live = survivors[at]
            at, score = at[live], score[live]
        held[at] += score
        if survivors is None and documents > k:
            top = max(top, int(held[at].max()) if len(at) else 0)
            if left[i + 1] < top:  # else it is below no k-th score either
                kth = int(np.partition(held, documents - k)[documents - k])
                if left[i + 1] < kth:
                    survivors, created = held + left[i + 1] >= kth, int(np.count_nonzero(held))
    if survivors is None:
        found = np.flatnonzero(held)
        return found, held[found], len(found)
    found = np.flatnonzero(survivors & (held > 0))
    return found, held[found], created


def _search(k: int):
    """The ``k`` best documents of a slice for each item of a block."""

    def run(postings: pa.Table, items: pa.Table) -> pa.Table:
        found = []
        if postings.num_rows and items.num_rows:
            term = numbers(postings, "term")
            order = np.argsort(term, kind="stable")
            term, score, node = term[order], numbers(postings, "score")[order].astype(np.int64), numbers(postings, "node")[order]
            node, first, doc = np.unique(node, return_index=True, return_inverse=True)
            ids = postings["doc_id"].combine_chunks().take(pa.array(order[first]))
            sort_ids = ids.fill_null(MOST).to_numpy()
            has, start = np.unique(term, return_index=True)
            end = np.append(start[1:], len(term))
            at = {t: (a, b) for t, a, b in zip(has.tolist(), start.tolist(), end.tolist(), strict=True)}
            for item, wanted, weights in zip(items["item"].to_pylist(), items["terms"].to_pylist(), items["weights"].to_pylist(), strict=True):
                lists = [(doc[a:b], w * score[a:b]) for (a, b), w in ((at[t], w) for t, w in zip(wanted, weights, strict=True) if t in at)]
                docs, total, _ = accumulate(lists, len(node), k)
                best = np.lexsort((sort_ids[docs], -total))[:k]
                found.append((np.full(len(best), item), docs[best], total[best]))
        if not found:
            return pa.table([pa.array([], pa.int64())] * 3, names=["item", "doc_id", "score"])
        item, docs, total = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table([pa.array(item, pa.int64()), ids.take(pa.array(docs)), pa.array(total, pa.int64())], names=["item", "doc_id", "score"])

    return run


def ranked_search(documents: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of each item with scores above 0 (all, if fewer).

    Terms are runs of ASCII digits, ASCII letters and any characters beyond ASCII; only A-Z are lower-cased. N counts the documents with a term, L all their
    terms, n one document's, df the documents with a term, tf its occurrences in one. A term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))); a document's m
    is 50 + (50 * n * N) div L; its score sums w * ((10^9 * tf) div (1000 * tf + 20 * m)) over the item's different terms. Equal scores go by ascending doc_id.

    ``documents`` has doc_id and text, ``items`` item_id and text. Null and empty texts have no terms: such documents count for nothing, such items get no
    rows. Rows that repeat an id are different documents or items; a null doc_id comes last among equals. Texts are read whole whatever their length. Empty
    tables give no rows; extra columns are not read.
    """
    read = lambda df, key: (lambda t: terms(t[0].select(F.col(t[1][key]).alias("id"), F.col(t[1]["text"]).alias("text"))))(positional(df))
    node = F.monotonically_increasing_id()
    docs = cut(read(documents, "doc_id").withColumn("node", node), "terms")
    asked = cut(read(items, "item_id").withColumn("node", node), "items")
    count, length = docs.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    words = cut(asked.select(F.explode("terms").alias("word")).distinct().withColumn("term", node), "vocabulary")
    held = docs.select("node", F.col("id").alias("doc_id"), "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    held = held.select("node", "doc_id", "n", F.col("x.terms").alias("word"), F.col("x.tfs").alias("tf")).join(words, "word")
    m = F.expr(f"{100 - SHARE}L + ({SHARE}L * n * {count}L) div {max(1, length or 0)}L")
    held = held.withColumn("m", m).select("node", "doc_id", "term", F.expr(f"({UNIT}L * tf) div (1000L * tf + {LIFT}L * m)").cast("int").alias("score"))
    postings = cut(held, "postings")
    release(docs)
    seen = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(count) + 2) / (2.0 * F.col("df") + 1)))
    weights = words.join(seen, "term").select("word", "term", "df", weight.alias("w")).where("w > 0")
    wanted = asked.select("node", "id", F.explode("terms").alias("word")).join(weights, "word")
    rare_first = F.sort_array(F.collect_list(F.struct("df", "term", "w")))
    wanted = wanted.groupBy("node", "id").agg(rare_first.alias("x"))
    one = F.lit(0).alias("of")
    wanted = cut(wanted.select("node", "id", F.col("node").alias("item"), F.col("x.term").alias("terms"), F.col("x.w").alias("weights"), one), "wanted")
    met = cells(postings.withColumn("of", one), wanted, "of", ["node", "doc_id", "term", "score"], ["item", "terms", "weights"], SLICE)
    found = met.applyInArrow(_search(k), "item long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.join(wanted.select("item", F.col("id").alias("item_id")), "item").select("item_id", "rank", "doc_id", "score")
