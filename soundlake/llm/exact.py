"""Exact duplicates through an extendible-hash index on shared files; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundlake.llm.tables import positional, restored
from soundlake.operators.lineage import cut, release

#: Distinct texts that one bucket of the index holds before it splits.
BUCKET_KEYS = 4096
#: Runs of white space other than one single space: only these have to be rewritten.
_RUNS = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def directory(keys: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """Directory of an extendible-hash index over ``keys(key long)``: one row per used slot with its bucket.

    The directory doubles (one more leading bit of the key) as long as some bucket holds more than ``capacity`` keys;
    a bucket splits only where it is overfull, so several slots may share one bucket. Columns: slot, depth (local depth),
    bucket (first slot of the bucket, so buckets are key ranges), bits (global depth).

    Only counts per slot are handled. Their number is about eight per bucket, and they are never collected. Equal keys cannot be
    parted by splitting: after three doublings beyond an even spread the rest is chained inside the bucket.
    """
    bits = max(1, math.ceil(math.log2(max(1, keys.count()) / capacity + 1)) + 3)
    slot = F.shiftrightunsigned("key", 64 - bits)
    used = keys.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    levels = used.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(bits))))
    first = F.expr(f"shiftleft(shiftrightunsigned(slot, {bits} - depth), {bits} - depth)")
    fits = (
        levels.groupBy("depth", first.alias("bucket"))
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") <= capacity) | (F.col("depth") == bits))
        .select("depth", "bucket")
    )
    leaf = levels.select("slot", "depth", first.alias("bucket")).join(fits, ["depth", "bucket"])
    return leaf.groupBy("slot").agg(F.min(F.struct("depth", "bucket")).alias("leaf")).select(
        "slot", "leaf.depth", "leaf.bucket", F.lit(bits).alias("bits")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_KEYS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, key, bucket, depth.

    1. A scan writes (doc_id, key, text_sha256) to the shared folder; ``key`` is a 64-bit hash of the normalised text.
    2. Texts of one key meet in one place and are compared byte by byte: they are grouping keys, and copies collapse before they are
       shuffled, so a text that a third of all rows carry travels once per input split. Different texts of one key form its chain.
    3. A directory is grown over the keys; the chains are dealt to owner tasks by key range and written as the index files.
    4. Every row looks its chain up in the index by bucket, key and digest.

    Null texts count as empty, so they equal '' and not ' '. Null ids never win against other ids; a group with null ids only has keep_id
    null and keeps its rows. Rows that repeat the winning id and text are copies that nothing tells apart: ``kept`` is true for each. Empty
    input gives an empty table. Other columns, whatever their names, are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("body"))
    rows = rows.withColumn("key", F.xxhash64("body"))
    entries = cut(rows.select("doc_id", "key", F.sha2("body", 256).alias("text_sha256")), "entries")
    chains = cut(
        rows.groupBy("key", "body")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"),
        "chains",
    )
    slots = cut(directory(chains, capacity), "directory")
    first = slots.select("bits").first()
    if first is None:
        return entries.select(
            "doc_id", F.lit(None).cast(entries.schema["doc_id"].dataType).alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), "text_sha256", "key", F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("depth"),
        )
    slot = F.shiftrightunsigned("key", 64 - first[0]).alias("slot")
    owned = chains.withColumn("slot", slot).join(slots.drop("bits"), "slot").drop("slot")
    index = cut(owned.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key"), "index")
    release(chains)
    found = entries.withColumn("slot", slot).join(slots.select("slot", "bucket"), "slot").drop("slot")
    found = found.join(index, ["bucket", "key", "text_sha256"])
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "key", "bucket", "depth"
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per normalised text: the one with the smallest doc_id. Columns stay as they are.

    Rows that repeat the winner's id and text collapse into one of them; rows without id and text likewise.
    """
    rows, names = positional(docs)
    id_col, text = names["doc_id"], names["text"]
    kept = exact_duplicates(rows, id_col, text).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_of")).distinct()
    marked = rows.withColumn("_sha", F.sha2(normalised(F.col(text)), 256))
    kept = marked.join(kept, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_of")), "left_semi")
    return restored(kept.dropDuplicates([id_col, "_sha"]), names)
