"""op5: quality of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.llm.queries import table
from soundlake.llm.quality import quality_scores

#: A document counts as good from this score on.
GOOD = 0.3


def op5_quality(spark, sf_dir):
    fold = lambda: F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    found = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(fold() != 0))
    held = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


QUERIES = {"op5_quality": op5_quality}
