"""op9: the language of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.llm.language import fit, identify, training
from soundlake.llm.queries import table


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(training(docs)))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
