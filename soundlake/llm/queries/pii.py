"""op2: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.llm.pii import KINDS, personal_data
from soundlake.llm.queries import table


def op2_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data(docs)
    name = F.array(*map(F.lit, KINDS))
    joined = F.transform("spans", lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base"), 256).alias("base_sha256"), F.array_join(joined, ",").alias("spans")
    )


QUERIES = {"op2_pii": op2_pii}
