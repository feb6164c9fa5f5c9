"""op8: exact duplicates of all documents."""

from __future__ import annotations

from soundlake.llm.exact import exact_duplicates
from soundlake.llm.queries import table


def op8_exact_dedup(spark, sf_dir):
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {"op8_exact_dedup": op8_exact_dedup}
ORACLE = {
    "op8_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM d JOIN g USING (body)""",
}
