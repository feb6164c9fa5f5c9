"""op10: all pages as WARC records, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.llm.queries import table
from soundlake.llm.warc import archive_round_trip
from soundlake.operators.lineage import scratch


def op10_warc(spark, sf_dir):
    captures = archive_round_trip(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return captures.select("page_id", "response.payload_bytes", "response.payload_digest", F.col("response.warc_type").alias("record_type"), "refers_to")


QUERIES = {"op10_warc": op10_warc}
ORACLE = {
    "op10_warc": """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT page_id, payload_bytes, h, list_transform(range(8), lambda i: list_reduce(list_transform(range(1, 6), lambda j: CAST(strpos('0123456789abcdef', substr(h, CAST(5 * i + j AS BIGINT), 1)) - 1 AS INTEGER)), lambda x, y: x * 16 + y)) AS c FROM d),
g AS (SELECT page_id, payload_bytes, h, array_to_string(list_transform(c, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v // 32768, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v // 1024 % 32, 1)
  || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v // 32 % 32, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v % 32, 1)), '') AS payload_digest, max(page_id) OVER (PARTITION BY h, payload_bytes) AS last FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM g""",
}
