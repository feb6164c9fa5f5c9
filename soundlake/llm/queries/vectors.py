"""op7: near-duplicate embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.llm.queries import table
from soundlake.llm.vectors import near_duplicates


def op7_embedding_near_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", F.col("n_links").cast("long"), F.col("component_id").cast("long"), "kept")


QUERIES = {"op7_embedding_near_dedup": op7_embedding_near_dedup}
ORACLE = {
    "op7_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m.b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m.b, vec_id)) AS kept FROM v LEFT JOIN m ON m.a = vec_id LEFT JOIN n ON n.a = vec_id""",
}
