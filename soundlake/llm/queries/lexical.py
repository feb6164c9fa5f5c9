"""op13: documents ranked for every benchmark item."""

from __future__ import annotations

from soundlake.llm.lexical import ranked_search
from soundlake.llm.queries import table


def op13_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {"op13_ranked_search": op13_ranked_search}
ORACLE = {
    "op13_ranked_search": r"""
WITH word AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
size AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM size),
tf AS (SELECT doc_id, t, count(*) AS tf FROM word WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
w AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * any_value(big_n) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // l)))) AS s FROM tf JOIN w USING (t) JOIN size USING (doc_id), total),
score AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM asked JOIN part USING (t) GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS "rank" FROM score WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM r WHERE "rank" <= 50""",
}
