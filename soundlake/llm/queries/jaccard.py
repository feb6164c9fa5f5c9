"""op1: documents linked by the similarity of their three-word shingles."""

from __future__ import annotations

from soundlake.llm.jaccard import similar_documents
from soundlake.llm.queries import table


def op1_ngram_jaccard(spark, sf_dir):
    return similar_documents(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


QUERIES = {"op1_ngram_jaccard": op1_ngram_jaccard}
ORACLE = {
    "op1_ngram_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce((SELECT min(r.b) FROM r WHERE r.a = w.doc_id), w.doc_id)) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id""",
}
