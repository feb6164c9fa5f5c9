"""op3: main text of all pages."""

from __future__ import annotations

from soundlake.llm.html import extract
from soundlake.llm.queries import table


def op3_html_extraction(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {"op3_html_extraction": op3_html_extraction}
ORACLE = {}
