"""op6: all documents packed into sequences of 4096 tokens."""

from __future__ import annotations

import public_tokenizers

from soundlake.llm.packing import pack_documents
from soundlake.llm.queries import table


def op6_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op6_best_fit_packing": op6_best_fit_packing}
