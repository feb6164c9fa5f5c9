"""Operators for training-data corpora. Nothing else in the library imports this package."""

from __future__ import annotations

import importlib

MODULES = ("jaccard", "pii", "html", "pieces", "quality", "packing", "vectors", "exact", "language", "warc", "topk", "negatives", "lexical")


def registry():
    """(queries, oracle SQL) by name."""
    found, sql = {}, {}
    for m in MODULES:
        module = importlib.import_module(f"soundlake.llm.queries.{m}")
        found |= module.QUERIES
        sql |= getattr(module, "ORACLE", {})
    return found, sql
