"""From raw documents to packed training sequences: language ID, exact dedup, n-gram Jaccard join, personal data, best-fit packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the columns of ``docs``. A stage's decisions take
effect: rows of no learned language go, of equal texts and of each class of near copies one row stays, personal data are replaced in the texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from soundlake.llm.exact import drop_exact_duplicates
from soundlake.llm.jaccard import drop_similar
from soundlake.llm.language import known_language
from soundlake.llm.packing import pack_documents
from soundlake.llm.pii import redact
from soundlake.operators.lineage import cut

TOKENIZER = "word_bpe_49k.json"
#: Near copies: five-word shingles, Jaccard similarity of at least 80 / 100.
WIDTH, NUM, DEN = 5, 80, 100


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters or in no language that the labelled documents teach."""
    return known_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, but for white space, keep the row with the smallest doc_id."""
    return drop_exact_duplicates(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies keep the row with the smallest doc_id."""
    return drop_similar(docs, WIDTH, NUM, DEN)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by their kind."""
    return redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all texts in sequences of at most 4096."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Language ID and tokens have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
