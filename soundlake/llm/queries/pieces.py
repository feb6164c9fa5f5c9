"""op4: all documents, and all turns of all conversations, as SentencePiece ids, and back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundlake.llm.pieces import decode, encode
from soundlake.llm.queries import table


def coded_and_back(texts: DataFrame, *ids: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode(texts, path)
    back = decode(coded, path)
    return back.select(
        *ids, F.size("ids").cast("long").alias("n_pieces"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op4_documents(spark: SparkSession, sf_dir: str):
    return coded_and_back(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str):
    return coded_and_back(table(spark, sf_dir, "conversations"), "conv_id", "turn")


#: Documents come first: they are the whole of the training text.
QUERIES = {"op4_documents": op4_documents, "op4_sentencepiece": op4_sentencepiece}
