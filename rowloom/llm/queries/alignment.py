"""Operator 11: cross-tokenizer alignment."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import crosstoken


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return crosstoken.scored(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op11_token_alignment": op11_token_alignment}
ORACLES: dict[str, str] = {}
