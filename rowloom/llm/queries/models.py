"""Operator 9: language-model scores. Operator 10: language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import backoff, stringkernel


def _remainder(n: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (_remainder(5) != 1).alias("train"), "text")
    return backoff.scored(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "strength")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    model = stringkernel.fit(docs.where(~held_out), key="doc_id")
    return stringkernel.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_lm_score": op9_lm_score, "op10_language_id": op10_language_id}
ORACLES: dict[str, str] = {}
