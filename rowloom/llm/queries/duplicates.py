"""Operator 6: SimHash near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import simhash


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return simhash.near_duplicates(docs).select("doc_id", fingerprint, "component_id")


QUERIES = {"op6_simhash": op6_simhash}
ORACLES: dict[str, str] = {}
