"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Language ID puts the predicted language of each document in place of its label, so that the token ids go by what
the text is, and rejects documents without a letter, which have none; line dedup deletes later copies of runs of lines with 50 words
or more, and documents of which nothing is left; near-dedup keeps the document with the smallest id of each
SimHash group; decontamination drops documents that hold ten consecutive words of a benchmark item; the last
stage encodes what is left and checks the way back. All other documents stay, with all their columns.

Null and empty texts are rejected by the first stage. Long texts pass every stage whole. Of repeated rows, and of
other exact or near copies, near-dedup keeps one; there are no other ties. Extra columns stay up to the last stage
(one named like an added column is replaced). An empty table gives an empty result.

The stages with Python workers bound the bytes of an Arrow batch in the session they run in (``bounded_batches``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import lineruns, phrases, pieces, simhash, stringkernel
from rowloom.session import bounded_batches, stored

MODEL = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    model = stringkernel.fit(docs, key="doc_id")
    rest = docs.drop("lang_pred", "score")
    known = stringkernel.predict(rest, model).where("lang_pred <> 'und'").withColumn("lang", F.col("lang_pred"))
    return known.select(*[f"`{c}`" for c in docs.columns if c not in ("lang_pred", "score")])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    less = lineruns.without_repeats(docs).where("n_removed = 0 OR n_removed < n_lines")
    return less.withColumn("n_chars", F.length("text").cast("long")).select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return simhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return phrases.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    model = public_tokenizers.path(MODEL)
    ids = pieces.encode(docs.select("doc_id", "lang", "source", "text"), model, back="decoded")
    return ids.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: The kernel classifier, SimHash groups and token ids are beyond SQL; the tests hold a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
