"""Operator 12: periodic runs of words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import periodic

#: A run has this many periods and words, at least.
EXPONENT, LEAST = 4, 6


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a tenth of the texts, by a hash of the id, becomes periodic from some word on.

    A null id has no hash: such texts stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    some = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    some = some.withColumn("n", F.greatest(F.size("w"), F.lit(0)).cast("long")).withColumn("g", F.expr("h div 10"))
    some = some.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    some = some.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    turned = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, get(w, int(a + (i - a) % p)))), ' ')")
    return some.select("doc_id", F.when(F.col("n") > 0, turned).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic.with_runs(planted(docs), exponent=EXPONENT, least=LEAST)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS before, -r.period AS shorter)))")
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"),
        F.expr("(1000 * best.length) div (-best.shorter)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLES: dict[str, str] = {}
