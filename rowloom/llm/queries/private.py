"""Operator 13: personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import skipchain


def _listed(spans: F.Column) -> F.Column:
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, part), ",")


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = skipchain.tagged(docs, skipchain.fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.expr(f"size(filter(spans, s -> s.base AND s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in skipchain.KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


QUERIES = {"op13_personal_data": op13_personal_data}
ORACLES: dict[str, str] = {}
