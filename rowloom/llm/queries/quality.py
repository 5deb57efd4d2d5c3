"""Operator 1: quality rules with risk-controlled cutoffs. Operator 3: the quality classifier with site posteriors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import ngramevidence, riskrules, sitequality, textstats
from rowloom.llm.arrowtext import appended
from rowloom.session import stored


def _statistics(docs: DataFrame) -> DataFrame:
    """A few numbers per document, written once: fitting and applying both read them."""
    return stored(appended(docs, "text", textstats.FIELDS, textstats.counts).drop("text"), "statistics")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text", F.unhex(F.md5("text")).alias("text_key"))
    stats = _statistics(docs).withColumn(
        "base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    )
    labels = riskrules.verdict_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    labelled = stats.where("NOT base_failed").join(labels, "doc_id").select("lang", "text_key", "good", *textstats.COUNTS)
    holdout = riskrules.one_per_text(labelled, "text_key", "lang")
    limits = stored(riskrules.cutoffs(holdout, stratum="lang"), "cutoffs")
    return riskrules.verdicts(stats, limits, stratum="lang").select(
        "doc_id",
        *textstats.COUNTS[:5],
        "base_failed",
        F.expr("NOT base_failed AND size(failed) = 0").alias("kept"),
        F.concat_ws(",", "failed").alias("failed_rules"),
    )


def op3_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = _statistics(ngramevidence.with_margin(docs, labels))
    sites = stats.select("doc_id", F.col("source").alias("host"), F.concat_ws("/", "source", "lang").alias("path"), "margin", *textstats.COUNTS)
    return sitequality.scored(sites, labels).select(
        "doc_id", "host", "path", "evidence", "host_posterior", "path_posterior", "quality_score", F.expr("quality_score >= 0.5").alias("kept")
    )


def op3_site_posteriors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What hosts and paths alone say of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("source").alias("host"), F.concat_ws("/", "source", "lang").alias("path"))
    rated = sitequality.rated(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    shown = [F.round(c, 9).alias(c) for c in ("host_posterior", "path_posterior")]
    return sitequality.with_posteriors(rated).select("doc_id", "host", "path", *shown)


def _strength(s: str, df: str, n: str) -> str:
    p = "prior * (1 - prior)"
    rho = f"CASE WHEN {p} * ({n} - ({df})) <> 0 THEN ({s} - ({df}) * {p}) / ({p} * ({n} - ({df}))) END"
    return f"1 / greatest(least(coalesce({rho}, 1e-6::DOUBLE), 0.999::DOUBLE), 1e-6::DOUBLE) - 1"


# Beta posteriors: hosts around the global rate, paths around their host, a document's own label left out.
_SITES_SQL = f"""
WITH d AS (SELECT doc_id, source AS host, concat_ws('/', source, lang) AS path FROM documents),
l AS (SELECT doc_id, min(quality)::DOUBLE AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
r AS (SELECT d.*, good FROM d LEFT JOIN l USING (doc_id)),
paths AS (SELECT host, path, count(*)::DOUBLE AS pn, sum(good) AS pk FROM r WHERE good IS NOT NULL GROUP BY host, path),
hosts AS (SELECT host, sum(pn) AS hn, sum(pk) AS hk, count(*)::DOUBLE AS paths, sum(pn * pn) AS n2, sum(pk * pk / pn) AS k2 FROM paths GROUP BY host),
total AS (SELECT sum(hn) AS n, sum(hk) AS k, count(*)::DOUBLE AS hosts, sum(hn * hn) AS hn2, sum(hk * hk / hn) AS hk2,
                 sum(k2 - hk * hk / hn) AS within, sum(paths - 1) AS within_df, sum(hn - n2 / hn) AS within_n FROM hosts),
p AS (SELECT *, (coalesce(k, 0) + 0.5::DOUBLE) / (coalesce(n, 0) + 1) AS prior FROM total),
s AS (SELECT prior, {_strength('(hk2 - k * k / n)', 'hosts - 1', '(n - hn2 / n)')} AS hs, {_strength('within', 'within_df', 'within_n')} AS ps FROM p),
j AS (SELECT r.doc_id, r.host, r.path, r.good, coalesce(hn, 0) AS hn, coalesce(hk, 0) AS hk, coalesce(pn, 0) AS pn, coalesce(pk, 0) AS pk
      FROM r LEFT JOIN hosts h ON r.host IS NOT DISTINCT FROM h.host
      LEFT JOIN paths q ON r.host IS NOT DISTINCT FROM q.host AND r.path IS NOT DISTINCT FROM q.path),
a AS (SELECT j.*, ps, (greatest(hk - coalesce(good, 0), 0) + hs * prior) / (greatest(hn - (good IS NOT NULL)::INT, 0) + hs) AS hp FROM j, s)
SELECT doc_id, host, path, round(hp, 9) AS host_posterior,
       round((greatest(pk - coalesce(good, 0), 0) + ps * hp) / (greatest(pn - (good IS NOT NULL)::INT, 0) + ps), 9) AS path_posterior
FROM a
"""

QUERIES = {"op1_quality_rules": op1_quality_rules, "op3_site_quality": op3_site_quality, "op3_site_posteriors": op3_site_posteriors}
ORACLES = {"op3_site_posteriors": _SITES_SQL}
