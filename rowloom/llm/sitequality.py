"""Quality of documents from their own evidence and from the record of their host and path.

A logistic model of text statistics and of the words' own evidence (a column ``margin``, see ``ngramevidence``), fitted on a bounded sample of labelled documents (about ``sample`` with the
smallest hashes), gives each document a log-likelihood ratio. Labels of all rows are counted per path and
host by grouped aggregation. Hosts have a Beta prior around the global rate and paths one around their host;
both concentrations are estimated by moments from all counts, so that sparse sites shrink towards their
parent and well-known ones keep their own rate. The score is the path's posterior log-odds plus the
document's ratio. A labelled document is left out of the counts of its own sites.

Null hosts and paths are sites of their own. Conflicting labels of one document count as bad; null labels
are none. Without any labels all scores are 0.5. Repeated documents each get a row. Other columns of the
input do not reach the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.session import stored

#: Features of the logistic model over the columns of ``textstats.COUNTS``.
FEATURES: dict[str, str] = {
    "size": "log(1 + n_words)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "lines": "n_dup_lines / greatest(n_lines, 1)",
    "windows": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "length": "word_chars / greatest(n_words, 1) / 10",
    "one_char": "abs(word_chars / greatest(n_words, 1) - 5) / 10",
    "tiny": "CAST(n_words < 20 AS double)",
}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (constant last) by Newton's method with a ridge on all but the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _concentration(s: str, df: str, n: str, p: str) -> F.Column:
    """Beta concentration from a weighted sum of squares ``s`` with ``df`` degrees of freedom."""
    rho = F.expr(f"try_divide({s} - ({df}) * ({p}) * (1 - ({p})), ({p}) * (1 - ({p})) * ({n} - ({df})))")
    return 1 / F.greatest(F.least(F.coalesce(rho, F.lit(1e-6)), F.lit(0.999)), F.lit(1e-6)) - 1


def site_posteriors(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (host, path, good): counts per path with those of its host, and one row of global priors."""
    paths = labelled.groupBy("host", "path").agg(F.count("*").alias("path_n"), F.sum("good").alias("path_k"))
    hosts = paths.groupBy("host").agg(
        F.sum("path_n").alias("host_n"),
        F.sum("path_k").alias("host_k"),
        F.count("*").alias("n_paths"),
        F.expr("sum(path_n * path_n)").alias("n_square"),
        F.expr("sum(path_k * path_k / path_n)").alias("k_square"),
    )
    hosts = stored(hosts, "hosts")
    total = hosts.agg(
        F.sum("host_n").alias("n"),
        F.sum("host_k").alias("k"),
        F.count("*").alias("n_hosts"),
        F.expr("sum(host_n * host_n)").alias("hn2"),
        F.expr("sum(host_k * host_k / host_n)").alias("hk2"),
        F.expr("sum(k_square - host_k * host_k / host_n)").alias("within"),
        F.expr("sum(n_paths - 1)").alias("within_df"),
        F.expr("sum(host_n - n_square / host_n)").alias("within_n"),
    )
    prior = total.withColumn("prior", (F.coalesce("k", F.lit(0)) + 0.5) / (F.coalesce("n", F.lit(0)) + 1)).select(
        "prior",
        _concentration("(hk2 - try_divide(k * k, n))", "n_hosts - 1", "(n - try_divide(hn2, n))", "prior").alias("host_strength"),
        _concentration("within", "within_df", "within_n", "prior").alias("path_strength"),
    )
    sites = paths.join(hosts.select("host", "host_n", "host_k"), paths["host"].eqNullSafe(hosts["host"])).select(paths["host"], "path", "path_n", "path_k", "host_n", "host_k")
    return sites, prior


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``good``: 1.0, 0.0 or null without a label. Written once, since counts and scores read it."""
    label = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("double").alias("good"))
    return stored(docs.join(label, "doc_id", "left"), "rated")


def with_posteriors(docs: DataFrame) -> DataFrame:
    """From ``rated`` rows with host and path: host_posterior, path_posterior, and the prior with its strengths."""
    sites, prior = site_posteriors(docs.where("good IS NOT NULL"))
    # Only paths that have labels are in ``sites``; a host's other paths take the host's counts.
    by_host = sites.select("host", "host_n", "host_k").distinct().select(F.col("host").alias("__host"), F.col("host_n").alias("hn"), F.col("host_k").alias("hk"))
    by_path = sites.select(F.col("host").alias("__h"), F.col("path").alias("__p"), F.col("path_n").alias("pn"), F.col("path_k").alias("pk"))
    joined = (
        docs.join(by_host, F.col("host").eqNullSafe(F.col("__host")), "left")
        .join(by_path, F.col("host").eqNullSafe(F.col("__h")) & F.col("path").eqNullSafe(F.col("__p")), "left")
        .crossJoin(F.broadcast(prior))  # one row
    )
    own_n, own_k = F.when(F.col("good").isNull(), 0).otherwise(1), F.coalesce("good", F.lit(0.0))
    less = lambda total, own: F.greatest(F.coalesce(F.col(total), F.lit(0.0)) - own, F.lit(0.0))
    host = (less("hk", own_k) + F.col("host_strength") * F.col("prior")) / (less("hn", own_n) + F.col("host_strength"))
    joined = joined.withColumn("host_posterior", host)
    path = (less("pk", own_k) + F.col("path_strength") * F.col("host_posterior")) / (less("pn", own_n) + F.col("path_strength"))
    return joined.withColumn("path_posterior", path)


def sampled(known: DataFrame, sample: int, width: int) -> np.ndarray:
    """Features and label of about ``sample`` documents with the smallest hashes, one row per id. Only they move."""
    xs = [f"__x{i}" for i in range(width)]
    each = known.groupBy("doc_id").agg(F.min(F.struct(*xs, "good")).alias("r"))
    share = min(1.0, sample / max(known.agg(F.approx_count_distinct("doc_id")).first()[0], 1))
    chosen = each.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < F.lit(share * (1 << 31))).orderBy("doc_id")
    return chosen.select("r.*").toPandas().to_numpy(dtype=float).reshape(-1, len(xs) + 1)


def scored(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """(doc_id, host, path, evidence, host_posterior, path_posterior, quality_score) of every document."""
    given = [*FEATURES.values(), *(["margin"] if "margin" in docs.columns else [])]
    features = [F.expr(sql).cast("double").alias(f"__x{i}") for i, sql in enumerate(given)]
    base = rated(docs.select("doc_id", "host", "path", *features), labels)
    rows = sampled(base.where("good IS NOT NULL"), sample, len(given))
    if len(rows) and 0 < rows[:, -1].sum() < len(rows):
        mean, spread = rows[:, :-1].mean(axis=0), rows[:, :-1].std(axis=0) + 1e-9
        w = fit_logistic((rows[:, :-1] - mean) / spread, rows[:, -1])
        rate = rows[:, -1].mean()
        weight, constant = w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum() - np.log(rate / (1 - rate))
    else:
        weight, constant = np.zeros(len(given)), 0.0
    evidence = sum((F.col(f"__x{i}") * float(v) for i, v in enumerate(weight)), F.lit(float(constant)))
    joined = with_posteriors(base.withColumn("evidence", evidence))
    odds = F.col("evidence") + F.log(F.col("path_posterior") / (1 - F.col("path_posterior")))
    score = F.when(F.expr("prior = 0.5 AND host_strength IS NULL"), F.lit(0.5)).otherwise(1 / (1 + F.exp(-odds)))
    return joined.select("doc_id", "host", "path", "evidence", "host_posterior", "path_posterior", score.alias("quality_score"))
