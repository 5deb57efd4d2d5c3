"""Fractional ranks, exact ROC AUC and correlations of score columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import HOT_SHARE, skew_join
from rowloom.operators.ordered import bucket_key, running_totals, with_order_bucket


def melt(df: DataFrame, keep: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Wide scores -> (keep..., model, score), without missing scores."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("score")) for c in cols]
    )
    return df.select(*keep, F.inline(cells)).where(F.col("score").isNotNull())


def rank_table(scores: DataFrame) -> DataFrame:
    """(model, score, n, pct) for (model, score) rows: average-tie rank over the row count.

    Tied scores collapse to one row before anything is ordered.
    """
    bucketed = with_order_bucket(scores, "score")
    tallied = bucketed.groupBy("model", *bucket_key(bucketed), "score").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(tallied, ["score"], ["n"], ["model"])
    average_rank = F.col("n_upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    return placed.select("model", "score", "n", "n_total", (average_rank / F.col("n_total")).alias("pct"))


def ranked_long(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, model, score, pct)."""
    long = melt(df, [key], cols)
    table = rank_table(long.select("model", "score"))
    hot = table.where(F.col("n") * HOT_SHARE > F.col("n_total")).select("model", "score")
    return skew_join(long, table.select("model", "score", "pct"), ["model", "score"], "inner", hot)


def rank_norm(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, cols...) with each column replaced by its fractional rank; NULL stays NULL."""
    ranked = ranked_long(df, key, cols)
    return (
        df.select(key)
        .join(
            ranked.groupBy(key).agg(*[F.max(F.when(F.col("model") == c, F.col("pct"))).alias(c) for c in cols]),
            key,
            "left",
        )
    )


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC per group, ties counted half; NULL if a group has one class only.

    Equals the rank-sum form: each positive counts the negatives below it.
    """
    by = list(by)
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(
        *by, F.col(label).cast("int").alias("_y"), F.col(score).cast("double").alias("_score")
    )
    bucketed = with_order_bucket(rows, "_score")
    tallied = bucketed.groupBy(*by, *bucket_key(bucketed), "_score").agg(
        F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg")
    )
    placed = running_totals(tallied, ["_score"], ["_neg"], by)
    below = F.col("_neg_upto") - F.col("_neg") / F.lit(2.0)
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return placed.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_pos") * below), pairs).alias("auc"),
        F.sum("_pos").alias("n_pos"),
        F.sum("_neg").alias("n_neg"),
    )


def auc_by_model(df: DataFrame, label: str, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """AUC of several score columns in one job: (model, by..., auc, n_pos, n_neg)."""
    return auc(melt(df, [label, *by], cols), label, "score", ["model", *by])


def corr_matrix(df: DataFrame, cols: Sequence[str], key: str | None = None, method: str = "pearson") -> DataFrame:
    """All ordered pairs (a, b, r), pairwise complete, in one pass; ``spearman`` ranks first."""
    if method == "spearman":
        df = rank_norm(df, key, cols)
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ((a, b), (b, a))
    ] + [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in cols]
    return one.select(F.inline(F.array(*cells)))


def anchor_correlations(matrix: DataFrame, anchor: str) -> DataFrame:
    """Correlations of the others to ``anchor``, weakest first."""
    return (
        matrix.where((F.col("a") == anchor) & (F.col("b") != anchor))
        .select(F.col("b").alias("model"), "r")
        .orderBy("r", "model")
    )
