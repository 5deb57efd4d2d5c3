"""Feature selection: correlation filter, importances, null importances, subsets."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.encode import fitted
from rowloom.operators.folds import positions, sample_n, stratified, with_folds
from rowloom.operators.oof import feature_vector, gbt
from rowloom.session import scratch_path, stored_by

#: Columns per block of the correlation partial sums.
BLOCK = 256
#: Groups in which the sums of one block pair are added first.
LANES = 64


def _added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add up the sums of equal block pairs, one row at a time."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for frame in frames:
        for a, b, raw in zip(frame["a"], frame["b"], frame["sums"]):
            part = np.frombuffer(raw)
            total[a, b] = total[a, b] + part if (a, b) in total else part
    for (a, b), part in total.items():
        yield pd.DataFrame({"a": [a], "b": [b], "sums": [part.tobytes()]})


def pair_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, r) for i < j: pairwise-complete Pearson correlation of many columns, over all rows.

    Each task reduces its rows to one dense row of six sums per pair of column blocks. These are
    added in two steps, first in LANES groups per block pair, so that no task adds all of them.
    """
    means = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in cols]).first()
    shift = np.array([means[c] for c in cols])
    names = list(cols)

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for frame in frames:
            x = frame[names].to_numpy(dtype=float) - shift
            m = ~np.isnan(x)
            x = np.where(m, x, 0.0)
            m = m.astype(float)
            for a in range(0, len(names), BLOCK):
                for b in range(a, len(names), BLOCK):
                    xa, ma, xb, mb = x[:, a : a + BLOCK], m[:, a : a + BLOCK], x[:, b : b + BLOCK], m[:, b : b + BLOCK]
                    part = np.stack([ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa**2).T @ mb, ma.T @ (xb**2), xa.T @ xb])
                    total[a, b] = total[a, b] + part if (a, b) in total else part
        for (a, b), part in total.items():
            yield pd.DataFrame({"a": [a], "b": [b], "sums": [part.tobytes()]})

    def correlations(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _added(frames):
            a, b = int(frame["a"][0]), int(frame["b"][0])
            shape = (6, min(BLOCK, len(names) - a), min(BLOCK, len(names) - b))
            n, sx, sy, sxx, syy, sxy = np.frombuffer(frame["sums"][0]).reshape(shape)
            i, j = np.meshgrid(np.arange(shape[1]) + a, np.arange(shape[2]) + b, indexing="ij")
            vx, vy = n * sxx - sx * sx, n * syy - sy * sy
            sound = (n > 1) & (vx > 0) & (vy > 0)
            r = np.where(sound, (n * sxy - sx * sy) / np.sqrt(np.where(sound, vx * vy, 1.0)), np.nan)
            keep = i < j
            yield pd.DataFrame({"i": i[keep], "j": j[keep], "r": r[keep]})

    block = "a int, b int, sums binary"
    partial = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(sums, block)
    lane = F.pmod(F.spark_partition_id(), F.lit(LANES))
    merged = partial.withColumn("lane", lane).repartition("a", "b", "lane").select("a", "b", "sums").mapInPandas(_added, block)
    pairs = merged.repartition("a", "b").mapInPandas(correlations, "i long, j long, r double")
    return pairs.select("i", "j", F.when(~F.isnan("r"), F.col("r")).alias("r"))


def correlated_columns(df: DataFrame, cols: Sequence[str], limit: float = 0.985) -> DataFrame:
    """(position, column): columns with an absolute correlation above ``limit`` to any earlier
    column, itself dropped or not."""
    pairs = pair_correlations(df, cols).where(F.abs("r") > limit)
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), (F.col("position") + 1).cast("int"))
    return (
        pairs.groupBy(F.col("j").alias("position"))
        .agg(F.count(F.lit(1)).alias("n_earlier"))
        .select("position", name.alias("column"), "n_earlier")
    )


def corr_filter(df: DataFrame, cols: Sequence[str], limit: float = 0.985) -> list[str]:
    """The columns that stay, judged on all rows."""
    dropped = {r["column"] for r in correlated_columns(df, cols, limit).collect()}
    return [c for c in cols if c not in dropped]


def split_counts(model, features: Sequence[str]) -> DataFrame:
    """(feature, splits): how often the trees split on each feature; 0 if never.

    Read from the saved model, since MLlib's own importance is a normalised gain.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    path = scratch_path(spark, "model")
    model.write().save(path)
    used = (
        spark.read.parquet(f"{path}/data")
        .select(F.col("nodeData.split.featureIndex").alias("position"))
        .where(F.col("position") >= 0)
        .groupBy("position")
        .agg(F.count(F.lit(1)).alias("splits"))
    )
    names = spark.createDataFrame(list(enumerate(features)), "position int, feature string")
    return names.join(used, "position", "left").select("feature", F.coalesce("splits", F.lit(0)).alias("splits"))


def _folded(df: DataFrame, key: str, label: str, k: int, seed: int) -> DataFrame:
    return df.drop("fold").where(F.col(label).isNotNull()).join(stratified(df, key, label, k, seed).select(key, "fold"), key)


def gain_importance(
    df: DataFrame, key: str, features: Sequence[str], label: str, make: Callable[[], Estimator] | None = None,
    k: int = 3, folds: Sequence[int] = (0,), seed: int = 42,
) -> DataFrame:
    """(feature, importance): mean gain over models that leave out one of ``folds`` each."""
    rows = feature_vector(_folded(df, key, label, k, seed), features).select(
        F.col(label).cast("double").alias("label"), "fold", "features"
    ).persist()
    total = np.zeros(len(features))
    for f in folds:
        estimator = make() if make else gbt(seed)
        watched = rows.withColumn("_held_out", F.col("fold") == f)
        total += estimator.fit(watched).featureImportances.toArray()
    rows.unpersist()
    values = [(c, float(v)) for c, v in zip(features, total / len(folds))]
    return df.sparkSession.createDataFrame(values, "feature string, importance double")


def top_importance(
    importance: DataFrame, n: int = 900, must_keep: Sequence[str] = ()
) -> DataFrame:
    """(position, feature, importance): the n best with positive gain in falling order, then the
    must-keep columns that are not among them, in the order given."""
    best = importance.where("importance > 0").orderBy(F.desc("importance"), "feature").limit(n)
    turn = F.array_position(F.array(*[F.lit(c) for c in must_keep]).cast("array<string>"), F.col("feature"))
    kept = importance.where(turn > 0).join(best.select("feature"), "feature", "left_anti")
    ordered = Window.orderBy("_late", "_turn", F.desc("importance"), "feature")  # at most n rows and the must-keeps
    return (
        best.select("feature", "importance", F.lit(0).alias("_late"), F.lit(0).cast("long").alias("_turn"))
        .union(kept.select("feature", "importance", F.lit(1), turn))
        .select((F.row_number().over(ordered) - 1).alias("position"), "feature", "importance")
    )


def shuffled_labels(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """(key, label) with the labels dealt out in another md5 order: a permutation of them."""
    rows = df.select(key, label).where(F.col(label).isNotNull())
    seats = positions(rows, key, seed, "_seat").select(key, "_seat")
    cards = positions(rows, key, seed + 7919, "_seat").select(label, "_seat")
    return seats.join(cards, "_seat").select(key, label)


#: Bins per column, as many as the trees use.
BINS = 32


def binned_matrix(df: DataFrame, key: str, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """(key, features): the number of the quantile bin of every feature, missing values in a bin of their own.

    Bins are fitted and the vectors assembled once, and written by buckets of the key; whatever fits trees to them
    with other labels or folds reads this table. Trees split on the order of values, which bins keep.
    """
    numbers = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"_f{i}") for i, c in enumerate(features)])
    names = [f"_f{i}" for i in range(len(features))]
    edges = numbers.replace(float("nan"), None).approxQuantile(names, [i / (bins - 1) for i in range(1, bins - 1)], 0.5 / bins)
    inner = [sorted({x for x in e if abs(x) < float("inf")}) for e in edges]
    # A column with one value has one bin.
    splits = [[float("-inf"), *(e or [0.0]), float("inf")] for e in inner]
    out = [f"_b{i}" for i in range(len(features))]
    placed = Bucketizer(splitsArray=splits, inputCols=names, outputCols=out, handleInvalid="keep").transform(numbers)
    # Plain numbers: Bucketizer marks its columns as categories, which trees would not split in order.
    placed = placed.select(key, *[(F.col(b) + F.lit(0.0)).alias(b) for b in out])
    return stored_by(VectorAssembler(inputCols=out, outputCol="features").transform(placed).select(key, "features"), key, "binned")


def _split_importance(
    matrix: DataFrame, labels: DataFrame, key: str, features: Sequence[str], label: str, make: Callable[[], Estimator], k: int, seed: int
) -> DataFrame:
    folded = with_folds(labels, key, label, k, seed).select(key, F.col(label).cast("double").alias("label"), "fold")
    rows = matrix.join(folded, key).select("label", "fold", "features").persist()
    parts = None
    for f in range(k):
        counts = split_counts(make().fit(rows.withColumn("_held_out", F.col("fold") == f)), features)
        parts = counts if parts is None else parts.unionByName(counts)
    out = parts.groupBy("feature").agg((F.sum("splits") / F.lit(k)).alias("importance"))
    rows.unpersist()
    return out


def null_importance(
    df: DataFrame, key: str, features: Sequence[str], label: str, make: Callable[[int], Estimator] | None = None,
    runs: int = 5, k: int = 3, sample: int = 60_000, seed: int = 42,
) -> DataFrame:
    """(feature, run, importance): run -1 has the true labels, the others shuffled ones.

    The classifiers are fitted on a sample of at most ``sample`` labelled rows, whose binned features all fits share.
    """
    make = make or (lambda s: gbt(s, trees=40, rate=0.05))
    rows = sample_n(df.where(F.col(label).isNotNull()), key, sample, seed)
    matrix, labels = binned_matrix(rows, key, features), fitted(rows.select(key, label))
    out = _split_importance(matrix, labels, key, features, label, lambda: make(seed), k, seed).withColumn("run", F.lit(-1))
    for run in range(runs):
        dealt = shuffled_labels(labels, key, label, 100 + run)
        part = _split_importance(matrix, dealt, key, features, label, lambda run=run: make(100 + run), k, 100 + run)
        out = out.unionByName(part.withColumn("run", F.lit(run)))
    return out.select("feature", "run", "importance")


def keep_rule(importances: DataFrame, level: float = 0.8, least: float = 1.0) -> DataFrame:
    """(feature, actual, null_level, ratio, keep) from (feature, run, importance).

    A feature stays if its importance reaches the ``level`` quantile of its shuffled runs + 1.
    """
    # One value per shuffled run and feature: the percentile sees a handful of rows.
    graded = importances.groupBy("feature").agg(
        F.max(F.when(F.col("run") < 0, F.col("importance"))).alias("actual"),
        F.percentile(F.when(F.col("run") >= 0, F.col("importance")), F.lit(level)).alias("null_level"),
    )
    ratio = F.col("actual") / (F.col("null_level") + 1)
    return graded.select("feature", "actual", "null_level", ratio.alias("ratio"), (ratio >= least).cast("int").alias("keep"))


def subsets(importance: DataFrame, features: Sequence[str], top: int = 400, without_prefix: str = "GP") -> dict[str, list[str]]:
    """Named feature lists: all, the most important, and all without a prefix."""
    best = importance.orderBy(F.desc("importance"), "feature").limit(top).collect()
    return {
        "all": list(features),
        "top": [r["feature"] for r in best],
        "no_prefix": [c for c in features if not c.startswith(without_prefix)],
    }
