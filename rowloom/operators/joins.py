"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.session import BROADCAST_ROWS, is_planned_small, shared_small

#: A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are at most
#: HOT_SHARE hot keys: the hot list has a proven size bound whatever the data.
HOT_SHARE = 256
SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE, fraction: float = 0.02, least: int = 0) -> DataFrame:
    """Keys with more than ``1/share`` of a row sample, and about ``least`` rows in all. Results never depend on this list."""
    sampled = df.select(*keys).sample(fraction=fraction, seed=11)
    counted = sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = sampled.select(F.count(F.lit(1))).scalar()
    return counted.where((F.col("_n") * share > total) & (F.col("_n") >= least * fraction)).select(*keys)


def skew_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a table with one row per key (left, inner, left_semi or left_anti).

    A small ``one`` is broadcast by Spark's size rule. Otherwise both sides are shuffled on the
    key and Spark's adaptive execution splits the partitions of hot keys from the sizes it has
    measured, so the large side is read once. A caller who already has a list of hot keys (at most
    HOT_SHARE) gets their rows spread over SALTS reducers, to which the single matching row is
    copied.
    """
    keys = list(keys)
    if hot is None or is_planned_small(one):
        return many.join(one, keys, how)
    marked = hot.withColumn("_hot", F.lit(True))
    spread = F.pmod(F.xxhash64(*many.columns) + F.spark_partition_id(), F.lit(SALTS)).cast("int")
    left = many.join(F.broadcast(marked), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0))
    )
    right = one.join(F.broadcast(marked), keys, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))),
    )
    return left.drop("_hot").join(right.drop("_hot"), [*keys, "_salt"], how).drop("_salt")


def lookup(
    df: DataFrame, stats: DataFrame, keys: Sequence[str], hot: DataFrame | None = None, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join of fitted per-key statistics: broadcast below a checked size, else skew_join."""
    stats, small = shared_small(stats, max_rows)
    if small:
        return df.join(stats, list(keys), "left")
    return skew_join(df, stats, keys, "left", hot)
