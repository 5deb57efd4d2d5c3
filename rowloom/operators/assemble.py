"""Putting tables together: feature joins, label joins, membership, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import skew_join


def join_features(base: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join feature tables (one row per key); tables without feature columns are skipped.

    All sides are hash-partitioned on the key, so the chain needs one shuffle per table.
    """
    useful = [t for t in tables if len(t.columns) > 1]
    return reduce(lambda out, t: out.join(t, key, "left"), useful, base)


def label_children(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Parent columns onto child rows (inner); safe when one parent owns most of the rows."""
    return skew_join(child, parent, [key], "inner")


def members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``ids``."""
    return skew_join(df, ids.select(key), [key], "left_semi")


def non_members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``ids``."""
    return skew_join(df, ids.select(key), [key], "left_anti")


def union_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right, allowMissingColumns=True)


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull())


def unlabelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNull())


def align_check(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row counts of both sides and of their inner join, and whether all three agree."""
    joined = left.select(key).join(right.select(key), key)
    return joined.agg(F.count(F.lit(1)).alias("n_joined")).select(
        left.select(F.count(F.lit(1))).scalar().alias("n_left"),
        right.select(F.count(F.lit(1))).scalar().alias("n_right"),
        "n_joined",
    ).withColumn(
        "aligned",
        ((F.col("n_joined") == F.col("n_left")) & (F.col("n_joined") == F.col("n_right"))).cast("int"),
    )
