"""Reproducible folds and samples, ordered by the md5 of id and seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.expr import uniform_hash
from rowloom.operators.ordered import running_totals, with_order_bucket
from rowloom.session import is_planned_small, stored


def _hex_bucket(digest: Column) -> Column:
    """The first three hex digits: 4096 even buckets that follow digest order."""
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def positions(df: DataFrame, key: str, seed: int, name: str = "position", by: tuple[str, ...] = ()) -> DataFrame:
    """Add the 0-based place of each row in md5 order, per group ``by``."""
    hashed = df.withColumn("_digest", uniform_hash(key, seed)).withColumn("_one", F.lit(1))
    if not is_planned_small(df):
        hashed = hashed.withColumn("_bucket", _hex_bucket(F.col("_digest")))
    placed = running_totals(hashed, ["_digest", key], ["_one"], by)
    return placed.select(*df.columns, (F.col("_one_upto") - 1).alias(name))


def stratified(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(key, label, fold) of the labelled rows: sizes differ by one at most within a label."""
    rows = df.select(key, label).where(F.col(label).isNotNull())
    return positions(rows, key, seed, "_place", (label,)).select(
        key, label, (F.col("_place") % k).cast("int").alias("fold")
    )


def with_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """All rows with their fold (replacing an earlier one); unlabelled rows have none."""
    return df.drop("fold").join(stratified(df, key, label, k, seed).select(key, "fold"), key, "left")


def group_fold(group: str, k: int = 5, seed: int = 42) -> Column:
    """Fold of a group from its md5: all rows of a parent agree, and no shuffle is needed. Sizes are equal on average only."""
    return (F.conv(F.substring(uniform_hash(group, seed), 1, 8), 16, 10).cast("long") % k).cast("int")


def balanced_group_folds(df: DataFrame, group: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(group, n, fold) with all rows of a group in one fold and even folds: groups are dealt in falling size, to
    and fro over the folds (md5 breaks ties), so two folds differ by the largest group at most.

    The place of a group is the number of larger groups, from a table of sizes, and its place among groups of its
    size; no task holds all groups. Rows without a group are left out.
    """
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes, "groups")
    steps = sizes.groupBy((-F.col("n")).alias("_turn")).agg(F.count(F.lit(1)).alias("_groups"))
    larger = running_totals(with_order_bucket(steps, "_turn"), ["_turn"], ["_groups"])
    larger = larger.select((-F.col("_turn")).alias("n"), (F.col("_groups_upto") - F.col("_groups")).alias("_larger"))
    placed = positions(sizes, group, seed, "_place", ("n",)).join(larger, "n").withColumn("_place", F.col("_place") + F.col("_larger"))
    turn = F.col("_place") % (2 * k)
    return placed.select(group, "n", F.least(turn, 2 * k - 1 - turn).cast("int").alias("fold"))


#: A cut is sought among at most this many rows at the end.
NEAR_CUT = 4096


def smallest_cut(df: DataFrame, key: str, n: int, seed: int) -> str | None:
    """The md5 of the n-th row in md5 order; None if there are fewer rows.

    Rows are counted by the next three hex digits (4096 numbers for the driver), and only those of the bucket that
    holds the n-th row are looked at again, until few are left. No rows are sorted or sent anywhere.
    """
    digests, prefix, left = df.select(uniform_hash(key, seed).alias("d")), "", n
    while n > 0:
        part = digests.where(F.col("d").startswith(prefix)) if prefix else digests
        width = 3 if len(prefix) < 30 else 2
        counts = part.groupBy(F.substring("d", len(prefix) + 1, width).alias("p")).count().collect()
        for bucket, size in sorted(counts):
            if left <= size:
                break
            left -= size
        else:
            return None
        prefix += bucket
        if len(prefix) == 32:
            return prefix
        if size <= NEAR_CUT:
            rows = sorted(r[0] for r in digests.where(F.col("d").startswith(prefix)).collect())
            return rows[left - 1]
    return ""


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer): those with the smallest md5 (rows that share a key stay together)."""
    cut = smallest_cut(df, key, n, seed)
    return df if cut is None else df.where(uniform_hash(key, seed) <= F.lit(cut))
