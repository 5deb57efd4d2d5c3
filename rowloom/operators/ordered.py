"""Exact global order statistics without a single-task window.

Rows are put into buckets that follow the sort order. Only bucket totals (a bounded number of
rows) are summed in one place; everything else is a window inside one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.session import is_planned_small, shared_small

#: Upper bound of order buckets, hence of the rows any single prefix sum sees per group.
MAX_BUCKETS = 4096
TEXT_BUCKETS = 256


def bucket_count(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(MAX_BUCKETS, 2 * partitions))


def _splits(bounds: Sequence[float]) -> list[float]:
    return [float("-inf"), *sorted(set(bounds)), float("inf")]


def with_numeric_buckets(df: DataFrame, cols: Sequence[str], n: int | None = None) -> DataFrame:
    """Add ``_bucket_<col>`` per column: quantile buckets, non-decreasing in the value.

    The bounds come from one sketch pass over all columns and only steer balance.
    """
    n = n or bucket_count(df)
    probabilities = [i / n for i in range(1, n)]
    bounds = df.approxQuantile(list(cols), probabilities, 0.5 / n)
    plain = {c: f"_bucket_{c}" for c in cols}
    wide = {c: b for c, b in zip(cols, bounds) if len(_splits(b)) > 2}
    out = df
    if wide:
        out = Bucketizer(
            splitsArray=[_splits(b) for b in wide.values()],
            inputCols=list(wide),
            outputCols=[plain[c] for c in wide],
            handleInvalid="keep",
        ).transform(df)
    for c in cols:
        out = out.withColumn(plain[c], F.col(plain[c]).cast("int") if c in wide else F.lit(0))
    return out


def text_bucket(distinct_values: DataFrame, c: str, n: int = TEXT_BUCKETS) -> Column:
    """Bucket of a text column, following text order.

    ``distinct_values`` has one row per value; the bounds are a hash sample of bounded size.
    """
    sample = distinct_values.select(c).where(F.col(c).isNotNull()).orderBy(F.md5(F.col(c))).limit(16 * n)
    ordered = sorted(row[0] for row in sample.collect())
    bounds = ordered[:: max(1, len(ordered) // n)]
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b) for b in bounds])
    return F.size(F.filter(array, lambda b: b <= F.col(c)))


def with_order_bucket(df: DataFrame, order: str) -> DataFrame:
    """Add ``_bucket`` unless Catalyst already knows ``df`` to be small.

    For a text ``order`` column, ``df`` has one row per value.
    """
    if is_planned_small(df):
        return df
    if isinstance(df.schema[order].dataType, T.StringType):
        return df.withColumn("_bucket", text_bucket(df, order))
    return with_numeric_buckets(df, [order]).withColumnRenamed(f"_bucket_{order}", "_bucket")


def bucket_key(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == "_bucket"]


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    measures: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums ``<m>_upto`` and totals ``<m>_total`` per group ``by``.

    A large ``df`` carries ``_bucket`` (see with_order_bucket), consistent with ``order``; there
    are no ties of ``order`` inside a group.
    """
    by = list(by)
    bucket = bucket_key(df)
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = Window.unboundedPreceding, 0
    if not bucket:
        upto = whole.orderBy(*order).rowsBetween(*running)
        return df.select(
            *df.columns,
            *[F.sum(m).over(upto).alias(f"{m}_upto") for m in measures],
            *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
        )
    totals = df.groupBy(*by, "_bucket").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    # At most one row per bucket in each group of ``by``: a bounded window.
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_t_{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(*running)
    joined = df.join(offsets, [*by, "_bucket"])
    return joined.select(
        *[c for c in df.columns if c != "_bucket"],
        *[(F.col(f"_o_{m}") + F.sum(m).over(inside)).alias(f"{m}_upto") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def dense_codes(values: DataFrame, order: str, name: str) -> DataFrame:
    """Position 0, 1, 2, ... of each row of a table of distinct ``order`` values."""
    counted = with_order_bucket(values, order).withColumn("_one", F.lit(1))
    return (
        running_totals(counted, [order], ["_one"])
        .withColumn(name, (F.col("_one_upto") - 1).cast("long"))
        .drop("_one", "_one_upto", "_one_total")
    )


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact medians of ``cols`` per group as ``<col>_median``; NULLs are skipped.

    Selection instead of sorting: bucket counts locate the middle bucket, and only the rows of
    that bucket are grouped and ordered.
    """
    by = list(by)
    if is_planned_small(df.select(*by, *cols)):
        return df.groupBy(*by).agg(*[F.median(c).alias(f"{c}_median") for c in cols])
    narrow = with_numeric_buckets(df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]), cols)
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("_var"), F.col(c).alias("_x"), F.col(f"_bucket_{c}").alias("_bucket"))
            for i, c in enumerate(cols)
        ]
    )
    long = narrow.select(*by, F.inline(cells)).where(F.col("_x").isNotNull())
    group = [*by, "_var"]
    counts = long.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    located = counts.select(
        *group,
        "_bucket",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
        F.sum("_n").over(upto).alias("_upto"),
        F.floor((F.sum("_n").over(whole) + 1) / 2).alias("_lo"),
        F.floor((F.sum("_n").over(whole) + 2) / 2).alias("_hi"),
    ).where(_covers("_lo") | _covers("_hi"))
    targets, _ = shared_small(located.drop("_upto"))
    middle = long.join(targets, [*group, "_bucket"])
    tallied = middle.groupBy(*group, "_bucket", "_before", "_lo", "_hi", "_x").agg(
        F.count(F.lit(1)).alias("_n")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    placed = tallied.withColumn("_upto", F.col("_before") + F.sum("_n").over(inside)).withColumn(
        "_before", F.col("_upto") - F.col("_n")
    )
    halves = placed.groupBy(*group).agg(
        ((F.max(F.when(_covers("_lo"), F.col("_x"))) + F.max(F.when(_covers("_hi"), F.col("_x")))) / 2).alias(
            "_median"
        )
    )
    return halves.groupBy(*by).agg(
        *[F.max(F.when(F.col("_var") == i, F.col("_median"))).alias(f"{c}_median") for i, c in enumerate(cols)]
    )


def _covers(position: str) -> Column:
    return (F.col("_before") < F.col(position)) & (F.col(position) <= F.col("_upto"))
