"""Category encoders and numeric preparation as fit/transform pairs.

``fit`` runs the aggregation and keeps a per-category table; ``transform`` is a static plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.expr import uniform_hash
from rowloom.operators.joins import lookup
from rowloom.operators.ordered import dense_codes, medians, running_totals
from rowloom.operators.schema import categories
from rowloom.session import is_planned_small


def fitted(table: DataFrame) -> DataFrame:
    """Materialise, so that later steps see the true size and do not recompute the input."""
    table = table.persist()
    table.count()
    return table


def _by_column(df: DataFrame, cols: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """(keep..., _name, _value): one row per category cell, combined map-side by the caller."""
    cells = F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("string").alias("_value")) for c in cols])
    return df.select(*keep, F.inline(cells))


class OneHot:
    """Category columns -> 0/1 columns ``COL_value`` and ``COL_nan``."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> OneHot:
        self.values = categories(df, self.cols)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [F.col(c) for c in df.columns if c not in self.cols]
        hot = [
            (F.col(c).isNull() if v is None else F.col(c).eqNullSafe(F.lit(v)))
            .cast("int")
            .alias(f"{c}_{'nan' if v is None else v}")
            for c in self.cols
            for v in self.values[c]
        ]
        return df.select(*kept, *hot)


class _Coded:
    """Shared by the integer encoders: a table (value, code) and its join."""

    col: str
    out: str
    table: DataFrame

    def _join(self, df: DataFrame, value: Column) -> DataFrame:
        keyed = df.withColumn("_value", value)
        return lookup(keyed, self.table, ["_value"]).drop("_value")


class Factorize(_Coded):
    """Integer code by first appearance in id order; missing is -1."""

    def __init__(self, col: str, key: str, out: str | None = None):
        self.col, self.key, self.out = col, key, out or f"{col}_CODE"

    def fit(self, df: DataFrame) -> Factorize:
        first = (
            df.where(F.col(self.col).isNotNull())
            .groupBy(F.col(self.col).alias("_value"))
            .agg(F.min(self.key).alias("_first"))
        )
        self.table = fitted(dense_codes(first, "_first", self.out).select("_value", self.out))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self._join(df, F.col(self.col)).withColumn(self.out, F.coalesce(self.out, F.lit(-1)))


class LabelCode(_Coded):
    """Integer code by text order over labelled and unlabelled rows; missing is the text ``nan``."""

    def __init__(self, col: str, out: str | None = None, missing: str = "nan"):
        self.col, self.out, self.missing = col, out or f"{col}_LABEL", missing

    def _text(self) -> Column:
        return F.coalesce(F.col(self.col).cast("string"), F.lit(self.missing))

    def fit(self, df: DataFrame) -> LabelCode:
        values = df.select(self._text().alias("_value")).distinct()
        self.table = fitted(dense_codes(values, "_value", self.out))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self._join(df, self._text())


class Frequency:
    """Row count ``COL_FREQ`` and share ``COL_FREQ_NORM`` of each category; missing is a category."""

    def __init__(self, cols: Sequence[str], missing: str = "__nan__"):
        self.cols, self.missing = list(cols), missing

    def _text(self, c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(self.missing))

    def fit(self, df: DataFrame) -> Frequency:
        filled = df.select(*[self._text(c).alias(c) for c in self.cols])
        counted = _by_column(filled, self.cols).groupBy("_name", "_value").agg(F.count(F.lit(1)).alias("_n"))
        total = df.select(F.count(F.lit(1))).scalar()
        self.table = fitted(counted.withColumn("_share", F.col("_n") / total))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            stats = self.table.where(F.col("_name") == c).select(
                "_value", F.col("_n").alias(f"{c}_FREQ"), F.col("_share").alias(f"{c}_FREQ_NORM")
            )
            df = lookup(df.withColumn("_value", self._text(c)), stats, ["_value"]).drop("_value")
        return df


class GroupStats:
    """Mean, median and deviation of numeric columns within categories, and each row's
    difference and ratio to the mean: ``GB_<cat>_<num>_MEAN|MEDIAN|STD|DIFF|RATIO``."""

    def __init__(self, cats: Sequence[str], nums: Sequence[str], eps: float = 1e-6):
        self.cats, self.nums, self.eps = list(cats), list(nums), eps

    def fit(self, df: DataFrame) -> GroupStats:
        # Several passes over a few narrow columns follow.
        narrow = fitted(df.select(*self.cats, *self.nums))
        long = _by_column(narrow, self.cats, self.nums).where(F.col("_value").isNotNull())
        moments = long.groupBy("_name", "_value").agg(
            *[F.avg(n).alias(f"{n}_mean") for n in self.nums],
            *[F.stddev_samp(n).alias(f"{n}_std") for n in self.nums],
        )
        middle = medians(long, self.nums, ["_name", "_value"])
        self.table = fitted(moments.join(middle, ["_name", "_value"], "left"))
        narrow.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cats:
            own = self.table.where(F.col("_name") == c).drop("_name")
            joined = lookup(df.withColumn("_value", F.col(c).cast("string")), own, ["_value"])
            added = {}
            for n in self.nums:
                mean = F.col(f"{n}_mean")
                added[f"GB_{c}_{n}_MEAN"] = mean
                added[f"GB_{c}_{n}_MEDIAN"] = F.col(f"{n}_median")
                added[f"GB_{c}_{n}_STD"] = F.col(f"{n}_std")
                added[f"GB_{c}_{n}_DIFF"] = F.col(n) - mean
                added[f"GB_{c}_{n}_RATIO"] = F.try_divide(F.col(n), mean + F.lit(self.eps))
            df = joined.select(*df.columns, *[v.alias(k) for k, v in added.items()])
        return df


class TargetMean:
    """Smoothed out-of-fold mean of the label per category, ``COL_TE``.

    A labelled row sees the other folds, an unlabelled row all labelled rows. Categories with
    fewer than ``min_rows`` rows in view, unseen and missing ones get the overall mean.
    """

    def __init__(
        self, cols: Sequence[str], label: str, fold: str = "fold", smoothing: float = 40.0, min_rows: int = 80
    ):
        self.cols, self.label, self.fold = list(cols), label, fold
        self.smoothing, self.min_rows = smoothing, min_rows

    def fit(self, df: DataFrame) -> TargetMean:
        train = df.where(F.col(self.label).isNotNull())
        self.overall = train.agg(F.avg(self.label)).first()[0]
        tallied = (
            _by_column(train, self.cols, [F.col(self.fold).alias("_fold"), F.col(self.label).alias("_y")])
            .where(F.col("_value").isNotNull())
            .groupBy("_name", "_value", "_fold")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").cast("double").alias("s"))
        )
        # At most one entry per fold is collected, plus one that leaves nothing out.
        own = tallied.groupBy("_name", "_value").agg(
            F.sum("n").alias("_n"), F.sum("s").alias("_s"), F.collect_list(F.struct("_fold", "n", "s")).alias("_own")
        )
        nothing = F.array(F.struct(F.lit(-1).alias("_fold"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s")))
        views = own.select("_name", "_value", "_n", "_s", F.inline(F.concat("_own", nothing)))
        n, s = F.col("_n") - F.col("n"), F.col("_s") - F.col("s")
        smooth = (s + F.lit(float(self.smoothing)) * F.lit(self.overall)) / (n + F.lit(float(self.smoothing)))
        self.table = fitted(
            views.where(n >= self.min_rows).select("_name", "_value", "_fold", smooth.alias("_te"))
        )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            own = self.table.where(F.col("_name") == c).select("_value", "_fold", F.col("_te").alias(f"{c}_TE"))
            keyed = df.withColumn("_value", F.col(c).cast("string")).withColumn(
                "_fold", F.coalesce(F.col(self.fold), F.lit(-1))
            )
            df = (
                lookup(keyed, own, ["_value", "_fold"])
                .drop("_value", "_fold")
                .withColumn(f"{c}_TE", F.coalesce(f"{c}_TE", F.lit(self.overall)))
            )
        return df


#: Stands for a missing category where categories are compared.
_NO_VALUE = "\0"


def ordered_means(
    df: DataFrame, key: str, cols: Sequence[str], label: str, fold: str | None = None, k: int = 0, weight: float = 1.0, seed: int = 42
) -> DataFrame:
    """(key, COL_OTS...): the mean label of a row's category over the labelled rows before it in md5 order, drawn
    towards the overall mean by ``weight`` rows, so that no row sees its own label. Unlabelled rows see all
    labelled rows of their category. Missing is a category of its own.

    With ``fold``, COL_OTS0 ... COL_OTS<k-1> for the models of k folds: column f knows only the rows outside fold f,
    and a row of fold f sees all of them, like an unlabelled one. ``key`` is unique.

    One exchange for all columns: (column, value) cells are summed up along md5 buckets, so a frequent category is
    never ordered in one task.
    """
    views = list(range(k)) if fold else [None]
    inside = {f: F.lit(True) if f is None else ~F.coalesce(F.col("_fold") == f, F.lit(False)) for f in views}
    named = {f: "" if f is None else str(f) for f in views}
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(_NO_VALUE))
    base = df.select(key, F.col(label).cast("double").alias("_y"), (F.col(fold) if fold else F.lit(0)).alias("_fold"), *[value(c).alias(c) for c in cols])
    train = base.where(F.col("_y").isNotNull()).withColumn("_digest", uniform_hash(key, seed))
    means = train.agg(*[F.avg(F.when(inside[f], F.col("_y"))).alias(f"m{named[f]}") for f in views]).first()
    prior = {f: means[f"m{named[f]}"] for f in views}
    numbers = [m for f in views for m in (f"_n{named[f]}", f"_s{named[f]}")]
    cells = _by_column(train, cols, [key, "_y", "_fold", "_digest"])
    for f in views:
        cells = cells.withColumn(f"_n{named[f]}", inside[f].cast("double")).withColumn(f"_s{named[f]}", F.when(inside[f], F.col("_y")).otherwise(0.0))
    if not is_planned_small(cells):
        cells = cells.withColumn("_bucket", F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int"))
    placed = running_totals(cells, ["_digest", key], numbers, ["_name", "_value"])

    def mean(f, n, s):
        p = F.lit(prior[f])
        return (s + F.lit(float(weight)) * p) / (n + F.lit(float(weight)))

    seen = {}
    for f in views:
        n, s = f"_n{named[f]}", f"_s{named[f]}"
        before = mean(f, F.col(f"{n}_upto") - F.col(n), F.col(f"{s}_upto") - F.col(s))
        seen[f] = F.when(F.col(n) > 0, before).otherwise(mean(f, F.col(f"{n}_total"), F.col(f"{s}_total")))
    wide = [F.max(F.when(F.col("_name") == c, seen[f])).alias(f"{c}_OTS{named[f]}") for c in cols for f in views]
    own = placed.groupBy(key).agg(*wide)
    totals = cells.groupBy("_name", "_value").agg(*[F.sum(x).alias(x) for x in numbers])
    totals = fitted(totals.select("_name", "_value", *[mean(f, F.col(f"_n{named[f]}"), F.col(f"_s{named[f]}")).alias(f"_all{named[f]}") for f in views]))
    rest = base.where(F.col("_y").isNull()).select(key, *cols)
    for c in cols:
        of_c = totals.where(F.col("_name") == c).drop("_name")
        rest = lookup(rest.withColumn("_value", F.col(c)), of_c, ["_value"]).drop("_value")
        rest = rest.withColumns({f"{c}_OTS{named[f]}": F.coalesce(f"_all{named[f]}", F.lit(prior[f]).cast("double")) for f in views}).drop(*[f"_all{named[f]}" for f in views])
    return own.unionByName(rest.select(*own.columns))


class Impute:
    """Missing -> a constant, or the exact median over all rows."""

    def __init__(self, cols: Sequence[str], fill="median"):
        self.cols, self.fill = list(cols), fill

    def fit(self, df: DataFrame) -> Impute:
        if self.fill == "median":
            narrow = fitted(df.select(*self.cols))
            row = medians(narrow, self.cols).first()
            narrow.unpersist()
            self.values: Mapping = {c: row[f"{c}_median"] for c in self.cols}
        else:
            self.values = {c: self.fill for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items()})


class Standardize:
    """(x - mean) / population deviation; a constant column becomes 0."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> Standardize:
        row = df.agg(
            *[F.avg(c).alias(f"m_{c}") for c in self.cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in self.cols]
        ).first()
        self.moments = {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.moments.items()})


def fit_transform(df: DataFrame, *steps) -> DataFrame:
    return reduce(lambda out, step: step.fit(out).transform(out), steps, df)
