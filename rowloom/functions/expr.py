"""Null-safe scalar expressions.

Rules shared by all of them: a missing value is NULL (never NaN), a zero denominator gives
NULL, comparisons with NULL give flag 0, and row-wise statistics skip NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if(c: ColumnLike, sentinel) -> Column:
    """Sentinel value -> NULL."""
    return F.nullif(col(c), F.lit(sentinel))


def flag(predicate: Column) -> Column:
    """0/1 flag; an unknown predicate counts as 0."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def sentinel_flag(c: ColumnLike, sentinel) -> Column:
    return flag(col(c) == F.lit(sentinel))


def ratio(numerator: ColumnLike, denominator: ColumnLike, eps: float = 0) -> Column:
    """``a / (b + eps)``, NULL where the denominator is zero."""
    below = col(denominator).cast("double")
    if eps:
        below = below + F.lit(float(eps))
    return F.try_divide(col(numerator).cast("double"), below)


def difference(a: ColumnLike, b: ColumnLike) -> Column:
    return col(a) - col(b)


def product(*cols: ColumnLike) -> Column:
    return reduce(mul, [col(c) for c in cols])


def weighted_sum(weights: dict[str, float]) -> Column:
    return reduce(add, [F.lit(float(w)) * F.col(c) for c, w in weights.items()])


def null_count(cols: Sequence[ColumnLike]) -> Column:
    return reduce(add, [col(c).isNull().cast("int") for c in cols])


def _present(cols: Sequence[ColumnLike]) -> Column:
    return reduce(add, [col(c).isNotNull().cast("int") for c in cols])


def row_sum(cols: Sequence[ColumnLike]) -> Column:
    """Sum over the row; text that is no number, and NULL, count 0. No columns give 0."""
    if not cols:
        return F.lit(0.0)
    return reduce(add, [F.coalesce(col(c).try_cast("double"), F.lit(0.0)) for c in cols])


def row_mean(cols: Sequence[ColumnLike]) -> Column:
    return F.try_divide(row_sum(cols), _present(cols).cast("double"))


def row_std(cols: Sequence[ColumnLike]) -> Column:
    """Sample standard deviation over the row; needs two values."""
    mean, n = row_mean(cols), _present(cols)
    squares = reduce(add, [F.coalesce(F.pow(col(c) - mean, 2), F.lit(0.0)) for c in cols])
    return F.when(n >= 2, F.sqrt(squares / (n - 1)))


def row_min(cols: Sequence[ColumnLike]) -> Column:
    return F.least(*cols) if len(cols) > 1 else col(cols[0])


def row_max(cols: Sequence[ColumnLike]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else col(cols[0])


def row_range(cols: Sequence[ColumnLike]) -> Column:
    return row_max(cols) - row_min(cols)


def bin_right(c: ColumnLike, edges: Sequence[float]) -> Column:
    """Label of the right-closed bin ``(edges[i], edges[i+1]]``; NULL outside."""
    value = col(c)
    steps = F.when(value <= edges[0], F.lit(None))
    for label, upper in enumerate(edges[1:]):
        steps = steps.when(value <= upper, F.lit(label))
    return steps.cast("int")


def log_abs(c: ColumnLike) -> Column:
    return F.log1p(F.abs(col(c)))


def years(c: ColumnLike, per_year: float = -365.25) -> Column:
    """Negative day offset -> years."""
    return col(c) / F.lit(per_year)


def whole_years(c: ColumnLike) -> Column:
    """Truncated age from a negative day offset, missing -> 0."""
    return F.coalesce((-col(c) / F.lit(365.0)).cast("int"), F.lit(0))


def clip_low(c: ColumnLike, low: float = 0) -> Column:
    """``max(c, low)`` that keeps NULL."""
    return F.when(col(c).isNotNull(), F.greatest(col(c), F.lit(low)))


def blank_inf(c: ColumnLike) -> Column:
    """NaN and infinities -> NULL."""
    value = col(c)
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def cross(cols: Sequence[ColumnLike], sep: str = "__", missing: str = "nan") -> Column:
    """Category cross; a missing part is spelled out rather than lost."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit(missing)) for c in cols])


def interest_estimate(annuity: ColumnLike, count: ColumnLike, credit: ColumnLike, eps: float = 0) -> Column:
    """``annuity * n / credit - 1``."""
    return ratio(col(annuity) * col(count), credit, eps) - F.lit(1.0)


def uniform_hash(key: ColumnLike, seed: int) -> Column:
    """Reproducible pseudo-random text per key: any engine with md5 gives the same order."""
    return F.md5(F.concat_ws("-", col(key).cast("string"), F.lit(str(seed))))


def hash_fraction(digest: Column) -> Column:
    """First eight hex digits of a digest as a fraction in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
