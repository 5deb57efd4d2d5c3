"""Operators on column names and types."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most values the list of one column may hold; each becomes output columns.
MAX_CATEGORIES = 10_000

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def clean_name(name: str, upper: bool = True) -> str:
    """Letters, digits and single underscores only."""
    words = [w for w in re.split(r"[^0-9A-Za-z]+", str(name)) if w]
    joined = "_".join(words)
    return joined.upper() if upper else joined


def clean_names(df: DataFrame, upper: bool = True) -> DataFrame:
    """Clean all column names; names that collide get a numeric suffix."""
    taken: set[str] = set()
    names = []
    for c in df.columns:
        base = name = clean_name(c, upper)
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)


def column_classes(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names by type; booleans count as numeric."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)):
            categorical.append(f.name)
    return numeric, categorical


def binary_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Numeric columns whose present values are only 0 and 1, in one pass."""
    cols = list(cols) if cols is not None else column_classes(df)[0]
    if not cols:
        return []
    other = df.agg(*[F.count_if(~F.col(c).cast("double").isin(0.0, 1.0)).alias(c) for c in cols]).first()
    return [c for c in cols if other[c] == 0]


def categories(df: DataFrame, cols: Sequence[str], with_null: bool = True, most: int = MAX_CATEGORIES) -> dict[str, list]:
    """Distinct values per category column, in text order; a column with more than ``most`` values,
    more than a schema can bear, is an error, not a cut (``rollup.share_rows`` has no such bound)."""
    if not cols:
        return {}
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])
    found = df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct()
    found = found.persist()
    sizes = {r["name"]: r["n"] for r in found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = sorted(c for c, n in sizes.items() if n > most)
    if wide:
        found.unpersist()
        raise ValueError(f"more than {most} categories in {wide}; use a coded encoder or share_rows")
    rows = found.collect()
    found.unpersist()
    tail = [None] if with_null else []
    return {c: sorted(r["value"] for r in rows if r["name"] == c) + tail for c in cols}


def narrow(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Integers to the smallest type that holds their range, booleans to tinyint.

    Columns in ``keep`` (ids) become bigint. Floats stay double: sums would change.
    """
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, INTEGRAL) and f.name not in keep]
    limits = (
        df.agg(*[F.min(c).alias(f"lo_{c}") for c in whole], *[F.max(c).alias(f"hi_{c}") for c in whole]).first()
        if whole
        else None
    )

    def target(f: T.StructField) -> str | None:
        if f.name in keep:
            return "bigint"
        if isinstance(f.dataType, T.BooleanType):
            return "tinyint"
        if f.name not in whole:
            return None
        lo, hi = limits[f"lo_{f.name}"], limits[f"hi_{f.name}"]
        if lo is None:
            return None
        for name, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
            if -(2**bits) <= lo and hi < 2**bits:
                return name
        return "bigint"

    types = {f.name: target(f) for f in df.schema.fields}
    return df.select(*[F.col(c).cast(t) if t else F.col(c) for c, t in types.items()])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to double; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the columns both frames have, in the left order."""
    shared = [c for c in left.columns if c in set(right.columns)]
    return left.select(*shared), right.select(*shared)


def constant_columns(df: DataFrame, batch: int = 500) -> list[str]:
    """Columns that are all NULL or hold one value on every row (NULL is a value of its own).

    Minimum, maximum and counts decide it, so no distinct count is needed.
    """
    found: list[str] = []
    for i in range(0, len(df.columns), batch):
        part = df.columns[i : i + batch]
        row = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(c).alias(f"n_{c}") for c in part],
            *[F.min(c).eqNullSafe(F.max(c)).alias(f"one_{c}") for c in part],
        ).first()
        found += [
            c for c in part if row[f"n_{c}"] == 0 or (row[f"n_{c}"] == row["_rows"] and row[f"one_{c}"])
        ]
    return found


def drop_constant(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in constant_columns(df) if c not in set(keep)])
