"""Rollups of child rows to one row per entity.

All slices of one table (recency windows, status slices, ...) are conditions inside a single
``groupBy``; only slices by position (last k, first k) need a second branch, in which Spark
keeps at most k rows per entity and partition before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators.joins import hot_keys
from rowloom.operators.schema import clean_name
from rowloom.session import is_planned_small

NUM_STATS = ("mean", "max", "min", "sum", "var")
CAT_STATS = ("mean", "sum")


@dataclass(frozen=True)
class Slice:
    """A subset of each entity's rows, named in the output columns.

    ``where`` is a SQL predicate. ``last_k``/``first_k`` take rows by ``order`` (time column
    first, then tie-breaks); rows without a time come last either way.
    """

    name: str = ""
    where: str | None = None
    last_k: int | None = None
    first_k: int | None = None
    order: tuple[str, ...] = ()
    num: Mapping[str, Sequence[str]] | None = None
    shares: bool = True
    count: bool = False

    @property
    def ranking(self) -> tuple | None:
        if self.last_k or self.first_k:
            return (self.order, bool(self.last_k))
        return None


@dataclass(frozen=True)
class Decay:
    """Mean weighted by ``exp(rate * time)``: ``time`` is a negative offset."""

    cols: Sequence[str]
    time: str
    rate: float = 0.002


@dataclass(frozen=True)
class Trend:
    """Least-squares slope over ``time`` for entities with ``min_rows`` complete rows."""

    cols: Sequence[str]
    time: str
    min_rows: int = 3


@dataclass(frozen=True)
class Distinct:
    """Number of distinct values of a column among the rows where a condition holds, as an extra column."""

    column: str
    where: str | None = None


@dataclass
class _Aggregate:
    """An output column: SQL text, or a Column given by the caller. Text keeps the building of
    plans with thousands of aggregates cheap. ``distinct``: the condition (or "") of a count of the source's
    distinct values, which goes its own way. ``zero``: it is 0, and not NULL, over no rows."""

    name: str
    value: Column | str
    source: str = ""
    distinct: str | None = None
    zero: bool = False

    def column(self) -> Column:
        if isinstance(self.value, str):
            return F.expr(f"{self.value} AS `{self.name}`")
        return self.value.alias(self.name)


def _quoted(c: str) -> str:
    return f"`{c}`"


def _literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def stat_sql(how: str, x: str, cond: str | None = None) -> str:
    """One aggregate over the rows where ``cond`` holds.

    A sum over present rows without a value is 0; over no rows it is NULL, and so is the size.
    """
    v = x if cond is None else f"CASE WHEN {cond} THEN {x} END"
    plain = {
        "mean": "avg({v})",
        "max": "max({v})",
        "min": "min({v})",
        "var": "var_samp({v})",
        "std": "stddev_samp({v})",
        "count": "count({v})",
        "nunique": "count(DISTINCT {v})",
        "any": "cast(coalesce(max({v}) > 0, false) AS int)",
    }
    if how in plain:
        return plain[how].format(v=v)
    if how == "sum":
        total = f"coalesce(sum({v}), 0)"
        return total if cond is None else f"CASE WHEN count_if({cond}) > 0 THEN {total} END"
    if how == "size":
        return "count(1)" if cond is None else f"nullif(count_if({cond}), 0)"
    raise ValueError(f"unknown statistic {how!r}")


def stat(how: str, column: str, where: str | None = None) -> Column:
    return F.expr(stat_sql(how, _quoted(column), where))


def decayed_mean(value: str, time: str, rate: float) -> str:
    v, t = _quoted(value), _quoted(time)
    w = f"exp({float(rate)!r}D * {t})"
    complete = f"{v} IS NOT NULL AND {t} IS NOT NULL"
    return f"try_divide(sum(CASE WHEN {complete} THEN {v} * {w} END), sum(CASE WHEN {complete} THEN {w} END))"


def trend_slope(value: str, time: str, min_rows: int = 3, ridge: float = 1e-8) -> str:
    complete = f"{_quoted(value)} IS NOT NULL AND {_quoted(time)} IS NOT NULL"
    t = f"CASE WHEN {complete} THEN cast({_quoted(time)} AS double) END"
    v = f"CASE WHEN {complete} THEN cast({_quoted(value)} AS double) END"
    n = f"count_if({complete})"
    return f"CASE WHEN {n} >= {min_rows} THEN covar_pop({t}, {v}) * {n} / (var_pop({t}) * {n} + {ridge!r}D) END"


def _name(*parts: str) -> str:
    return clean_name("_".join(p for p in parts if p))


def _share_columns(prefix, part, cond, categories, binary, stats) -> list[_Aggregate]:
    out = []
    for c, values in categories.items():
        for v in values:
            hit = f"{_quoted(c)} IS NULL" if v is None else f"{_quoted(c)} <=> {_literal(v)}"
            label = "nan" if v is None else str(v)
            for how in stats:
                out.append(
                    _Aggregate(_name(prefix, part, c, label, how), stat_sql(how, f"cast({hit} AS int)", cond), c)
                )
    for c in binary:
        out += [_Aggregate(_name(prefix, part, c, how), stat_sql(how, _quoted(c), cond), c) for how in stats]
    return out


def _slice_columns(prefix, s: Slice, cond, num, num_stats, categories, binary, cat_stats) -> list[_Aggregate]:
    wanted = s.num if s.num is not None else {c: num_stats for c in num}
    out = [
        _Aggregate(_name(prefix, s.name, c, how), stat_sql(how, _quoted(c), cond), c, (cond or "") if how == "nunique" else None, how in ("count", "any"))
        for c, stats in wanted.items()
        for how in stats
    ]
    if s.shares:
        out += _share_columns(prefix, s.name, cond, categories, binary, cat_stats)
    if s.count:
        out.append(_Aggregate(_name(prefix, s.name, "COUNT"), stat_sql("size", "1", cond)))
    return out


def _aggregate(df: DataFrame, key: str, columns: Sequence[_Aggregate]) -> DataFrame:
    """One groupBy, so one scan and one shuffle, however many columns; numbers of distinct values are counted
    beside it, where Spark would otherwise copy every row once per column."""
    plain = [c for c in columns if c.distinct is None]
    out = df.groupBy(key).agg(*[c.column() for c in plain]) if plain else df.select(key).distinct()
    counted = [c for c in columns if c.distinct is not None]
    if not counted:
        return out
    numbers = distinct_counts(df, key, [(c.name, c.source, c.distinct) for c in counted])
    joined = out.join(numbers, key, "left").na.fill(0, [c.name for c in counted])
    return joined.select(key, *[_quoted(c.name) for c in columns])


def distinct_counts(df: DataFrame, key: str, wanted: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(key, name...): how many distinct values a column has among the rows where a condition holds ("" for all).
    ``wanted`` rows are (name, column, condition).

    Long form: (key, column, value) with one bit per condition that some row with the value fulfils, combined
    before the shuffle; then one count per name. Entities without any value are left out.
    """
    cols = list(dict.fromkeys(c for _, c, _ in wanted))
    conditions = {c: list(dict.fromkeys(w for _, x, w in wanted if x == c)) for c in cols}
    cells = []
    for i, c in enumerate(cols):
        value = _quoted(c)
        if df.schema[c].dataType.typeName() in ("double", "float"):
            value = f"({value} + 0.0D)"  # one zero
        bits = [f"if({w or 'true'}, {1 << (b % 62)}L, 0L)" for b, w in enumerate(conditions[c])]
        for first in range(0, len(bits), 62):
            mask = " + ".join(f"coalesce({b}, 0L)" for b in bits[first : first + 62])
            cells.append(f"struct({i} AS _var, {first // 62} AS _word, cast({value} AS string) AS _value, {mask} AS _mask)")
    long = df.select(key, F.expr(f"inline(array({', '.join(cells)}))")).where("_value IS NOT NULL AND _mask <> 0")
    present = long.groupBy(key, "_var", "_word", "_value").agg(F.expr("bit_or(_mask) AS _mask"))
    names = []
    for name, c, w in wanted:
        b = conditions[c].index(w)
        names.append(F.expr(f"count_if(_var = {cols.index(c)} AND _word = {b // 62} AND _mask & {1 << (b % 62)}L <> 0) AS `{name}`"))
    return present.groupBy(key).agg(*names)


def ranked(df: DataFrame, key: str, order: Sequence[str], newest_first: bool, k: int) -> DataFrame:
    """The first k rows of each entity with their position ``_rn``."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(*_turn(order, newest_first)))
    return df.withColumn("_rn", position).where(F.col("_rn") <= k)


#: An entity with fewer rows is no burden for one task.
HOT_ROWS = 200_000


def _hot_entities(rows: DataFrame, key: str) -> list:
    """At most HOT_SHARE entities that hold a large part of all rows, by a sample; no result depends on them."""
    return [] if is_planned_small(rows) else [r[0] for r in hot_keys(rows, [key], least=HOT_ROWS).collect()]


def _turn(order: Sequence[str], newest_first: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if newest_first else F.col(c).asc_nulls_last() for c in order]


def _sliced(rows: DataFrame, key: str, columns: Sequence[tuple[Slice, Sequence[_Aggregate]]]) -> DataFrame:
    """The unconditional aggregates of each slice. The rows of an entity meet in one shuffle, get their places, and go
    to the slices they are in; an aggregate then sees the rows of its slice only, and one row per slice is kept."""
    rankings = list(dict.fromkeys(s.ranking for s, _ in columns if s.ranking))
    placed = rows
    for i, (order, newest) in enumerate(rankings):
        placed = placed.withColumn(f"_rn{i}", F.row_number().over(Window.partitionBy(key).orderBy(*_turn(order, newest))))
    within = [f"_rn{rankings.index(s.ranking)} <= {s.last_k or s.first_k}" if s.ranking else s.where or "true" for s, _ in columns]
    hits = ", ".join(f"if({w}, {i}, -1)" for i, w in enumerate(within))
    long = placed.withColumn("_slice", F.explode(F.expr(f"array_remove(array({hits}), -1)")))
    cells = {v: f"_a{i}" for i, v in enumerate(dict.fromkeys(a.value for _, part in columns for a in part))}
    graded = long.groupBy(key, "_slice").agg(*[F.expr(f"{value} AS {cell}") for value, cell in cells.items()])
    held = graded.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_slice", F.struct(*cells.values())))).alias("_held"))
    shown = []
    for i, (_, part) in enumerate(columns):
        for a in part:
            x = f"_held[{i}].{cells[a.value]}"
            shown.append(F.expr(f"coalesce({x}, 0) AS `{a.name}`" if a.zero else f"{x} AS `{a.name}`"))
    return held.select(key, *shown)


def rollup(
    df: DataFrame,
    key: str,
    prefix: str,
    num: Sequence[str] = (),
    categories: Mapping[str, Sequence] | None = None,
    binary: Sequence[str] = (),
    slices: Sequence[Slice] = (Slice(),),
    num_stats: Sequence[str] = NUM_STATS,
    cat_stats: Sequence[str] = CAT_STATS,
    decays: Sequence[Decay] = (),
    trends: Sequence[Trend] = (),
    extra: Mapping[str, Column | str | Distinct] | None = None,
    together: bool = False,
) -> DataFrame:
    """Roll child rows up to one row per ``key`` (rows without a key are left out).

    ``categories`` maps a category column to its fitted values (None among them asks for the
    share of missing values). Output names are ``PREFIX_SLICE_COLUMN_STAT``.

    ``together``: slices by position and by condition share one shuffle of the rows. For many slices of many columns,
    whose partial aggregates are wider than the rows they stand for. ``df`` is read twice, and once more for hot entities.
    """
    categories = categories or {}
    rows = df.where(F.col(key).isNotNull())

    def slice_columns(s: Slice, cond: str | None) -> list[_Aggregate]:
        return _slice_columns(prefix, s, cond, num, num_stats, categories, binary, cat_stats)

    fused: list[_Aggregate] = []
    by_rank: dict[tuple, list[Slice]] = {}
    for s in slices:
        if s.ranking:
            by_rank.setdefault(s.ranking, []).append(s)
            continue
        fused += slice_columns(s, s.where)
    for d in decays:
        fused += [_Aggregate(_name(prefix, c, "TWMEAN"), decayed_mean(c, d.time, d.rate), c) for c in d.cols]
    for t in trends:
        fused += [_Aggregate(_name(prefix, c, "TREND"), trend_slope(c, t.time, t.min_rows), c) for c in t.cols]
    for name, value in (extra or {}).items():
        counted = isinstance(value, Distinct)
        fused.append(_Aggregate(name, "", value.column, value.where or "") if counted else _Aggregate(name, value))

    if together and by_rank and not (decays or trends or extra):
        ordered = [s for s in slices if not s.ranking] + [s for group in by_rank.values() for s in group]
        columns = [(s, slice_columns(s, None)) for s in ordered]
        if not any(a.distinct is not None for _, part in columns for a in part):
            hot = _hot_entities(rows, key)
            if not hot:
                return _sliced(rows, key, columns)
            # Rows of a hot entity are aggregated where they lie, and only few of a map task are ranked.
            is_hot = F.col(key).isin(hot)
            apart = _conditional(rows.where(is_hot), key, fused, by_rank, slice_columns)
            return _sliced(rows.where(~is_hot), key, columns).unionByName(apart)
    return _conditional(rows, key, fused, by_rank, slice_columns)


def _conditional(rows: DataFrame, key: str, fused: Sequence[_Aggregate], by_rank: Mapping[tuple, Sequence[Slice]], slice_columns) -> DataFrame:
    """All slices as conditions inside one aggregate, those by position in one more per order."""
    out = _aggregate(rows, key, fused) if fused or not by_rank else None
    for (order, newest), group in by_rank.items():
        top = ranked(rows, key, order, newest, max(s.last_k or s.first_k for s in group))
        columns: list[_Aggregate] = []
        for s in group:
            columns += slice_columns(s, f"_rn <= {s.last_k or s.first_k}")
        piece = _aggregate(top, key, columns)
        out = piece if out is None else out.join(piece, key, "left")
    return out


def share_rows(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, column, value, share): the shares of all values of category columns in long form, for
    columns with too many values to become output columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counted = df.where(F.col(key).isNotNull()).select(key, F.inline(cells)).groupBy(key, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.groupBy(key, "column").agg(F.sum("n").alias("rows"))
    return counted.join(rows, [key, "column"]).select(key, "column", "value", (F.col("n") / F.col("rows")).alias("share"))


def latest_values(df: DataFrame, key: str, cols: Sequence[str], order: Sequence[str], prefix: str) -> DataFrame:
    """Newest non-null value of each column, column by column."""
    rows = df.where(F.col(key).isNotNull())
    at = "struct(" + ", ".join(f"`{c}`" for c in order) + ")"
    return rows.groupBy(key).agg(
        *[
            F.expr(f"max_by(`{c}`, {at}) FILTER (WHERE `{c}` IS NOT NULL)").alias(_name(prefix, c))
            for c in cols
        ]
    )


def two_level(
    df: DataFrame,
    key: str,
    subkey: str,
    inner: Mapping[str, tuple[str, str]],
    outer: Sequence[str] = ("mean", "max", "std"),
) -> DataFrame:
    """Per (entity, loan) first, then statistics of the loans per entity.

    ``inner`` maps a name to (column, statistic).
    """
    loans = (
        df.where(F.col(key).isNotNull() & F.col(subkey).isNotNull())
        .groupBy(key, subkey)
        .agg(*[stat(how, c).alias(name) for name, (c, how) in inner.items()])
    )
    return loans.groupBy(key).agg(
        *[stat(how, name).alias(_name(name, how)) for name in inner for how in outer]
    )


def pivot_count(df: DataFrame, key: str, category: str, values: Sequence, prefix: str, counted: str) -> DataFrame:
    """Row counts per category as columns (0 when absent), with min, max and size of ``counted``."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min(counted).alias(_name(prefix, counted, "MIN")),
            F.max(counted).alias(_name(prefix, counted, "MAX")),
            F.count(F.lit(1)).alias(_name(prefix, counted, "SIZE")),
            *[
                F.count_if((F.col(category) == F.lit(v)) & F.col(counted).isNotNull()).alias(
                    _name(prefix, category, str(v))
                )
                for v in values
            ],
        )
    )


def ratio_of(df: DataFrame, pairs: Sequence[tuple[str, str, str]], eps: float = 0) -> DataFrame:
    """Add ``out = numerator / (denominator + eps)`` for each (numerator, denominator, out) present."""
    present = [(n, d, o) for n, d, o in pairs if n in df.columns and d in df.columns]
    return df.select("*", *[E.ratio(n, d, eps).alias(o) for n, d, o in present])
