"""Blends of score columns and searches for blend weights."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowloom.operators.rank import rank_norm
from rowloom.session import dropped_shuffles, row_batches, stored

Weights = Mapping[str, float]


def usable_weights(weights: Weights, present: Sequence[str], renormalize: bool = True) -> dict[str, float]:
    """Weights of the components at hand, scaled to sum 1; empty when none carries weight."""
    kept = {k: float(w) for k, w in weights.items() if k in set(present)}
    total = sum(kept.values())
    if total <= 0:
        return {}
    return {k: w / total for k, w in kept.items()} if renormalize else kept


def mix(weights: Weights) -> Column:
    return reduce(add, [F.col(c) * F.lit(float(w)) for c, w in weights.items()])


def blend(
    df: DataFrame, key: str, weights: Weights, mode: str = "rank", renormalize: bool = True, out: str = "TARGET"
) -> DataFrame | None:
    """(key, out): weighted mean of raw scores or of their fractional ranks; None if no
    component is present."""
    used = usable_weights(weights, df.columns, renormalize)
    if not used:
        return None
    scores = rank_norm(df, key, list(used)) if mode == "rank" else df
    return scores.select(key, mix(used).alias(out))


def candidates(df: DataFrame, key: str, table: Sequence[tuple[str, Weights, str]], anchor: str | None = None):
    """Several blends at once: (candidate, key, TARGET). ``table`` rows are (name, weights, mode).

    With an ``anchor``, candidates without it, or with no other component at hand, are left out.
    """
    usable = []
    for name, weights, mode in table:
        used = usable_weights(weights, df.columns)
        if used and (anchor is None or (anchor in weights and any(c != anchor for c in used))):
            usable.append((name, used, mode))
    if not usable:
        raise ValueError("no blend candidate has its components present")
    to_rank = sorted({c for _, used, mode in usable if mode == "rank" for c in used})
    scores = df
    if to_rank:
        ranks = rank_norm(df, key, to_rank)
        scores = df.join(ranks.select(key, *[F.col(c).alias(f"_rank_{c}") for c in to_rank]), key)
    cells = [
        F.struct(
            F.lit(name).alias("candidate"),
            mix({(f"_rank_{c}" if mode == "rank" else c): w for c, w in used.items()}).alias("TARGET"),
        )
        for name, used, mode in usable
    ]
    return scores.select(key, F.inline(F.array(*cells)))


def pair_grid(steps: int = 21) -> list[tuple[float, ...]]:
    """Two models: (w, 1 - w) in even steps."""
    return [(float(w), float(1.0 - w)) for w in np.linspace(0.0, 1.0, steps)]


def triple_grid(step: float = 0.1) -> list[tuple[float, ...]]:
    """Three models, first weight in steps, the rest split evenly.

    The number of points for the second weight is the truncated quotient, so it can be one
    short of the even simplex grid.
    """
    grid = []
    for first in np.linspace(0.0, 1.0, round(1 / step) + 1):
        rest = 1.0 - first
        for second in np.linspace(0.0, rest, int(rest / step) + 1):
            grid.append((float(first), float(second), float(1.0 - first - second)))
    return grid


def simplex_grid(n: int, parts: int, cap: float = 1.0) -> list[tuple[float, ...]]:
    """All weight vectors in steps of 1/parts that sum to 1 with no weight above ``cap``."""
    limit = int(cap * parts + 1e-9)

    def fill(slots: int, left: int):
        if slots == 1:
            if left <= limit:
                yield (left,)
            return
        for take in range(min(left, limit) + 1):
            for rest in fill(slots - 1, left - take):
                yield (take, *rest)

    return [tuple(w / parts for w in combo) for combo in fill(n, parts)]


#: Rows that place the bounds of score ranges and bins.
BIN_ROWS = 20_000
#: Scores of one range, which a task orders at once; rows that a task orders at once before that.
RANGE_ROWS, HELD_ROWS = 1 << 20, 1 << 19
#: Scores that are on the way at once, over all vectors of a pass; a pass has PASS_VECTORS at least.
PASS_VALUES, PASS_VECTORS = 1 << 25, 8


def _keys(scores: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the scores, in their place; both zeros are one, and NaN, as in Spark, is one and
    the largest."""
    scores += 0.0
    missing = np.isnan(scores)
    if missing.any():
        scores[missing] = np.nan
    keys = scores.view(np.int64)
    if keys.min(initial=0) < 0:
        keys[keys < 0] ^= np.int64((1 << 63) - 1)
    return keys


def _packed(steps: np.ndarray) -> bytes:
    """Steps between ascending keys: their low halves, then the high halves in as few bytes as these need."""
    high = steps >> np.uint64(32)
    top = int(high.max(initial=0))
    return steps.astype(np.uint32).tobytes() + high.astype("u1" if top < 1 << 8 else "u2" if top < 1 << 16 else "u4").tobytes()


def _unpacked(first: int, n: int, packed: bytes) -> np.ndarray:
    steps = np.empty(n, np.uint64)
    steps[0] = np.array(first, np.int64).view(np.uint64)
    if n > 1:
        high = np.frombuffer(packed, f"u{len(packed) // (n - 1) - 4}", offset=4 * (n - 1))
        steps[1:] = np.frombuffer(packed, np.uint32, n - 1) | high.astype(np.uint64) << np.uint64(32)
    return np.cumsum(steps, dtype=np.uint64).view(np.int64)


def _runs(keys: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int, int, bytes, bytes | None]]:
    """(range, first key, number, packed, counts) of the sorted keys in each range; counts only if many keys are equal,
    so a value that many rows share travels once."""
    steps = np.diff(keys.view(np.uint64))
    ends = [0, *np.searchsorted(keys, cuts, "left").tolist(), len(keys)]
    for at, (a, b) in enumerate(zip(ends, ends[1:])):
        if a == b:
            continue
        inside, n, counts = steps[a : b - 1], b - a, None
        if 2 * np.count_nonzero(inside) + 2 < n:
            new = np.flatnonzero(np.append(True, inside != 0))
            counts, inside, n = np.diff(np.append(new, n)).tobytes(), inside[new[1:] - 1], len(new)
        yield at, int(keys[a]), n, _packed(inside), counts


def _pairs(keys: Sequence[np.ndarray], labels: Sequence[int], counts: Sequence[np.ndarray | None]) -> tuple[int, int, float]:
    """Positives, negatives, and the pairs of both in the right order, ties counted half."""
    low, high = min(int(k[0]) for k in keys), max(int(k[-1]) for k in keys)
    if all(c is None for c in counts) and set(labels) <= {0, 1} and high - low < 1 << 62:
        tagged = np.sort(np.concatenate([(k - low) << 1 | y for k, y in zip(keys, labels)]))
        y = tagged & 1
        n_pos = int(y.sum())
        upto = np.cumsum(1 - y)  # negatives come first among ties
        tagged >>= 1
        same = tagged[1:] == tagged[:-1]
        tied = 0
        if same.any():
            starts = np.flatnonzero(np.append(True, ~same))
            pos = np.add.reduceat(y, starts)
            tied = int(np.dot(pos, np.diff(np.append(starts, len(y))) - pos))
        return n_pos, len(y) - n_pos, int(np.dot(upto, y)) - tied / 2
    every = np.concatenate(list(keys))
    weight = np.concatenate([np.ones(len(k), np.int64) if c is None else c for k, c in zip(keys, counts)])
    y = np.repeat(np.array(labels, np.int64), [len(k) for k in keys])
    order = np.argsort(every, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(every[order]) != 0))
    pos, neg = (np.add.reduceat((weight * x)[order], starts) for x in (y, 1 - y))
    below = np.cumsum(neg) - neg / 2
    return int(pos.sum()), int(neg.sum()), float(np.dot(pos.astype(float), below))


def _labelled(df: DataFrame, label: str, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., _y, _s0...): the labelled rows."""
    return df.where(F.col(label).isNotNull()).select(*by, F.col(label).cast("int").alias("_y"), *[F.col(c).cast("double").alias(f"_s{i}") for i, c in enumerate(cols)])


def _complete(rows: DataFrame) -> DataFrame:
    """Those with all scores; asked of stored rows, since Spark works a score out once more for such a condition."""
    return rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rows.columns if c.startswith("_s")]))


def _mixed(scores: Sequence[np.ndarray], weights: Sequence[float], room: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The weighted sum; ``room``: two arrays to work in, for fresh memory costs more than the sum."""
    out, term = room or (np.empty(len(scores[0])), np.empty(len(scores[0])))
    np.multiply(scores[0], weights[0], out=out)
    for s, w in zip(scores[1:], weights[1:]):
        out += np.multiply(s, w, out=term)
    return out


def _ordered_pairs(rows: DataFrame, vectors: Mapping[int, Sequence[float]], drawn: np.ndarray, by: Sequence[str], ranges: int) -> DataFrame:
    """(by..., w_index, auc): every task orders the scores it has and sends them, packed, to the task of their range,
    which counts the pairs inside; pairs of different ranges follow from the ranges' totals."""
    by, groups = list(by), rows.schema.fields[: len(by)]
    arrow = to_arrow_schema(T.StructType(groups))
    index, weights = list(vectors), np.array(list(vectors.values()), float)
    share = np.arange(1, ranges) / ranges
    mixes = [m[~np.isnan(m)] for m in (_mixed(list(drawn.T), w) for w in weights)]
    cuts = [_keys(np.quantile(m, share, method="lower") if len(m) else np.zeros(0)) for m in mixes]
    scores = [f"_s{i}" for i in range(weights.shape[1])]
    run_schema = T.StructType([*groups, *T._parse_datatype_string("w_index int, range int, y int, first long, n long, packed binary, counts binary").fields])
    run_arrow = to_arrow_schema(run_schema)

    def order(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        parts = [(None, table)]
        if by:
            places = table.select(by).append_column("_at", pa.array(np.arange(len(table)))).group_by(by, use_threads=False).aggregate([("_at", "list")])
            parts = [(places.slice(i, 1), table.take(places["_at_list"][i].values)) for i in range(len(places))]
        for group, part in parts:
            y = part["_y"].to_numpy()
            columns = [part[c].to_numpy() for c in scores]
            classes = [(int(v), [c[y == v] for c in columns]) for v in np.unique(y)]
            rooms = [(np.empty(len(values[0])), np.empty(len(values[0]))) for _, values in classes]
            for v, w in enumerate(weights):
                runs = []
                for (label, values), room in zip(classes, rooms):
                    keys = _keys(_mixed(values, w, room))
                    keys.sort()
                    runs += [(at, label, *run) for at, *run in _runs(keys, cuts[v])]
                fixed = [] if group is None else [group[c].combine_chunks().take(pa.array([0] * len(runs))).cast(arrow.field(c).type) for c in by]
                at, label, first, n, packed, counts = zip(*runs)
                made = [[index[v]] * len(runs), at, label, first, n, packed, counts]
                yield pa.RecordBatch.from_arrays([*fixed, *[pa.array(x, f.type) for x, f in zip(made, list(run_arrow)[len(by) :])]], schema=run_arrow)

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held, size = [*held, batch], size + batch.num_rows
            if size >= HELD_ROWS:
                yield from order(held)
                held, size = [], 0
        if held:
            yield from order(held)

    def counted(runs: pa.Table) -> pa.Table:
        keys = [_unpacked(f, n, p) for f, n, p in zip(*(runs[c].to_pylist() for c in ("first", "n", "packed")))]
        counts = [None if c is None else np.frombuffer(c, np.int64) for c in runs["counts"].to_pylist()]
        pos, neg, inside = _pairs(keys, runs["y"].to_pylist(), counts)
        out = runs.select([*by, "w_index", "range"]).slice(0, 1)
        for name, x, kind in (("pos", pos, pa.int64()), ("neg", neg, pa.int64()), ("inside", inside, pa.float64())):
            out = out.append_column(name, pa.array([x], kind))
        return out

    schema = T.StructType([*groups, *T._parse_datatype_string("w_index int, range int, pos long, neg long, inside double").fields])
    totals = rows.mapInArrow(ordered, run_schema).groupBy(*by, "w_index", "range").applyInArrow(counted, schema)
    # At most as many rows per window as there are ranges.
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(*by, "w_index").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    right = F.col("pos").cast("double") * F.col("below") + F.col("inside")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return totals.withColumn("below", below).groupBy(*by, "w_index").agg(F.try_divide(F.sum(right), pairs).alias("auc"))


def _drawn(rows: DataFrame, n: int, most: int) -> np.ndarray:
    """About ``most`` of the ``n`` rows' scores."""
    share = min(1.0, most / max(n, 1))
    return rows.sample(fraction=share, seed=11).select(*[c for c in rows.columns if c.startswith("_s")]).toPandas().to_numpy(dtype=float)


def grid_auc(
    df: DataFrame,
    label: str,
    cols: Sequence[str],
    grid: Sequence[Sequence[float]],
    by: Sequence[str] = (),
    only: DataFrame | None = None,
) -> DataFrame:
    """Exact AUC of every weight vector: (by..., w_index, w_<col>..., auc), or of the vectors of each group in ``only``
    (by..., w_index; no more rows than the grid has for all groups).

    The narrow rows are stored once. Each pass takes some of the vectors and drops what it has shuffled, so the room
    that is needed follows the rows and not the grid. The AUCs, groups times vectors, reach the driver.
    """
    by, spark = list(by), df.sparkSession
    vectors = dict(enumerate(grid))
    if only is not None:
        asked = {r[0] for r in only.select("w_index").distinct().collect()}
        vectors = {i: ws for i, ws in vectors.items() if i in asked}
    with dropped_shuffles(spark):
        spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = _complete(stored(_labelled(df, label, cols, by).repartition(spread), "scores"))
        n = rows.count()
        ranges = max(1, -(-n // RANGE_ROWS))
        drawn = _drawn(rows, n, max(BIN_ROWS, 64 * ranges)) if n else np.zeros((0, len(cols)))
        if n and not len(drawn):
            drawn = np.zeros((1, len(cols)))
        graded, wide = [], max(PASS_VECTORS, PASS_VALUES // max(n, 1))
        with row_batches(spark):
            for first in range(0, len(vectors) if n else 0, wide):
                part = dict(list(vectors.items())[first : first + wide])
                graded += _ordered_pairs(rows, part, drawn, by, ranges).collect()
    schema = T.StructType([*df.select(*by).schema.fields, *T._parse_datatype_string("w_index int, auc double").fields])
    result = spark.createDataFrame([tuple(r) for r in graded], schema)
    if only is not None:
        same = [result[c].eqNullSafe(only[c]) for c in (*by, "w_index")]
        result = result.join(F.broadcast(only), reduce(lambda a, b: a & b, same), "left_semi")
    weights = [
        F.element_at(F.array(*[F.lit(float(ws[j])) for ws in grid]), F.col("w_index") + 1).alias(f"w_{c}")
        for j, c in enumerate(cols)
    ]
    return result.select(*by, "w_index", *weights, "auc")


def best_of(graded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The first weight vector with the highest AUC, per group."""
    rest = [c for c in graded.columns if c not in {*by, "auc", "w_index"}]
    picked = graded.groupBy(*by).agg(
        F.max(F.struct("auc", (-F.col("w_index")).alias("_neg"), *rest)).alias("_best")
    )
    return picked.select(
        *by, (-F.col("_best._neg")).alias("w_index"), *[F.col(f"_best.{c}") for c in rest], F.col("_best.auc")
    )


#: Bins of the bounds at first, and how many more in each round.
BINS, FINER, MOST_BINS = 256, 8, 1 << 16


def auc_bounds(
    df: DataFrame, label: str, cols: Sequence[str], vectors: Mapping[int, Sequence[float]], edges: np.ndarray, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., w_index, low, high): each vector's AUC lies between the share of pairs in the right order across bins
    and that share plus the pairs inside bins. ``edges``: one row of bin limits per vector.

    Every task counts its rows by group, vector and bin; only these counts are shuffled.
    """
    by, index, weights = list(by), np.array(list(vectors), np.int32), np.array(list(vectors.values()), float)
    rows = _complete(_labelled(df, label, cols, by))
    bins = edges.shape[1] + 1
    groups = rows.select(*by, "_y").schema.fields[: len(by)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(by))])) if by else [()] * batch.num_rows
            names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            group = np.array([names[k] for k in keys], np.int64)
            y, *scores = [batch.column(len(by) + i).to_numpy(zero_copy_only=False) for i in range(1 + len(cols))]
            for v in range(len(index)):
                mix = _mixed(scores, weights[v])
                place = (group * bins + np.searchsorted(edges[v], mix, "right")) * 2 + y
                counts = np.bincount(place, minlength=len(names) * bins * 2).reshape(len(names), bins, 2)
                for k, i in names.items():
                    held.setdefault(k, np.zeros((len(index), bins, 2), np.int64))[v] += counts[i]
        for k, counts in held.items():
            v, b = np.nonzero(counts.sum(axis=2))
            fixed = [pa.array([x] * len(v), f.type) for x, f in zip(k, arrow)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(index[v]), pa.array(b.astype(np.int32)), pa.array(counts[v, b, 1]), pa.array(counts[v, b, 0])], names=[*by, "w_index", "bin", "pos", "neg"])

    schema = T.StructType([*groups, *T._parse_datatype_string("w_index int, bin int, pos long, neg long").fields])
    arrow = to_arrow_schema(T.StructType(groups))
    totals = rows.mapInArrow(count, schema).groupBy(*by, "w_index", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # At most as many rows per window as there are bins.
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(*by, "w_index").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    placed = totals.withColumn("below", below).withColumns({c: F.col(c).cast("double") for c in ("pos", "neg", "below")})
    low = F.try_divide(F.sum(F.col("pos") * F.col("below")), pairs)
    inside = F.try_divide(F.sum(F.col("pos") * F.col("neg")), pairs)
    # The sums are of whole numbers; only their size can cost the last digits.
    return placed.groupBy(*by, "w_index").agg((low * (1 - 1e-12)).alias("low"), ((low + inside) * (1 + 1e-12)).alias("high"))


def leading_vectors(df: DataFrame, label: str, cols: Sequence[str], grid: Sequence[Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """(by..., w_index): the vectors that may have the highest AUC of their group, ties included.

    Round by round the bins get finer, and vectors whose upper bound is below the best lower one drop out.
    """
    by, spark = list(by), df.sparkSession
    labelled = df.where(F.col(label).isNotNull()).select(*by, label, *cols)
    share = min(1.0, BIN_ROWS / max(labelled.count(), 1))
    drawn = labelled.sample(fraction=share, seed=11).select(*[F.col(c).cast("double") for c in cols]).na.drop().toPandas().to_numpy(dtype=float)
    schema = T.StructType([*labelled.schema.fields[: len(by)], T.StructField("w_index", T.IntegerType())])
    left = {i: tuple(ws) for i, ws in enumerate(grid)}
    bins, kept = BINS, None
    while len(drawn):
        mixes = np.stack([np.quantile(reduce(add, [drawn[:, j] * w for j, w in enumerate(ws)]), np.arange(1, bins) / bins) for ws in left.values()])
        bounds = auc_bounds(labelled, label, cols, left, mixes, by).collect()  # groups times vectors
        best: dict[tuple, float] = {}
        for r in bounds:
            k = tuple(r[c] for c in by)
            best[k] = max(best.get(k, -1.0), r["low"] if r["low"] is not None else -1.0)
        kept = [(*[r[c] for c in by], r["w_index"]) for r in bounds if r["high"] is not None and r["high"] >= best[tuple(r[c] for c in by)]]
        single = [tuple(r[c] for c in by) for r in bounds if r["high"] is None]  # one class only: nothing to compare
        kept += [(*k, i) for k in dict.fromkeys(single) for i in left]
        fewer = {i: left[i] for i in sorted({r[-1] for r in kept})}
        if len(kept) <= len(best) or bins >= MOST_BINS or (len(fewer) == len(left) and bins > BINS):
            break
        left, bins = fewer, bins * FINER
    if kept is None:
        kept = []
    return spark.createDataFrame(kept, schema)


def best_vector(df: DataFrame, label: str, cols: Sequence[str], grid: Sequence[Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """What ``best_of(grid_auc(...))`` gives, with only the leading vectors graded exactly."""
    return best_of(grid_auc(df, label, cols, grid, by, leading_vectors(df, label, cols, grid, by)), by)


def _neighbours(center: Sequence[float], step: float, cap: float) -> list[tuple[float, ...]]:
    """Vectors that shift ``step`` of weight between two models, inside [0, cap]."""
    out = {tuple(round(w, 12) for w in center)}
    for i in range(len(center)):
        for j in range(len(center)):
            moved = list(center)
            moved[i] += step
            moved[j] -= step
            if i != j and moved[i] <= cap + 1e-12 and moved[j] >= -1e-12:
                out.add(tuple(round(abs(w), 12) for w in moved))
    return sorted(out)


def capped_weights(
    df: DataFrame, key: str, label: str, cols: Sequence[str], cap: float = 0.6, parts: int = 5, step: float = 0.0125
) -> tuple[dict[str, float], float]:
    """Rank-blend weights in [0, cap] with sum 1: a coarse simplex grid, then local moves.

    A move that helps is followed by moves of the same size; when none helps, the size halves,
    until no neighbour at the smallest size, at most ``step``, is better. Each round bounds its
    whole grid by counts and grades the leading vectors; only the best row reaches the driver. ``parts`` grows until the grid
    has a vector within the cap; there is none at all if ``cap * len(cols) < 1``.
    """
    if cap * len(cols) < 1 - 1e-9:
        raise ValueError(f"{len(cols)} weights of at most {cap} cannot sum to 1")
    while not (grid := simplex_grid(len(cols), parts, cap)):
        parts += 1
    ranks = rank_norm(df.where(F.col(label).isNotNull()), key, cols).join(df.select(key, label), key).persist()
    size, best, score = 1.0 / parts, None, -1.0
    while True:
        top = best_vector(ranks, label, cols, grid).first()
        if best is None or top["auc"] > score:
            best, score = tuple(top[f"w_{c}"] for c in cols), top["auc"]
        elif size <= step:
            break
        else:
            size /= 2
        grid = _neighbours(best, size, cap)
        if len(grid) == 1 and size <= step:
            break
    ranks.unpersist()
    return dict(zip(cols, best)), float(score)


def pick_best(scored: DataFrame, name: str = "candidate", score: str = "auc") -> DataFrame:
    """The candidate with the highest score; the first name wins a tie."""
    return scored.orderBy(F.col(score).desc(), F.col(name)).limit(1)
