"""Language identification by string kernels.

k(x, z) counts the byte n-grams (n = 1, 2, 3, blended) that are present in both texts, divided by the root of
the product of k(x, x) and k(z, z). Texts are compared over the n-grams of the landmarks. A to Z count as a to
z, and every ASCII byte that is no letter counts as a space. Landmarks are whole labelled texts; the Nyström
features K(x, Z) K(Z, Z)^-1/2 feed one ridge regression per language against the rest, and both matrices fold
into one, so that a block of texts is scored by two products: presence x landmarks, then kernel x weights.

Fitting takes a bounded sample: per language the ``per_class`` texts with the smallest hashes of id and text
among those of at most SAMPLE_CHARS code points, ``landmarks`` of them over all languages. A language with fewer
than FEW such texts is also learned from whole longer ones, FEW texts at most in all. Every language with a
lettered text is learned. Prediction reads whole texts of every document, however long; ``lang`` is never looked
at.

A text that is null or has no letter is ``und`` with score 0. Otherwise the score is the softmax of the
regressions at the predicted language; equal regressions go to the name that sorts first. Without labelled
texts everything is ``und``. Null labels are not learned. Extra columns are kept by ``predict``; columns named
lang_pred or score are replaced. Rows are treated one by one, so repeats get equal results.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rowloom.llm.arrowtext import LOWER, appended, byte_class, text_bytes

#: Bounds of the sample: texts per language, landmarks over all, code points of a sampled text, languages.
PER_CLASS, LANDMARKS, SAMPLE_CHARS, CLASSES = 400, 96, 20_000, 500
#: A language with fewer texts of at most SAMPLE_CHARS is filled up to so many with longer ones.
FEW = 24
RIDGE = 1e-2
#: The regressions are multiplied by this before the softmax.
SHARPNESS = 4.0
#: Texts whose presence vectors are held at once.
TOGETHER = 256

#: The bytes that texts are compared by, numbered without gaps in their order: codes of n-grams stay small, and so
#: do the tables over all codes.
_KINDS, _FOLD = np.unique(np.where(LOWER < 128, np.where(byte_class((0, 96), (123, 127))[LOWER], LOWER, 32), LOWER), return_inverse=True)
_FOLD = _FOLD.astype(np.uint8)
_SPACE = {n: len(_KINDS) ** n for n in (1, 2, 3)}


@dataclass
class Model:
    """Sorted n-grams per n, presence of the landmarks over them, norms of the landmarks, and weights."""

    grams: dict[int, np.ndarray]
    landmarks: np.ndarray
    norms: np.ndarray
    languages: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


Tables = dict[int, np.ndarray]


def tables(model: Model) -> Tables:
    """For each n, the feature of every n-gram, or -1. A task builds them once."""
    made, at = {}, 0
    for n, grams in sorted(model.grams.items()):
        made[n] = np.full(_SPACE[n], -1, np.int32)
        made[n][grams] = np.arange(at, at + len(grams))
        at += len(grams)
    return made


def _codes(data: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of every n-gram inside a text, and its text."""
    code = data[: len(data) - n + 1].astype(np.int32)
    for k in range(1, n):
        code = code * np.int32(len(_KINDS)) + data[k : len(data) - n + 1 + k]
    if n == 1:
        return code, text
    inside = text[: len(data) - n + 1] == text[n - 1 :]
    return code[inside], text[: len(data) - n + 1][inside]


def presence(model: Model, found: Tables, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: which of the model's n-grams it holds."""
    rows, width = len(offsets) - 1, sum(len(g) for g in model.grams.values())
    out = np.zeros((rows, width), np.float32)
    flat = out.ravel()
    data = _FOLD[data]
    text = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    for n, table in found.items():
        if len(data) >= n:
            code, owner = _codes(data, text, n)
            column = table[code]
            known = column >= 0
            flat[owner[known] * width + column[known]] = 1
    return out


def kernel(model: Model, found: Tables, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """K(x, Z) for all texts, by one matrix product."""
    there = presence(model, found, data, offsets)
    norm = np.sqrt(np.maximum(there.sum(axis=1), 1))
    return (there @ model.landmarks.T) / norm[:, None] / model.norms


def _blocks(offsets: np.ndarray) -> list[tuple[int, int]]:
    return [(i, min(i + TOGETHER, len(offsets) - 1)) for i in range(0, len(offsets) - 1, TOGETHER)]


def train(texts: list[str], labels: list[str], chosen: list[int], ridge: float = RIDGE) -> Model:
    """The model of a sample; ``chosen`` are the indexes of the landmarks."""
    languages = sorted(set(labels))
    if not languages:
        return Model({}, np.zeros((0, 0), np.float32), np.zeros(0), [])
    data, offsets = text_bytes(pa.array([texts[i] for i in chosen], pa.string()))
    folded = _FOLD[data]
    owner = np.repeat(np.arange(len(chosen)), np.diff(offsets))
    grams = {n: np.unique(_codes(folded, owner, n)[0]) if len(folded) >= n else np.zeros(0, np.int32) for n in (1, 2, 3)}
    model = Model(grams, np.zeros((0, 0), np.float32), np.ones(1), languages)
    found = tables(model)
    model.landmarks = presence(model, found, data, offsets)
    model.norms = np.sqrt(np.maximum(model.landmarks.sum(axis=1), 1))
    square = kernel(model, found, data, offsets)
    value, vector = np.linalg.eigh((square + square.T) / 2)
    root = vector @ np.diag(np.where(value > 1e-6, 1 / np.sqrt(np.maximum(value, 1e-6)), 0)) @ vector.T
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    rows = [kernel(model, found, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in _blocks(offsets)]
    feature = np.column_stack([np.vstack(rows) @ root, np.ones(len(texts))])
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    penalty = np.eye(feature.shape[1]) * ridge * len(texts) / max(1, len(languages))
    penalty[-1, -1] = 1e-9
    w = np.linalg.solve(feature.T @ feature + penalty, feature.T @ target)
    model.weights = np.vstack([root @ w[:-1], w[-1:]])
    return model


def _bounds(spark: SparkSession, wanted: dict[tuple[str, bool], tuple[int, int]], below: dict[tuple[str, bool], float]) -> DataFrame:
    """How many texts of each (language, long) are wanted, and below which share. An Arrow table becomes a local
    relation; a list of rows would start Python workers of their own on the executors."""
    columns = {
        "__lang": pa.array([lang for lang, _ in below], pa.string()),
        "__long": pa.array([long for _, long in below], pa.bool_()),
        "__need": pa.array([wanted[k][0] for k in below], pa.int64()),
        "__below": pa.array(list(below.values()), pa.float64()),
    }
    return spark.createDataFrame(pa.table(columns))


def fit(docs: DataFrame, key: str, text: str = "text", lang: str = "lang", per_class: int = PER_CLASS, landmarks: int = LANDMARKS) -> Model:
    """A model from a bounded sample of the labelled rows."""
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    long = F.length(text) > SAMPLE_CHARS
    sums = [F.count_if(lettered & ~long).alias("short"), F.count_if(lettered & long).alias("long")]
    sizes = docs.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(*sums).limit(CLASSES).collect()
    if len(sizes) >= CLASSES:
        raise ValueError(f"the operator is made for fewer than {CLASSES} languages")
    wanted = {(r["lang"], False): (min(r["short"], per_class), r["short"]) for r in sizes if r["short"]}
    few = min(FEW, per_class)
    wanted |= {(r["lang"], True): (min(r["long"], few - r["short"]), r["long"]) for r in sizes if r["long"] and r["short"] < few}
    share = F.pmod(F.xxhash64(key, text), F.lit(1 << 31)) / F.lit(float(1 << 31))
    order = Window.partitionBy("lang", "long").orderBy(F.when(F.col("long"), F.length("t")), "h", "t")

    def sample(below: dict[tuple[str, bool], float]) -> list:
        """The first texts of every (language, long) among those whose share of the hashes is below the given one."""
        if not below:
            return []
        parts = _bounds(docs.sparkSession, wanted, below)
        near = docs.join(F.broadcast(parts), (F.col(lang) == F.col("__lang")) & (long == F.col("__long"))).where(lettered & (share < F.col("__below")))
        chosen = near.select(F.col(lang).alias("lang"), F.col("__long").alias("long"), "__need", F.col(text).alias("t"), share.alias("h"))
        ranked = chosen.withColumn("r", F.row_number().over(order)).where((F.col("r") <= per_class) & (F.col("r") <= F.col("__need")))
        return ranked.select("lang", "long", "r", "t").collect()

    # Of a frequent language only rows with small hashes are looked at, eight times as many as are wanted, so
    # that what meets in the task of a language does not grow with the corpus. Where that gives too few, as for
    # many copies of one row, all rows of the language are looked at.
    rows = sample({k: 8 * need / size for k, (need, size) in wanted.items()})
    found = Counter((r["lang"], r["long"]) for r in rows)
    scarce = {k for k, (need, _) in wanted.items() if found[k] < need}
    rows = [r for r in rows if (r["lang"], r["long"]) not in scarce] + sample({k: 2.0 for k in scarce})
    rows.sort(key=lambda r: (r["lang"], r["long"], r["r"]))
    classes = len({r["lang"] for r in rows})
    each = max(1, landmarks // classes) if classes else 0
    first: Counter = Counter()
    chosen = []
    for i, r in enumerate(rows):
        first[r["lang"]] += 1
        if first[r["lang"]] <= each:
            chosen.append(i)
    return train([r["t"] for r in rows], [r["lang"] for r in rows], chosen)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks x n-grams, bounded by the sample
    held: list[Tables] = []  # filled anew in every task

    def make(column: pa.Array) -> list[pa.Array]:
        m = shared.value
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not m.languages:
            return [pa.array(["und"] * len(column)), pa.array(np.zeros(len(column)))]
        data, offsets = text_bytes(column)
        if not held:
            held.append(tables(m))
        best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
        for a, b in _blocks(offsets):
            k = kernel(m, held[0], data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            margin = (k @ m.weights[:-1] + m.weights[-1]) * SHARPNESS
            best[a:b] = margin.argmax(axis=1)
            score[a:b] = 1 / np.exp(margin - margin.max(axis=1, keepdims=True)).sum(axis=1)
        names = np.array([*m.languages, "und"], object)
        return [pa.array(names[np.where(lettered, best, len(m.languages))], pa.string()), pa.array(np.where(lettered, score, 0.0))]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return appended(docs, text, fields, make)
