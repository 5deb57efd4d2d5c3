"""Evidence of a document's words: a logistic model over hashed words and pairs of words.

A document is the set of buckets (2**BITS) of its lower-cased words and adjacent pairs, scaled to length one. Two
models are fitted, each to the labelled documents of one half (by a hash of the id) of a bounded sample, about
SAMPLE documents; every document is judged by the model of the other half, so that no label speaks for itself.
Fitting is accelerated gradient descent with a ridge, on the driver: the sample is at most SAMPLE rows of at most
2**BITS numbers. Judging reads whole texts in blocks of some megabytes or one longer text.

A null or empty text has margin zero; without labels of both kinds in a half all margins of the other are zero.
Repeated rows have equal margins; of several labels of an id the worst counts. Extra columns stay, except ``margin``;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.arrowtext import LOWER, SPACED, appended, blocks, free_name, mixed, span_hashes, spans, text_bytes

BITS = 14
SAMPLE = 5_000
RIDGE, ROUNDS = 1e-4, 300


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of all texts, one text behind the other, and how many each has."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, bounds = spans(data, offsets, SPACED)
    n = np.diff(bounds)
    text = np.repeat(np.arange(len(n)), n)
    words = mixed(span_hashes(data, starts, ends))
    side = np.flatnonzero(text[1:] == text[:-1]) if len(text) else text
    pairs = mixed(words[side] + mixed(words[side + 1]))
    shift = np.uint64(64 - BITS)
    key = np.unique(np.concatenate((text, text[side])) << BITS | (np.concatenate((words, pairs)) >> shift).astype(np.int64))
    return (key & ((1 << BITS) - 1)).astype(np.int32), np.bincount(key >> BITS, minlength=len(n))


def margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Log-odds of every text by each row of ``weights`` (the constant last)."""
    bucket, counts = buckets(column)
    owner = np.repeat(np.arange(len(counts)), counts)
    out = [np.where(counts > 0, np.bincount(owner, w[bucket], len(counts)) / np.sqrt(np.maximum(counts, 1)) + w[-1], 0.0) for w in weights]
    return np.stack(out)


def fit_half(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Weights and constant of the ridge model of some documents; zeros unless both labels occur."""
    size = 1 << BITS
    if not 0 < good.sum() < len(good):
        return np.zeros(size + 1)
    bucket = np.concatenate(rows)
    counts = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), counts)
    value = np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts)
    w = v = np.zeros(size + 1)
    step, momentum = 1 / (0.5 + RIDGE), 1.0
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-(np.bincount(owner, value * v[bucket], len(rows)) + v[-1])))
        error = (p - good) / len(rows)
        gradient = np.append(np.bincount(bucket, value * error[owner], size) + RIDGE * v[:-1], error.sum())
        new, last = v - step * gradient, momentum
        momentum = (1 + np.sqrt(1 + 4 * last**2)) / 2
        w, v = new, new + (last - 1) / momentum * (new - w)
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Two rows of weights: of the documents with an even and with an odd hash. (doc_id, text); (doc_id, quality)."""
    label = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    share = min(1.0, sample / max(label.count(), 1))
    chosen = label.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 31)) < F.lit(share * (1 << 31)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            bucket, counts = buckets(block.column("text"))
            raw, ends = bucket.astype(np.uint16).tobytes(), (2 * np.append(0, np.cumsum(counts))).tolist()
            packed = pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in ("doc_id", "half", "good")), packed], names=["doc_id", "half", "good", "buckets"])

    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", half("doc_id").alias("half"), "good", "text")
    once = found.mapInArrow(run, "doc_id long, half int, good int, buckets binary").groupBy("doc_id").agg(F.min("half").alias("half"), F.min("good").alias("good"), F.min("buckets").alias("buckets"))
    rows = once.orderBy("doc_id").collect()
    sides = [[r for r in rows if r["half"] == h] for h in (0, 1)]
    return np.stack([fit_half([np.frombuffer(r["buckets"], np.uint16).astype(np.int64) for r in side], np.array([r["good"] for r in side], float)) for side in sides])


def half(id: str) -> F.Column:
    return F.pmod(F.xxhash64(F.lit(2), id), F.lit(2)).cast("int")


def with_margin(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` (doc_id, text) with ``margin``, by the model of the other half."""
    weights = fit(docs, labels, sample)
    even, odd = (free_name(docs.columns, f"__margin{i}") for i in (0, 1))
    fields = [T.StructField(n, T.DoubleType(), False) for n in (even, odd)]
    judged = appended(docs, "text", fields, lambda column: [pa.array(m) for m in margins(column, weights)])
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "margin"]
    return judged.select(*kept, F.when(half("doc_id") == 0, F.col(odd)).otherwise(F.col(even)).alias("margin"))
