"""SimHash fingerprints and their links by tables of distances to reference fingerprints (pivots).

Fingerprint: A to Z are lower-cased, words are runs of bytes other than white space, shingles are three words
joined by a space (all words if there are fewer), repeats included. A bit is set if it is set in over half of
the shingles' XXH64 values (seed 42). A text without words, or null, has fingerprint zero.

Links: two fingerprints within three bits agree on at least two of five bit blocks, so each goes to ten
buckets, one per pair of blocks, and every link meets in a bucket. There the distances of all fingerprints to
PIVOTS reference fingerprints are tabled. By the triangle inequality no coordinate of a linked pair differs by
more than three: pairs with a larger difference in any coordinate are discarded, the others are verified by
their own distance. A task gives out not the pairs but a forest of each bucket's links, which is at most one
edge per fingerprint, so large groups stay linear. A bucket with over BUCKET fingerprints is dealt out by
hash into parts, and every two parts meet in a task of their own: no pair is lost and no task grows.

Exact copies share a fingerprint and collapse before the search. The graph's nodes are fingerprints, so rows
without an id link others too; a component is named afterwards by the smallest id in it. Every document keeps
its row, repeated rows and null ids included (a null id is never a component's name unless all of a
component's ids are null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.arrowtext import LOWER, SPACED, appended, document_key, free_name, mixed, spans, text_bytes
from rowloom.llm.components import components
from rowloom.session import stored

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Reference fingerprints: a fixed pseudo-random set.
PIVOTS = mixed(np.arange(1, 25, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: First bit and width of the five blocks.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints that meet in a task at once; larger buckets are split.
BUCKET = 2048


def shingle_hashes(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles of all texts, and the number of shingles of each text."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, bounds = spans(data, offsets, SPACED)
    n_words = np.diff(bounds)
    # Words one behind the other, one space after each.
    width = ends - starts + 1
    begin = np.cumsum(width) - width
    flat = np.append(data, np.uint8(32))[np.arange(int(width.sum())) + np.repeat(starts - begin, width)]
    stop = begin + width - 1
    flat[stop] = 32
    text = np.repeat(np.arange(len(n_words)), n_words)
    last = np.minimum(np.arange(len(begin)) + size - 1, bounds[1:][text] - 1)
    chosen = np.flatnonzero((np.arange(len(begin)) + size <= bounds[1:][text]) | (np.arange(len(begin)) == bounds[:-1][text]))
    raw, digest = flat.tobytes(), xxhash.xxh64_intdigest
    values = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[chosen].tolist(), stop[last[chosen]].tolist())), np.uint64, len(chosen))
    return values, np.bincount(text[chosen], minlength=len(n_words))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per text: the bits that over half of its hashes set."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    first = (np.cumsum(counts) - counts)[some]
    weight = np.uint64(1) << np.arange(64, dtype=np.uint64)
    at = 0
    while at < len(some):  # about 64 thousand hashes at once, one text at least
        stop = max(at + 1, int(np.searchsorted(first, first[at] + (1 << 16))))
        low, high = first[at], first[stop] if stop < len(some) else len(hashes)
        bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.add.reduceat(bits, first[at:stop] - low, axis=0, dtype=np.int32)
        out[some[at:stop]] = ((total * 2 > counts[some[at:stop], None]) * weight).sum(axis=1, dtype=np.uint64)
        at = stop
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``fp``: the 64 bits as a signed long."""
    return appended(docs, text, [T.StructField("fp", T.LongType(), False)], lambda column: [pa.array(majority(*shingle_hashes(column)).view(np.int64))])


def merged(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after linking i and j: the smallest index of each connected group."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            break
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def linked(fp: np.ndarray, group: np.ndarray, pivots: np.ndarray = PIVOTS, distance: int = DISTANCE) -> np.ndarray:
    """For rows sorted by group: the first row of the connected links that each row belongs to."""
    label = np.arange(len(fp))
    rows = np.arange(len(fp) - 1)
    table = np.stack([np.bitwise_count(fp ^ p) for p in pivots]).astype(np.int8)
    shift = 0
    while len(rows):
        shift += 1
        rows = rows[rows + shift < len(fp)]
        rows = rows[group[rows] == group[rows + shift]]  # rows that have a partner at this distance in the order
        near = rows
        for coordinate in table:
            near = near[np.abs(coordinate[near] - coordinate[near + shift]) <= distance]
        near = near[np.bitwise_count(fp[near] ^ fp[near + shift]) <= distance]
        label = merged(label, near, near + shift)
    return label


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """From distinct (fp, rep): edges (a, b) between reps whose components are those of all links."""
    keys = []
    for t, pair in enumerate(combinations(BLOCKS, 2)):
        parts = [F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1) for first, width in pair]
        keys.append(F.lit(t << 32) + F.shiftleft(parts[0], 13) + parts[1])
    keyed = nodes.select("fp", "rep", F.explode(F.array(*keys)).alias("bucket"))
    large = keyed.groupBy("bucket").agg(F.ceil(F.count("*") / bucket).cast("int").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = (
        keyed.join(large, "bucket", "left")
        .select("bucket", "fp", "rep", F.coalesce(part, F.lit(0)).alias("p"), other.alias("q"))
        .select("bucket", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"), "fp", "rep")
    )
    spread = dealt.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            columns = [np.concatenate(x) for x in zip(held, columns)] if held else columns
            new = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]) | (columns[2][1:] != columns[2][:-1])) + 1
            cut = int(new[-1]) if len(new) else 0  # the last group may go on in the next batch
            held = [c[cut:] for c in columns]
            if cut:
                yield edges([c[:cut] for c in columns])
        if held:
            yield edges(held)

    def edges(columns: list[np.ndarray]) -> pa.RecordBatch:
        bucket, p, q, fp, rep = columns
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]))
        label = linked(fp.view(np.uint64), np.cumsum(new))
        own = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(rep[own]), pa.array(rep[label[own]])], names=["a", "b"])

    return spread.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", key: bool = False) -> DataFrame:
    """(id, fp, component_id) of every document, with its ``document_key`` if ``key`` is set."""
    named = [document_key("id", "text").alias("key")] if key else []
    marked = stored(fingerprints(docs.select(F.col(id).alias("id"), F.col(text).alias("text"))).select("id", "fp", *named), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp", F.col("fp").alias("rep"))))
    rooted = stored(nodes.join(roots, nodes["fp"] == roots["node"], "left").select(F.col("fp").alias("__fp"), "least", F.coalesce("root", "fp").alias("root")), "rooted")
    names = rooted.groupBy(F.col("root").alias("__root")).agg(F.min("least").alias("component_id"))
    named = rooted.join(names, F.col("root") == F.col("__root")).select("__fp", "component_id")
    return marked.join(named, F.col("fp") == F.col("__fp")).select(F.col("id").alias(id), "fp", "component_id", *(["key"] if key else []))


def representatives(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group, that with the smallest id. Of different texts that
    share that id and group the one with the smallest key stays, rows alike in id and text stay once. Documents with
    a null id, which no other document can stand for, stay."""
    named = stored(near_duplicates(docs, id, text, key=True), "named")
    keep = named.where(F.col(id) == F.col("component_id")).groupBy("component_id").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    keep = stored(keep, "kept")
    own = free_name(docs.columns, "__key")
    kept = docs.join(keep.select(F.col("key").alias(own)), document_key(id, text) == F.col(own), "left_semi")
    if keep.where("n > 1").limit(1).count():
        kept = kept.dropDuplicates([id, text])
    return kept.unionByName(docs.where(F.col(id).isNull()))
