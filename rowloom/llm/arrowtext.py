"""Texts of Arrow batches as numpy byte arrays: bounded blocks, word spans, span hashes.

Every function works on whole texts. A null text counts as empty. Words never reach across two texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are worked on at once (a longer text forms a block of its own).
BLOCK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true outside the given ranges of byte values."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Bytes of the words ``[^\x20\x09-\x0D]+``.
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
#: What lower-cases the bytes of A to Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and the place where each text begins (with the end as last entry)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of whole rows with at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(row, stop - row)
            row = stop


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes in the class, and for each text its first run (with the end last)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    mask = inside[data]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    before[cuts] = False
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    after[cuts - 1] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial modulo 2**64, from one running sum."""
    n = len(data) + 1
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            power = np.full(size, base, np.uint64)
            power[0] = 1
            _powers[i] = np.cumprod(power, dtype=np.uint64)
    total = np.zeros(n, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][: n - 1], out=total[1:])
    value = (total[ends] - total[starts]) * _powers[1][starts]
    return mixed(value + mixed((ends - starts).astype(np.uint64)))


def word_dictionary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The spans' bytes with an exact dictionary of the block."""
    width = ends - starts
    begin = np.cumsum(width) - width
    flat = data[np.arange(int(width.sum())) + np.repeat(starts - begin, width)]
    offsets = np.append(begin, width.sum()).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).dictionary_encode()


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for spans of equal bytes."""
    return word_dictionary(data, starts, ends).indices.to_numpy(zero_copy_only=False).astype(np.int64)


def span_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of BLAKE2b of each span as two longs: for names that hold in the whole corpus."""
    raw, digest = data.tobytes(), hashlib.blake2b
    joined = b"".join([digest(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    both = np.frombuffer(joined, np.int64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def document_key(id: str, text: str) -> Column:
    """128 bits of the MD5 of id and text, nulls apart from empty texts: the name of a document, however many."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (id, text)]
    return F.unhex(F.md5(F.concat_ws("\n", *parts)))


def free_name(taken: list[str], name: str) -> str:
    """``name``, with as many underscores as it takes to clash with no column."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def code_point_starts(data: np.ndarray) -> np.ndarray:
    """True where a byte begins a code point."""
    return (data & 0xC0) != 0x80


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def text_array(data: np.ndarray, lengths: np.ndarray) -> pa.StringArray:
    """Texts that lie one behind the other in ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def appended(df: DataFrame, source: str, fields: list[T.StructField], make: Callable[[pa.Array], list[pa.Array]], limit: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with new columns that ``make`` derives from the column ``source``, block by block.

    A new column replaces one of the same name; all other columns stay as they are.
    """
    names = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in names]
    own = "__source"
    while own in df.columns:
        own += "_"
    given = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{source}`").alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, own, limit):
            made = make(block.column(own))
            columns = [block.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[f.name for f in kept] + [f.name for f in fields])

    return given.mapInArrow(run, T.StructType([*kept, *fields]))
