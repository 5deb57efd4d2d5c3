"""Chat formatting by columnar byte assembly, and the way back.

The template of a turn is ``### role: text</turn>`` and a line feed. Inside texts a backslash goes before every
backslash, ``#`` and ``<``; inside roles before ``:`` as well. No control string can therefore occur inside a
text, and taking each escaping backslash away gives the text back, whatever it holds. The loss mask lists the
code-point ranges [start, end) of the escaped texts of the roles that are learned from.

A block of conversations is flattened into five segments per turn. Segment lengths give cumulative offsets,
offsets give the index where each byte goes, and headers and contents are copied into one preallocated
buffer, which becomes the Arrow column without another copy.

Turns are ordered by turn, then role, then text, nulls first; repeated rows are repeated turns. A null role or
text counts as empty; a null conversation id is an id of its own. A conversation of empty texts is formatted
like any other. Only the named columns of the input are used; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.arrowtext import BLOCK_BYTES, byte_class, code_point_starts, list_array, text_array, text_bytes

_OPEN, _COLON, _CLOSE = b"### ", b": ", b"</turn>\n"
_TEXT_MARKS = ~byte_class(*((ord(c), ord(c)) for c in "\\#<"))
_ROLE_MARKS = ~byte_class(*((ord(c), ord(c)) for c in "\\#<:"))
_TURN = re.compile(r"### ([^\\#<:]*+(?:\\.[^\\#<:]*+)*+): ([^\\#<]*+(?:\\.[^\\#<]*+)*+)</turn>\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)

FORMATTED = "conv_id long, n_turns long, formatted string, loss array<struct<start: long, end: long>>"
READ = "conv_id long, roles array<string>, texts array<string>, learned array<string>, formatted_chars long"


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation with its ordered turns."""
    turn = F.struct("turn", "role", "text")
    return turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _escaped(column: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with a backslash before each mark, and the length of each text."""
    data, offsets = text_bytes(column)
    mark = marks[data]
    added = np.append(0, np.cumsum(mark))
    out = np.full(len(data) + added[-1], ord("\\"), np.uint8)
    out[np.arange(len(data)) + added[1:]] = data
    return out, np.diff(offsets + added[offsets])


def assemble(roles: pa.Array, texts: pa.Array, n_turns: np.ndarray, learned: tuple[str, ...]) -> tuple[pa.Array, pa.Array]:
    """Formatted texts and loss ranges of conversations with ``n_turns`` turns each."""
    role, role_size = _escaped(roles, _ROLE_MARKS)
    text, text_size = _escaped(texts, _TEXT_MARKS)
    turns = len(roles)
    size = np.empty((turns, 5), np.int64)
    size[:, 0], size[:, 1], size[:, 2], size[:, 3], size[:, 4] = len(_OPEN), role_size, len(_COLON), text_size, len(_CLOSE)
    begin = (np.cumsum(size) - size.ravel()).reshape(turns, 5)
    out = np.empty(int(size.sum()), np.uint8)
    for column, fixed in ((0, _OPEN), (2, _COLON), (4, _CLOSE)):
        out[begin[:, column, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    for column, data, length in ((1, role, role_size), (3, text, text_size)):
        shift = begin[:, column] - (np.cumsum(length) - length)
        out[np.arange(len(data)) + np.repeat(shift, length)] = data
    first = np.append(0, np.cumsum(n_turns))
    edge = np.append(begin[:, 0], len(out))[first]
    points = np.append(0, np.cumsum(code_point_starts(out)))
    wanted = np.flatnonzero(pc.is_in(pc.fill_null(roles, ""), pa.array(list(learned))).to_numpy(zero_copy_only=False))
    conv = np.searchsorted(first, wanted, "right") - 1
    start = points[begin[wanted, 3]] - points[edge[conv]]
    stop = points[begin[wanted, 4]] - points[edge[conv]]
    ranges = pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], names=["start", "end"])
    per = np.bincount(conv, minlength=len(n_turns))
    loss = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per)).astype(np.int32)), ranges)
    return text_array(out, np.diff(edge)), loss


def format_chat(turns: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rows (conv_id, turn, role, text) to (conv_id, n_turns, formatted, loss)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            held = lists.flatten()
            counts = lists.value_lengths().to_numpy()
            sizes = pc.fill_null(pc.binary_length(held.field("text")), 0).to_numpy() + 64
            first = np.append(0, np.cumsum(counts))
            ends = np.append(0, np.cumsum(sizes))[first[1:]]
            row = 0
            while row < batch.num_rows:
                before = ends[row - 1] if row else 0
                stop = max(row + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right")))
                part = held.slice(first[row], first[stop] - first[row])
                formatted, loss = assemble(part.field("role"), part.field("text"), counts[row:stop], learned)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, stop - row), pa.array(counts[row:stop].astype(np.int64)), formatted, loss], names=["conv_id", "n_turns", "formatted", "loss"])
                row = stop

    return conversations(turns).mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns that a formatted text holds, and the texts under its loss mask."""

    def plain(text: str) -> str:
        return _ESCAPE.sub(r"\1", text) if "\\" in text else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts, under = [], [], []
            for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = _TURN.findall(text)
                if sum(len(r) + len(t) for r, t in found) + len(found) * len(_OPEN + _COLON + _CLOSE) != len(text):
                    raise ValueError("a text does not follow the template")
                roles.append([plain(r) for r, _ in found])
                texts.append([plain(t) for _, t in found])
                under.append([plain(text[x["start"] : x["end"]]) for x in loss])
            kind = pa.list_(pa.string())
            chars = pc.cast(pc.utf8_length(batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, kind) for x in (roles, texts, under)), chars], names=["conv_id", "roles", "texts", "learned", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, READ)
