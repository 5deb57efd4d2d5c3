"""Counts of words, symbols, repeated lines and repeated word windows of whole texts, in numpy.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
A null or empty text has no words; a null one has no lines. Equal hashes only nominate lines and windows; each
nominee is compared with the first of its hash byte for byte (lines) or word by word (windows; equal words have
equal numbers in the block, given by an exact dictionary). Texts are worked on in blocks of some megabytes or one
longer text, whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from rowloom.llm.arrowtext import SPACED, byte_class, code_point_starts, mixed, span_hashes, spans, text_bytes, word_numbers

#: A repeated window has this many words.
WINDOW = 5
SYMBOLS = ~byte_class(*((ord(c), ord(c)) for c in "#*$%&|<>"))
_LINES = byte_class((10, 10))
_UPPER = ~byte_class((ord("A"), ord("Z")))
_MARKS = ~byte_class(*((ord(c), ord(c)) for c in "!?"))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
FIELDS = [T.StructField(name, T.LongType(), False) for name in COUNTS]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between the offsets."""
    return np.searchsorted(np.flatnonzero(flags), offsets[1:]) - np.searchsorted(np.flatnonzero(flags), offsets[:-1])


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of every key that occurs before, and index of its first occurrence."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1]) if len(keys) else np.zeros(0, bool)
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))] if len(keys) else order
    return order[~new], first[~new]


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them that equal an earlier line."""
    begin, end, first = spans(data, offsets, _LINES)
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end = begin[worded], end[worded]
    text = np.searchsorted(offsets, begin, "right") - 1
    hashes = span_hashes(data, begin, end)
    later, earlier = repeats(mixed(hashes + mixed(text.astype(np.uint64))))
    raw = data.tobytes()
    same = np.zeros(len(later), bool)
    unsure: list[int] = []
    for k, (i, j) in enumerate(zip(later.tolist(), earlier.tolist())):
        same[k] = text[i] == text[j] and raw[begin[i] : end[i]] == raw[begin[j] : end[j]]
        if not same[k]:
            unsure.append(i)
    for i in unsure:  # two lines with one hash: compare with all lines before
        line = raw[begin[i] : end[i]]
        k = int(np.flatnonzero(later == i)[0])
        same[k] = any(raw[begin[j] : end[j]] == line for j in range(int(np.searchsorted(text, text[i])), i))
    n = len(offsets) - 1
    return np.bincount(text, minlength=n), np.bincount(text[later[same]], minlength=n)


def _repeated_words(words: np.ndarray, bounds: np.ndarray, window: int) -> np.ndarray:
    """Per text: words inside windows that occur twice or more in the text."""
    n = len(words)
    texts = len(bounds) - 1
    if n < window:
        return np.zeros(texts, np.int64)
    text = np.repeat(np.arange(texts), np.diff(bounds))
    at = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
    key = mixed(text[at].astype(np.uint64))
    for k in range(window):
        key = mixed(key ^ words[at + k])
    later, earlier = repeats(key)
    i, j = at[later], at[earlier]
    same = text[i] == text[j]
    for k in range(window):
        same &= words[i + k] == words[j + k]
    depth = np.zeros(n + 1, np.int64)
    for places in (i[same], np.unique(j[same])):
        np.add.at(depth, places, 1)
        np.add.at(depth, places + window, -1)
    hit = np.cumsum(depth[:-1]) > 0
    return np.bincount(text[hit], minlength=texts)


def counts(column: pa.Array) -> list[pa.Array]:
    """The columns of COUNTS, one value per text."""
    data, offsets = text_bytes(column)
    starts, ends, bounds = spans(data, offsets, SPACED)
    points = np.append(0, np.cumsum(code_point_starts(data)))
    in_words = np.append(0, np.cumsum(points[ends] - points[starts]))
    n_lines, n_dup_lines = _repeated_lines(data, offsets, starts)
    found = {
        "n_words": np.diff(bounds),
        "word_chars": np.diff(in_words[bounds]),
        "n_symbols": per_text(SYMBOLS[data], offsets),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": _repeated_words(word_numbers(data, starts, ends).astype(np.uint64), bounds, WINDOW),
        "n_lines": n_lines,
        "n_upper": per_text(_UPPER[data], offsets),
        "n_marks": per_text(_MARKS[data], offsets),
    }
    return [pa.array(found[name].astype(np.int64)) for name in COUNTS]
