"""Runs (maximal periodic stretches of words) of whole texts by an enhanced suffix array.

The words of a block of texts are numbered exactly, and prefix doubling over these numbers gives the classes of
equal stretches of 2**k words, the suffix array and its inverse ISA; the text goes into the first class, so
suffixes of different texts never share an interval. Longest common prefixes of neighbours follow from the
classes. For each LCP interval, of depth d, every suffix i of all children but the largest is tested: if
ISA[i + d] or ISA[i - d] lies in the interval but in another child, two words sequences of length d meet there and
go on differently: a branching square. No tree nodes are made, an interval is a range of the array. A branching
square is the last square of its run; rotating it to the left, word by word as long as the words d apart agree
(in steps of powers of two, by the classes), gives the run. Squares of one run with several periods are merged
to the smallest.

Everything is numpy over a block of texts of about 2 MB or one longer text; tasks need memory in proportion to
the words of a block times the logarithm of its longest repeat.

Words are runs of bytes other than white space. A null or empty text, or one without words, has no runs and
collapses to the empty text; a text without runs collapses to its words joined by one space. Repeated rows give
repeated results; there are no ties, since a run is fixed by its start, end and smallest period. Extra columns
stay, except those named like the output; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowloom.llm.arrowtext import SPACED, appended, spans, text_array, text_bytes, word_numbers

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])


def classes(word: np.ndarray, text: np.ndarray, width: int = 63) -> list[np.ndarray]:
    """For k = 0, 1, ...: the class of the 2**k words from each place on, named by the rank of its first suffix.

    The last array has no equal entries: it is the inverse suffix array. Stretches that reach the end of their
    text are alone in their class. One more entry stands for the end of all texts. Three numbers of up to ``width``
    bits together are sorted as one.
    """
    n = len(word)
    key = text * (int(word.max(initial=0)) + 1) + word
    order = np.argsort(key, kind="stable")
    new = np.append(True, np.diff(key[order]) != 0)[:n]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else order
    rank = np.full(n + 1, n, np.int64)
    rank[order] = head
    alone = new & np.append(new[1:], True) if n else new
    active = order[~alone]  # by rank
    levels, step, bits = [rank], 1, n.bit_length()
    while len(active):
        first, second = rank[active], rank[active + step]
        if 3 * bits <= width:
            packed = np.sort((((first << bits) | second) << bits) | np.arange(len(active)))
            place, pair = packed & ((1 << bits) - 1), packed >> bits
            new = np.append(True, pair[1:] != pair[:-1])
        else:
            place = np.lexsort((second, first))
            new = np.append(True, (np.diff(first[place]) != 0) | (np.diff(second[place]) != 0))
        at = np.arange(len(active))
        old = np.append(True, np.diff(first[place]) != 0)  # groups of the level before lie together
        base = np.maximum.accumulate(np.where(old, at, 0))
        head = first[place] + np.maximum.accumulate(np.where(new, at, 0)) - base
        rank = rank.copy()
        rank[active[place]] = head
        levels.append(rank)
        active = active[place][~(new & np.append(new[1:], True))]
        step *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], suffixes: np.ndarray) -> np.ndarray:
    """Words shared by the suffixes at r - 1 and r of the suffix array; zero at both ends."""
    n = len(suffixes)
    out = np.zeros(n + 1, np.int64)
    if n < 2:
        return out
    i, j = suffixes[:-1], suffixes[1:]
    near = np.flatnonzero(levels[0][i] == levels[0][j])
    i, j = i[near], j[near]
    depth = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        same = levels[k][i + depth] == levels[k][j + depth]
        depth += same.astype(np.int64) << k
    out[near + 1] = depth
    return out


def enclosing(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest places with a smaller value, before and behind each of ``places`` (there always are some)."""
    zero = np.flatnonzero(values == 0)
    longest = int(np.diff(zero).max(initial=1))
    least = [values]
    while 1 << len(least) < longest:
        last, width = least[-1], 1 << (len(least) - 1)
        least.append(np.minimum(last[: len(values) - 2 * width + 1], last[width : len(values) - width + 1]))
    left, right, value = places.copy(), places.copy(), values[places]
    for k in range(len(least) - 1, -1, -1):
        table, width = least[k], 1 << k
        go = (left >= width) & (table[np.minimum(np.maximum(left - width, 0), len(table) - 1)] >= value)
        left[go] -= width
        go = (right + width < len(values)) & (table[np.minimum(right + 1, len(table) - 1)] >= value)
        right[go] += width
    return left - 1, right + 1


def branching_squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of every square whose two halves are followed by different words."""
    inverse = levels[-1]
    n = len(inverse) - 1
    suffixes = np.empty(n, np.int64)
    suffixes[inverse[:n]] = np.arange(n)
    lcp = common_prefixes(levels, suffixes)
    cut = np.flatnonzero(lcp > 0)
    if not len(cut):
        return cut, cut
    low, high = enclosing(lcp, cut)  # the interval is low .. high - 1
    order = np.lexsort((cut, high, low))
    cut, low, high = cut[order], low[order], high[order]
    first = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
    interval = np.cumsum(first) - 1
    opening = np.flatnonzero(first)
    # Children: from the interval's low end to its first cut, and from every cut to the next one.
    owner = np.concatenate((interval, np.arange(len(opening))))
    begin = np.concatenate((cut, low[opening]))
    order = np.lexsort((begin, owner))
    owner, begin = owner[order], begin[order]
    end = np.append(begin[1:], 0)
    last = np.append(owner[1:] != owner[:-1], True)
    end[last] = high[opening]
    size = end - begin
    # All children but the (first) largest of each interval.
    by_size = np.lexsort((begin, -size, owner))
    largest = by_size[np.append(True, np.diff(owner[by_size]) != 0)]
    small = np.ones(len(size), bool)
    small[largest] = False
    owner, begin, end, size = owner[small], begin[small], end[small], size[small]
    child = np.repeat(np.arange(len(size)), size)
    at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    suffix, depth = suffixes[at], lcp[cut[opening]][owner][child]
    low, high, begin, end = low[opening][owner][child], high[opening][owner][child], begin[child], end[child]
    starts, halves = [], []
    for shift in (depth, -depth):
        other = suffix + shift
        inside = (other >= 0) & (other < n)
        rank = inverse[np.where(inside, other, n)]
        found = inside & (rank >= low) & (rank < high) & ((rank < begin) | (rank >= end))
        starts.append(np.minimum(suffix, other)[found])
        halves.append(depth[found])
    pairs = np.unique(np.stack((np.concatenate(starts), np.concatenate(halves))), axis=1)
    return pairs[0], pairs[1]


def _agree(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether ``length`` words from i and from j on agree, for i < j."""
    level = np.frexp(length.astype(np.float64))[1] - 1
    out = np.zeros(len(i), bool)
    for k in np.unique(level):
        if k >= len(levels) - 1:
            continue  # all stretches of that length differ
        own = np.flatnonzero(level == k)
        tail = length[own] - (1 << int(k))
        out[own] = (levels[k][i[own]] == levels[k][j[own]]) & (levels[k][i[own] + tail] == levels[k][j[own] + tail])
    return out


def find_runs(word: np.ndarray, first: np.ndarray, exponent: int = 2, least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run of ``exponent`` periods and ``least`` words or more.

    ``first``: where each text's words begin, with the number of words last. Sorted by start, then period.
    """
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    levels = classes(word, text)
    start, period = branching_squares(levels)
    end = start + 2 * period
    # The run reaches back far enough for the asked length.
    need = np.maximum(exponent * period, least)
    far = end - need
    kept = far >= first[text[start]] if len(start) else np.zeros(0, bool)
    start, period, end, need, far = start[kept], period[kept], end[kept], need[kept], far[kept]
    kept = _agree(levels, far, far + period, need - period)
    start, period, end = start[kept], period[kept], end[kept]
    floor = first[text[start]] if len(start) else start
    for k in range(len(levels) - 2, -1, -1):
        back = start - (1 << k)
        inside = back >= floor
        same = inside & (levels[k][np.where(inside, back, 0)] == levels[k][np.where(inside, back, 0) + period])
        start = np.where(same, back, start)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    once = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0))[: len(start)]
    start, end, period = start[once], end[once], period[once]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _found(column: pa.Array, exponent: int, least: int) -> list[pa.Array]:
    data, offsets = text_bytes(column)
    starts, ends, first = spans(data, offsets, SPACED)
    word = word_numbers(data, starts, ends)
    start, end, period = find_runs(word, first, exponent, least)
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    counts = np.bincount(text[start], minlength=n) if len(start) else np.zeros(n, np.int64)
    listed = pa.StructArray.from_arrays([pa.array(start - first[text[start]] if len(start) else start), pa.array(end - start), pa.array(period)], names=RUN.names)
    bounds = np.append(0, np.cumsum(counts)).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(bounds), listed)
    # What a run holds behind its first period goes.
    depth = np.zeros(len(word) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    stay = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    width = ends[stay] - starts[stay] + 1  # with a space behind, unless it is the text's last
    owner = text[stay]
    width -= np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    begin = np.cumsum(width) - width
    at = np.arange(int(width.sum())) + np.repeat(starts[stay] - begin, width)
    out = data[np.minimum(at, len(data) - 1)] if len(at) else np.zeros(0, np.uint8)
    gap = np.repeat(ends[stay], width)
    out[at >= gap] = 32
    return [runs, text_array(out, np.bincount(owner, width, n).astype(np.int64))]


def with_runs(docs: DataFrame, text: str = "text", exponent: int = 2, least: int = 2) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words, by start, then period), and ``collapsed``: the
    words joined by one space, without what any run holds behind its first period."""
    fields = [T.StructField("runs", T.ArrayType(RUN, False), False), T.StructField("collapsed", T.StringType(), False)]
    return appended(docs, text, fields, lambda column: _found(column, exponent, least))
