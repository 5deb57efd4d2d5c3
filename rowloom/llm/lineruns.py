"""Deletion of repeated runs of lines by prefix doubling over line ids.

Documents are rows of line ids: 128 bits of BLAKE2b of the line's bytes, as two longs (class, twin). Longer
classes are named by two hashes of such pairs, so names never rest on 64 bits.
Level k puts two places into one class if the 2**k lines from there on agree; level k + 1 joins each place with
the one 2**k lines further on. A place that is alone in its class can repeat nothing longer and leaves, so
levels shrink quickly. No suffix order and no longest common prefixes are computed: classes have names, not
ranks. The places that share a prefix of m lines, an interval of a suffix array, are those that agree in two
overlapping classes of level floor(log2 m), and only the m of the windows below are asked for.

A repeated run counts if it holds ``min_words`` words. Every maximal repeated run of that weight is the union
of the lightest sufficient windows that begin or end at its lines, so exactly those windows are looked up. The
first window of an interval, by document id and line, stays; lines of later ones are deleted, unless the later
window overlaps the first one in the same document (a short line repeated many times keeps one window's worth).
Every deleted line has an equal line that stays, earlier in that order.

Null texts have no lines and stay null; an empty text has one line without words. Rows alike in id and text
count as one document and stay alike. A null id comes before all others. Very long documents are cut into
rows of lines before any shuffle; hot lines meet only as counts, and in joins their places are spread over salts.
Extra columns stay as they are, unless they bear the name of an added column. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.arrowtext import SPACED, blocks, document_key, free_name, list_array, span_digests, spans, text_array, text_bytes
from rowloom.operators.joins import HOT_SHARE, skew_join
from rowloom.session import stored

#: A run of this many words is worth deleting.
MIN_WORDS = 50


def line_spans(data: np.ndarray, offsets: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the lines of all valid texts, and the text of each line."""
    feeds = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, feeds, "right") - 1
    keep = np.flatnonzero(valid)
    starts = np.concatenate((offsets[:-1][keep], feeds + 1))
    text = np.concatenate((keep, owner))
    ends = np.concatenate((offsets[1:][keep], feeds))
    by_start, by_end = np.lexsort((starts, text)), np.lexsort((ends, text))
    return starts[by_start], ends[by_end], text[by_start]


def light_windows(n_words: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and number of lines of the lightest windows with ``least`` words, from and up to every line.

    ``first``: index of the first line of each line's text, whose lines lie together.
    """
    n = len(n_words)
    total = np.append(0, np.cumsum(n_words))
    last = np.append(np.flatnonzero(first[1:] != first[:-1]), n - 1)[np.searchsorted(np.unique(first), first)] if n else first
    end = np.searchsorted(total, total[:-1] + least)  # lines start .. end - 1 hold enough
    start = np.searchsorted(total, total[1:] - least, "right") - 1  # the latest start for each last line
    ahead = end <= last + 1
    back = (start >= first) & (total[1:] - least >= 0)
    starts = np.concatenate((np.flatnonzero(ahead), start[back]))
    counts = np.concatenate(((end - np.arange(n))[ahead], (np.arange(n) + 1 - start)[back]))
    return starts, counts


def lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, key) to one row per line: class, size, and the numbers of lines of the windows from there."""
    schema = "key binary, doc_id long, line int, class long, twin long, windows array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            column = block.column("text")
            data, offsets = text_bytes(column)
            starts, ends, text = line_spans(data, offsets, column.is_valid().to_numpy(zero_copy_only=False))
            if not len(starts):
                continue
            words, _, _ = spans(data, offsets, SPACED)
            n_words = np.searchsorted(words, ends) - np.searchsorted(words, starts)
            first = np.searchsorted(text, text)
            at, count = light_windows(n_words, first, min_words)
            pairs = np.unique(at * (1 << 32) + count)
            at, count = pairs >> 32, pairs & 0xFFFFFFFF
            windows = list_array(count.astype(np.int32), np.bincount(at, minlength=len(starts)), pa.int32())
            rows = pa.array(text)
            name, twin = span_digests(data, starts, ends)
            yield pa.RecordBatch.from_arrays(
                [block.column("key").take(rows), block.column("doc_id").take(rows), pa.array((np.arange(len(text)) - first).astype(np.int32)), pa.array(name), pa.array(twin), windows],
                names=["key", "doc_id", "line", "class", "twin", "windows"],
            )

    return docs.select("key", "doc_id", "text").mapInArrow(run, schema)


def _hot(counted: DataFrame, keys: list[str], rows: DataFrame) -> DataFrame:
    """The keys that hold more than 1 / HOT_SHARE of all rows: HOT_SHARE at most."""
    total = rows.count()
    return counted.where(F.col("n") * HOT_SHARE > total).select(*keys)


def _shared(places: DataFrame) -> DataFrame:
    """The places whose class holds two or more."""
    keys = ["class", "twin"]
    twice = stored(places.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), "classes")
    return skew_join(places, twice.select(*keys), keys, "left_semi", _hot(twice, keys, places)).select("key", "line", *keys)


def later_copies(table: DataFrame) -> DataFrame:
    """From the table of ``lines``: (key, line, n) of the windows that repeat an earlier one."""
    wanted = table.select("key", "doc_id", "line", F.explode("windows").alias("n"))
    level = stored(_shared(table.select("key", "line", "class", "twin")), "level")
    found, length = None, 1
    while True:
        # Windows of length .. 2 * length - 1 lines: the class at the start and the one that reaches the end.
        own = wanted.where((F.col("n") >= length) & (F.col("n") < 2 * length))
        left = level.select("key", "line", F.col("class").alias("c1"), F.col("twin").alias("s1"))
        right = level.select("key", (F.col("line")).alias("tail"), F.col("class").alias("c2"), F.col("twin").alias("s2"))
        both = stored(own.withColumn("tail", F.expr(f"line + n - {length}").cast("int")).join(left, ["key", "line"]).join(right, ["key", "tail"]), "windows")
        interval = ["n", "c1", "c2", "s1", "s2"]
        place = F.struct("doc_id", "key", "line")
        firsts = stored(both.groupBy(*interval).agg(F.min(place).alias("first"), F.count("*").alias("n_places")).where("n_places > 1"), "firsts")
        hot = _hot(firsts.withColumnRenamed("n", "__n").withColumnRenamed("n_places", "n"), ["__n", *interval[1:]], both).withColumnRenamed("__n", "n")
        copies = skew_join(both, firsts.drop("n_places"), interval, "inner", hot).where(
            F.expr("NOT (key = first.key AND line < first.line + n)")
        ).select("key", "line", "n")
        copies = stored(copies, "copies")
        found = copies if found is None else found.union(copies)
        if wanted.where(F.col("n") >= 2 * length).limit(1).count() == 0:
            return found
        ahead = level.select("key", (F.col("line") - length).alias("line"), F.col("class").alias("c2"), F.col("twin").alias("s2"))
        names = F.xxhash64("class", "twin", "c2", "s2").alias("class"), F.xxhash64(F.lit(length), "s2", "c2", "twin", "class").alias("twin")
        doubled = level.join(ahead, ["key", "line"]).select("key", "line", *names)
        level = stored(_shared(doubled), "level")
        if level.limit(1).count() == 0:
            return found
        length *= 2


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs taken out of ``text``, and the counts n_lines and n_removed."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    own, gone_ = free_name(kept, "__key"), free_name(kept, "__spans")
    keyed = docs.select(*[f"`{c}`" for c in kept]).withColumn(own, document_key("doc_id", "text"))
    table = stored(lines(keyed.select(F.col(own).alias("key"), "doc_id", "text"), min_words), "lines")
    if table.where("line = 0").groupBy("key").count().where("count > 1").limit(1).count():  # rows alike in id and text
        table = stored(table.dropDuplicates(["key", "line"]), "lines")
    copies = later_copies(table)
    spans_ = copies.groupBy("key").agg(F.collect_set(F.struct("line", "n")).alias(gone_)).withColumnRenamed("key", own)
    joined = keyed.join(spans_, own, "left")
    fields = [f for f in keyed.schema.fields if f.name != own]
    names = [f.name for f in fields]
    at = names.index("text")
    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            columns = [block.column(i) for i in range(len(names))]
            removed = block.column(len(names))
            data, offsets = text_bytes(columns[at])
            valid = columns[at].is_valid().to_numpy(zero_copy_only=False)
            starts, ends, text = line_spans(data, offsets, valid)
            first = np.searchsorted(text, np.arange(len(valid)))
            per = np.nan_to_num(removed.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = removed.flatten()
            begin = np.repeat(first, per) + flat.field("line").to_numpy()
            depth = np.zeros(len(starts) + 1, np.int64)
            np.add.at(depth, begin, 1)
            np.add.at(depth, begin + flat.field("n").to_numpy(), -1)
            gone = np.cumsum(depth[:-1]) > 0
            # A line goes with its line feed; the last line of a text takes the feed before it instead.
            stay = np.ones(len(data), bool)
            size = np.where(ends < offsets[1:][text], ends + 1, ends) - starts
            cut = np.flatnonzero(gone)
            spot = np.arange(int(size[cut].sum())) + np.repeat(starts[cut] - (np.cumsum(size[cut]) - size[cut]), size[cut])
            stay[spot] = False
            lengths = np.diff(np.append(0, np.cumsum(stay))[offsets])
            out = data[stay]
            ended = np.bincount(text[~gone], minlength=len(valid)) > 0
            last = np.append(first[1:], len(starts)) - 1
            trailing = valid & ended & gone[np.maximum(last, 0)] if len(starts) else np.zeros(len(valid), bool)
            if trailing.any():
                keep = np.ones(len(out), bool)
                keep[np.cumsum(lengths)[trailing] - 1] = False
                out, lengths = out[keep], lengths - trailing
            new = text_array(out, lengths)
            if not valid.all():
                new = pa.array(new.to_pylist(), pa.string(), mask=~valid)
            columns[at] = new
            count = np.bincount(text, minlength=len(valid))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count), pa.array(np.bincount(text[gone], minlength=len(valid)))], names=[*names, "n_lines", "n_removed"])

    return joined.select(*[f"`{n}`" for n in names], gone_).mapInArrow(run, schema)
