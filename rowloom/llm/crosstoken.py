"""Alignment of the tokens of two vocabularies over the same text, and corpus counts of their overlaps.

A is a byte-level vocabulary of the tokenizers library, which gets a space and the text; B is a merge-type
vocabulary of ``pieces``, which puts that space before the text itself. Byte offsets where tokens of both end cut
the tokens into groups. A link is an A and a B token occurrence whose byte ranges overlap; the count of an id pair
is the number of its links in the whole corpus.

Neither vocabulary merges across a single space between two other characters, so a text is a row of units (a
space and what follows it) that are worked out once per block. An identity map, made once per worker, leads from
every A id to the B id of the same bytes. A group of one A and one B token that the map knows is counted in a
vector of the size of A's vocabulary, one per task; only the links of all other groups, summed per block, enter
the shuffle of id pairs. Blocks are written in the shared folder with their units and their distinct irregular
pairs; the pairs' totals come back to each block, so a frequent pair is one row per block and never a hot key.
The driver gets one number per A id and one per B id.

A null or empty text, or one whose joined tokens differ from a space and the text (it holds U+2581, say), has no
tokens: zeros and an empty string of groups; it adds to no count. Repeated rows count each time, null ids are
kept, ties at a B id's highest count are all best. Strings of special tokens are plain text. Texts are never
cut; memory follows a block of BLOCK_BYTES or one longer text. Extra columns are not used by the functions over
the corpus and are kept by ``groups``. An empty table gives an empty table and no counts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm import pieces
from rowloom.llm.arrowtext import appended, blocks, text_array, text_bytes
from rowloom.llm.backoff import packed, unpacked
from rowloom.session import stored

BLOCK_BYTES = 2 << 20
#: Units that go through A's library at once, and units whose ids a worker keeps.
TOGETHER, KEPT = 5_000, 100_000

#: White space before which no unit is cut: what a split by words could join to the space.
_WHITE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ODD = rf" [{_WHITE}]|^ | $|^$"
_CUT = re.compile(r"(?<! ) (?=\S)")

#: What a block remembers of its units, as packed 32-bit numbers: Spark only carries it.
_PACKED = ("n_units", "unit", "times", "n_same", "same", "n_odd", "odd")
_PER_DOC = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = (
    "block long, doc_id array<long>, " + ", ".join(f"{name} array<long>" for name in _PER_DOC) + ", digest array<string>, "
    "n_units binary, unit binary, times binary, n_same binary, same binary, n_odd binary, odd binary, "
    "pair array<long>, pair_count array<long>, vector array<long>"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _trimmed(table: dict[str, bytes], wanted: list[str]) -> dict[str, bytes]:
    """``table``, or if it would grow too large only what is wanted now: frequent words come in every block."""
    return table if len(table) + len(wanted) <= KEPT else {w: table[w] for w in wanted if w in table}


class Pair:
    """Both tokenizers with the bytes of all their ids and the identity map."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(a)
        self.first.encode_special_tokens = True
        self.second = pieces.vocabulary(b)
        self.a_table: dict[str, bytes] = {}
        self.b_table: dict[str, bytes] = {}
        # Byte-level entries: printable characters stand for their own byte, others from U+0100 on for the rest.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(x): x for x in own} | {chr(0x100 + k): x for k, x in enumerate(sorted(set(range(256)) - set(own)))}
        special = {i for i, token in self.first.get_added_tokens_decoder().items() if token.special}
        entries = sorted(self.first.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.a_bytes = [b""] * (entries[-1][1] + 1)
        for entry, i in entries:
            self.a_bytes[i] = entry.encode() if i in special else bytes(byte_of[c] for c in entry)
        v = self.second
        self.b_bytes = [v.surface[s : s + n].tobytes() for s, n in zip(v.begins.tolist(), v.lengths.tolist())]
        by_bytes = {}
        for i in np.lexsort((np.arange(len(self.b_bytes)), v.is_byte)).tolist():  # whole pieces go before byte pieces
            if self.b_bytes[i] and i != v.unknown:
                by_bytes.setdefault(self.b_bytes[i], i)
        self.same = np.array([by_bytes.get(x, -1) for x in self.a_bytes], np.int64)
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (pa.array([str(i) for i in range(len(t))], pa.large_string()) for t in (self.a_bytes, self.b_bytes))
        self.a_flat, self.b_flat = (np.frombuffer(b"".join(t), np.uint8) for t in (self.a_bytes, self.b_bytes))

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and how many each unit has, ids of B and how many."""
        marked = [pieces.MARK + u.replace(" ", pieces.MARK) for u in units]
        self.a_table, self.b_table = (_trimmed(t, names) for t, names in ((self.a_table, units), (self.b_table, marked)))
        new = [u for u in units if u not in self.a_table]
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            ids = [np.array(e.ids, np.int32).tobytes() for e in self.first.encode_batch_fast([" " + u for u in some], add_special_tokens=False)]
            self.a_table.update(zip(some, ids))
        out = []
        for raw in ([self.a_table[u] for u in units], self.second.ids_of(marked, self.b_table)):
            out += [np.frombuffer(b"".join(raw), np.int32).astype(np.int64), np.array([len(r) >> 2 for r in raw], np.int64)]
        return tuple(out)


@lru_cache(maxsize=2)
def tokenizers(a: str, b: str) -> Pair:
    return Pair(a, b)


def _units(texts: pa.Array) -> pa.ListArray:
    """Each text as its units, without their leading space. The empty text has none."""
    cut = pc.split_pattern(texts, " ")
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    if odd.any():
        rows, fixed = cut.to_pylist(), texts.to_pylist()
        for i in np.flatnonzero(odd).tolist():
            whole = " " + fixed[i]
            at = [0, *(m.start() for m in _CUT.finditer(whole, 1)), len(whole)]
            rows[i] = [whole[x + 1 : y] for x, y in zip(at, at[1:])] if fixed[i] else []
        cut = pa.array(rows, pa.list_(pa.string()))
    return cut


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges start .. start + size - 1, one range behind the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whole-number sums of rows that lie one behind the other."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Units:
    """Groups and links of distinct units."""

    def __init__(self, both: Pair, units: list[str]):
        a, n_a, b, n_b = both.encode(units)
        # Units whose bytes do not come back have no tokens; their texts have none either.
        given = [(" " + u).encode() for u in units]
        size = np.array([len(g) for g in given], np.int64)
        self.whole = (_sums(both.a_size[a], n_a) == size) & (_sums(both.b_size[b], n_b) == size)
        for ids, counts, sizes, flat in ((a, n_a, both.a_size, both.a_flat), (b, n_b, both.b_size, both.b_flat)):
            begins = np.cumsum(sizes) - sizes
            keep = np.repeat(self.whole, counts)
            joined = flat[_ranges(begins[ids[keep]], sizes[ids[keep]])]
            want = np.frombuffer(b"".join(g for g, w in zip(given, self.whole.tolist()) if w), np.uint8)
            if not np.array_equal(joined, want):
                owner = np.repeat(np.flatnonzero(self.whole), size[self.whole])
                self.whole[np.unique(owner[joined != want])] = False
        a, b = a[np.repeat(self.whole, n_a)], b[np.repeat(self.whole, n_b)]
        self.n_a, self.n_b = np.where(self.whole, n_a, 0), np.where(self.whole, n_b, 0)
        a_end, b_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
        a_start, b_start = a_end - both.a_size[a], b_end - both.b_size[b]
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        a_unit = np.repeat(np.arange(len(units)), self.n_a)
        group_unit = np.zeros(len(ends), np.int64)
        group_unit[a_group] = a_unit
        per_a, per_b = np.bincount(a_group, minlength=len(ends)), np.bincount(b_group, minlength=len(ends))
        self.n_groups = np.bincount(group_unit, minlength=len(units))
        self.n_links = np.bincount(group_unit, per_a + per_b - 1, len(units)).astype(np.int64)
        # One token on both sides, as the identity map has them.
        first_a, first_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
        plain = (per_a == 1) & (per_b == 1)
        plain[plain] = both.same[a[first_a[plain]]] == b[first_b[plain]]
        self.same = a[first_a[plain]]
        self.n_same = np.bincount(group_unit[plain], minlength=len(units))
        # Links of all other groups: for each A token the B tokens that begin before its end and end behind its start.
        left = np.flatnonzero(~plain[a_group])
        low = np.searchsorted(b_end, a_start[left], "right")
        wide = np.searchsorted(b_start, a_end[left], "left") - low
        owner = np.repeat(left, wide)
        self.odd = (a[owner] << 32) | b[_ranges(low, wide)]
        self.n_odd = np.bincount(a_unit[owner], minlength=len(units))
        self.strings = self._strings(both, a, b, a_group, b_group, len(units))

    def _strings(self, both: Pair, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, n: int) -> pa.Array:
        """Per unit its groups as a1,a2|b1; each."""
        shown = pa.concat_arrays([both.a_text.take(pa.array(a)), both.b_text.take(pa.array(b))])
        group = np.concatenate((a_group, b_group))
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))
        group, side = group[order], side[order]
        last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[: len(group)]
        marks = pa.array([",", "|", ";"], pa.large_string()).take(pa.array(np.where(last, side + 1, 0)))
        joined = pc.binary_join_element_wise(shown.take(pa.array(order)), marks, pa.scalar("", pa.large_string()))
        data, offsets = text_bytes(joined)
        ends = offsets[np.append(0, np.cumsum(self.n_a + self.n_b))]
        return text_array(data, np.diff(ends))


class Block:
    """The texts of a block over its distinct units."""

    def __init__(self, both: Pair, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        listed = _units(texts)
        coded = listed.flatten().dictionary_encode()
        self.units = Units(both, coded.dictionary.to_pylist())
        unit = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
        broken = _sums(~self.units.whole[unit], counts) > 0
        self.unit = unit[np.repeat(~broken, counts)]
        self.counts = np.where(broken, 0, counts)

    def strings(self) -> pa.Array:
        """The groups of every text."""
        taken, offsets = text_bytes(self.units.strings.cast(pa.large_string()).take(pa.array(self.unit)))
        ends = offsets[np.append(0, np.cumsum(self.counts))]
        lengths = np.diff(ends)
        stay = np.ones(len(taken), bool)
        stay[ends[1:][lengths > 0] - 1] = False  # the last semicolon
        return text_array(taken[stay], lengths - (lengths > 0))

    def totals(self) -> list[np.ndarray]:
        """Tokens of A and B, groups and links of every text."""
        u = self.units
        return [_sums(x[self.unit], self.counts) for x in (u.n_a, u.n_b, u.n_groups, u.n_links)]


def groups(df: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """``df`` with the column ``groups``: ``a1,a2|b1;a3|b2,b3``, decimal ids of A and B in order."""
    return appended(df, text, [T.StructField("groups", T.StringType(), False)], lambda column: [Block(tokenizers(a, b), column).strings()], BLOCK_BYTES)


def aligned(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(doc_id, text) to written blocks: what their texts give by themselves, their units and irregular pairs, and
    in one more row per task the vector of counts of regular groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a, b)
        vector = np.zeros(len(both.a_bytes), np.int64)
        partition, number = TaskContext.get().partitionId(), 0

        def row(values: dict) -> pa.RecordBatch:
            arrays = []
            for field in schema:
                value = values.get(field.name)
                if field.name == "block":
                    arrays.append(pa.array([value], pa.int64()))
                elif value is None:
                    arrays.append(pa.array([None], field.type))
                elif field.name in _PACKED:
                    arrays.append(pa.array([packed(value.astype(np.int32))], pa.binary()))
                else:
                    inner = value if isinstance(value, pa.Array) else pa.array(value, field.type.value_type)
                    arrays.append(pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner))
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for given in blocks(batches, limit=BLOCK_BYTES):
            block = Block(both, given.column("text"))
            u = block.units
            digests = [hashlib.sha256(s.as_buffer()).hexdigest() if s.as_buffer().size else "" for s in block.strings()]
            seen = np.bincount(block.unit, minlength=len(u.whole))
            np.add.at(vector, u.same, np.repeat(seen, u.n_same))
            pair, odd = np.unique(u.odd, return_inverse=True)
            pair_count = np.zeros(len(pair), np.int64)
            np.add.at(pair_count, odd, np.repeat(seen, u.n_odd))
            # Each text's distinct units with how often it has them.
            owner = np.repeat(np.arange(len(block.counts)), block.counts)
            both_key, times = np.unique(owner * len(u.whole) + block.unit, return_counts=True)
            n_units = np.bincount(both_key // max(len(u.whole), 1), minlength=len(block.counts))
            number += 1
            yield row(
                {
                    "block": (partition << 32) | number, "doc_id": given.column("doc_id").cast(pa.int64()), **dict(zip(_PER_DOC, block.totals())), "digest": pa.array(digests, pa.string()),
                    "n_units": n_units, "unit": both_key % max(len(u.whole), 1), "times": times, "n_same": u.n_same, "same": u.same, "n_odd": u.n_odd, "odd": odd, "pair": pair, "pair_count": pair_count,
                }
            )
        if number:
            yield row({"vector": vector})

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T._parse_datatype_string(_BLOCK))
    return stored(docs.select("doc_id", "text").mapInArrow(run, _BLOCK), "aligned")


def regular_counts(table: DataFrame) -> DataFrame:
    """(a, n): links of regular groups per A id."""
    return table.where("vector IS NOT NULL").select(F.posexplode("vector").alias("a", "n")).where("n > 0").groupBy("a").agg(F.sum("n").alias("n"))


def irregular_counts(table: DataFrame) -> DataFrame:
    """(pair, n): links of all other groups per pair, a * 2**32 + b."""
    each = table.where("block IS NOT NULL").select(F.explode(F.arrays_zip("pair", "pair_count")).alias("p"))
    return each.groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.pair_count").alias("n"))


def pair_counts(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n): how many links of the corpus hold each pair of ids."""
    table = aligned(docs, a, b)
    same = tokenizers(a, b).same
    regular = regular_counts(table).select("a", F.get(F.lit(same.tolist()), F.col("a")).alias("b"), "n")
    odd = irregular_counts(table).select(F.expr("cast(pair >> 32 AS int) AS a"), F.expr("pair & 4294967295 AS b"), "n")
    return regular.union(odd).groupBy("a", "b").agg(F.sum("n").alias("n"))


def scored(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(doc_id, text) to _RESULT: tokens, groups, links, the links whose count is the highest of their B id
    (``n_best``), the sum of all links' counts, and the SHA-256 of the groups."""
    table = aligned(docs, a, b)
    odd = stored(irregular_counts(table), "pairs")
    both = tokenizers(a, b)
    same = both.same
    # Counts of the identity pairs, and of every B id's most frequent pair: one number per id.
    regular = np.zeros(len(same), np.int64)
    for i, n in regular_counts(table).collect():
        regular[i] += n
    known = [int((i << 32) | j) for i, j in enumerate(same.tolist()) if j >= 0]
    listed = docs.sparkSession.createDataFrame([(x,) for x in known], "pair long")
    for x, n in odd.join(F.broadcast(listed), "pair").select("pair", "n").collect():  # one row per A id at most
        regular[x >> 32] += n
    best = np.zeros(len(both.b_bytes), np.int64)
    for j, n in odd.groupBy(F.expr("pair & 4294967295").alias("b")).agg(F.max("n")).collect():
        best[j] = n
    np.maximum.at(best, same[same >= 0], regular[same >= 0])

    asked = table.where("block IS NOT NULL").select("block", F.explode("pair").alias("pair"))
    told = asked.join(odd, "pair").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pair", "n"))).alias("told"))
    fields = ["doc_id", *_PER_DOC, "digest", *_PACKED]
    joined = table.where("block IS NOT NULL").join(told, "block", "left").select(*fields, F.col("told.pair").alias("pair"), F.col("told.n").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number = {name: unpacked(batch.column(name)[i].as_py(), np.int32) for name in _PACKED}
                block = {name: batch.column(name)[i].values for name in ("doc_id", "digest", *_PER_DOC)}
                told = [batch.column(name)[i].values for name in ("pair", "n")]
                pair, n = (np.zeros(0, np.int64) if x is None else x.to_numpy(zero_copy_only=False) for x in told)
                twin = same[pair >> 32] == (pair & 0xFFFFFFFF)
                n = np.where(twin, regular[pair >> 32], n)
                top = (n == best[pair & 0xFFFFFFFF]).astype(np.int64)
                value = regular[number["same"]]
                own_top = (value == best[same[number["same"]]]).astype(np.int64)
                per_unit = [_sums(x, number["n_same"]) + _sums(y[number["odd"]], number["n_odd"]) for x, y in ((own_top, top), (value, n))]
                n_best, count_sum = (_sums(x[number["unit"]] * number["times"], number["n_units"]) for x in per_unit)
                yield pa.RecordBatch.from_arrays([block["doc_id"], *[block[name] for name in _PER_DOC], pa.array(n_best), pa.array(count_sum), block["digest"]], names=[f.split()[0] for f in _RESULT.split(", ")])

    return joined.mapInArrow(run, _RESULT)
