"""SentencePiece encoding and decoding for merge-type vocabularies.

The text, with spaces turned into the mark U+2581 and one mark before it, is a row of symbols (code
points). An agenda of adjacent pairs whose joint string is a piece is worked off by score, the leftmost of
equal scores first; each merge brings up to two new pairs. No piece of the vocabularies treated here has a
mark after another character (checked on loading), so merges never cross the place where a word ends and
marks begin. Words are therefore independent, and a distinct word is worked out once per worker and kept
in a table of bounded size. The new words of an Arrow block share one agenda in numpy, which pops the best
pair of every word at once; words of over 48 symbols use a heap.

Nulls: a null text is encoded as the empty text, and null ids are decoded as the empty text. The empty text
has no ids. Code points outside the vocabulary become byte pieces. Repeated rows give repeated results; an
empty table gives an empty table; extra columns are kept (one named like the output is replaced).
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowloom.llm.arrowtext import appended, list_array, text_array

MARK = "▁"
#: Distinct words a worker keeps; the table is begun anew when it is full.
KEPT_WORDS = 100_000
#: Bytes of text that are encoded, and ids that are decoded, at once.
TEXT_BYTES, IDS = 2 << 20, 1 << 18
#: Words with more symbols than this use the heap.
SHORT = 48
#: Short words that share one agenda.
TOGETHER = 4096
#: The numpy table of pairs has so many slots.
SLOT_BITS = 19
SLOTS = 1 << SLOT_BITS
_SPREAD = 0x9E3779B97F4A7C15

_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_NONE = np.int32(2**31 - 1)
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


class Vocabulary:
    """The pieces of a model file, with the table of pairs that merge."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces):
            raise ValueError("only merge-type vocabularies with plain text normalisation are supported")
        kinds = [p.type for p in model.pieces]
        if {_USER, _UNUSED} & set(kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        self.pieces = [p.piece for p in model.pieces]
        self.unknown = kinds.index(_UNKNOWN)
        self.control = np.array([k == _CONTROL for k in kinds])
        self.is_byte = np.array([k == _BYTE for k in kinds])
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece has a space mark after another character")
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if kinds[i] == _BYTE}

        # Symbols: every piece by its id, then the characters that occur in pieces without being one.
        symbols = dict(normal)
        for p in normal:
            for c in p:
                if c not in symbols:
                    symbols[c] = len(self.pieces) + len(symbols)
        self.symbol = symbols
        # Equal scores rank alike, a higher score first; of equals the leftmost merges first.
        level = {s: r for r, s in enumerate(sorted({model.pieces[i].score for i in normal.values()}, reverse=True))}
        pairs = {}
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = (level[model.pieces[i].score], i)
        if len(pairs) * 2 > SLOTS:
            raise ValueError("the vocabulary has too many pairs for the table")
        self.pairs = pairs
        # The same table for numpy: slots by a multiplicative hash, the next free slot on a clash. Slot
        # number SLOTS stands for "does not merge".
        self.keys = np.full(SLOTS + 1, -1, np.int64)
        self.levels = np.full(SLOTS + 1, _NONE, np.int32)
        self.merged = np.zeros(SLOTS + 1, np.int32)
        for key, (rank, piece) in pairs.items():
            slot = (key * _SPREAD % 2**64) >> (64 - SLOT_BITS)
            while self.keys[slot] >= 0:
                slot = (slot + 1) % SLOTS
            self.keys[slot], self.levels[slot], self.merged[slot] = key, rank, piece

        surface = [b"" if kinds[i] == _CONTROL else " ⁇ ".encode() if kinds[i] == _UNKNOWN else bytes([int(p[3:5], 16)]) if kinds[i] == _BYTE else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.marked = np.array([k == _NORMAL and p.startswith(MARK) for p, k in zip(self.pieces, kinds)])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair in the table."""
        key = (left.astype(np.int64) << 32) | right
        slot = ((key.view(np.uint64) * np.uint64(_SPREAD)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        there = self.keys[slot]
        clash = np.flatnonzero((there != key) & (there >= 0))
        slot[there < 0] = SLOTS
        while len(clash):
            slot[clash] = (slot[clash] + 1) % SLOTS
            there = self.keys[slot[clash]]
            slot[clash[there < 0]] = SLOTS
            clash = clash[(there != key[clash]) & (there >= 0)]
        return slot

    def _final(self, symbol: int, text: str) -> list[int]:
        if 0 <= symbol < len(self.pieces):
            return [symbol]
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in text.encode("utf-8", "replace")]

    def one(self, word: str) -> bytes:
        """Ids of a word by a heap of pairs (score level, place)."""
        text = list(word)
        sym = [self.symbol.get(c, -1) for c in text]
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.pairs.get
        heap = [(found[0], i, sym[i], sym[i + 1], found[1]) for i in range(n - 1) if (found := get((sym[i] << 32) | sym[i + 1]) if sym[i] >= 0 <= sym[i + 1] else None)]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], alive[j], after[i] = merged, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and sym[left] >= 0 <= sym[right] and (found := get((sym[left] << 32) | sym[right])):
                    heapq.heappush(heap, (found[0], left, sym[left], sym[right], found[1]))
        ids = []
        for i in range(n):
            if alive[i]:
                ids += self._final(sym[i], text[i])
        return np.array(ids, np.int32).tobytes()

    def many(self, words: list[str]) -> list[bytes]:
        """Ids of short words: one agenda for some thousand of them, which pops the best pair of each at once."""
        words_by_size = sorted(range(len(words)), key=lambda i: len(words[i]))
        out: list[bytes] = [b""] * len(words)
        for at in range(0, len(words), TOGETHER):
            group = words_by_size[at : at + TOGETHER]
            for i, raw in zip(group, self._agenda([words[i] for i in group])):
                out[i] = raw
        return out

    def _agenda(self, words: list[str]) -> list[bytes]:
        """One row of symbols per word. A pair stands at the place of its left symbol; the last column is
        no symbol and stands before the first and behind the last."""
        sizes = np.array([len(w) for w in words])
        chars = "".join(words)
        names = {c: self.symbol.get(c, -1) for c in set(chars)}  # -1 never merges
        n, width = len(words), int(sizes.max()) + 1
        inside = np.arange(width) < sizes[:, None]
        sym = np.full((n, width), -1, np.int64)
        sym[inside] = np.fromiter(map(names.__getitem__, chars), np.int64, len(chars))
        after = np.where(np.arange(1, width + 1) < sizes[:, None], np.arange(1, width + 1), width - 1)
        before = np.where(inside, np.arange(-1, width - 1), -1) % width
        slot = np.full((n, width), SLOTS, np.int64)
        slot[:, :-1] = self.lookup(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, width - 1)
        slot[np.arange(n), sizes - 1] = SLOTS
        level = self.levels[slot]
        there = inside.copy()
        sym_, after_, before_, slot_, level_, there_ = (x.ravel() for x in (sym, after, before, slot, level, there))
        rows, agenda = np.arange(n), level
        while True:
            place = agenda.argmin(axis=1)  # the best pair of each word, the leftmost of equals
            going = agenda[np.arange(len(rows)), place] < _NONE
            if not going.all():
                rows, place = rows[going], place[going]
                if not len(rows):
                    break
            base = rows * width
            at = base + place
            gone = base + after_[at]
            nxt = after_[gone]
            sym_[at] = self.merged[slot_[at]]
            there_[gone], level_[gone], after_[at] = False, _NONE, nxt
            before_[base + nxt] = place
            for left, right in ((base + before_[at], at), (at, base + nxt)):  # pairs that the merge has changed
                found = self.lookup(sym_[left], sym_[right])
                slot_[left], level_[left] = found, self.levels[found]
            agenda = level[rows]
        plain = ((sym >= 0) & (sym < len(self.pieces)) | ~there).all(axis=1)
        raw, cuts = sym[there].astype(np.int32).tobytes(), np.append(0, np.cumsum(there.sum(axis=1)) * 4).tolist()
        # A word with a character that is no piece ends in byte pieces; the heap writes those.
        return [raw[a:b] if ok else self.one(w) for a, b, ok, w in zip(cuts, cuts[1:], plain.tolist(), words)]

    def ids_of(self, words: list[str], table: dict[str, bytes]) -> list[bytes]:
        """Ids of distinct words, from the table or else by an agenda."""
        new = [w for w in words if w not in table]
        if len(table) + len(new) > KEPT_WORDS:
            table.clear()
            new = words
        short = [w for w in new if len(w) <= SHORT]
        table.update(zip(short, self.many(short)))
        table.update((w, self.one(w)) for w in new if len(w) > SHORT)
        return [table[w] for w in words]

    def encode(self, texts: pa.Array, table: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        texts = pc.fill_null(texts, "")
        cut = pc.split_pattern(texts, " ")
        if len(texts) and pc.any(pc.match_substring_regex(texts, f"^ |  | $|{MARK}|^$")).as_py():
            # Marks that do not stand alone before a word belong to the word behind them.
            whole = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts.to_pylist()]
            cut = pa.array([[w[1:] for w in words] for words in whole], pa.list_(pa.string()))
        coded = cut.flatten().dictionary_encode()
        known = self.ids_of([MARK + w for w in coded.dictionary.to_pylist()], table)
        sizes = np.array([len(r) >> 2 for r in known], np.int64)
        order = coded.indices.to_numpy()
        words = np.append(0, np.cumsum(sizes[order])) if len(order) else np.zeros(1, np.int64)
        ids = list_array(np.frombuffer(b"".join(known), np.int32), sizes, pa.int32()).take(coded.indices).flatten().to_numpy()
        offsets = np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy()))
        return ids, np.diff(words[offsets])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts in one array, and how many each has."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            raise ValueError("an id is outside the vocabulary")
        size = self.lengths[ids]
        source = self.begins[ids].copy()
        owner = np.repeat(np.arange(len(counts)), counts)
        shown = np.flatnonzero(~self.control[ids])
        lead = shown[np.append(True, owner[shown[1:]] != owner[shown[:-1]])] if len(shown) else shown
        lead = lead[self.marked[ids[lead]]]  # the mark put before the text
        source[lead] += 1
        size[lead] -= 1
        ends = np.cumsum(size)
        out = self.surface[np.arange(ends[-1] if len(ends) else 0) + np.repeat(source - (ends - size), size)]
        lengths = np.bincount(owner, size, len(counts)).astype(np.int64)
        return out, lengths


def _well_formed(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each byte that is no part of valid UTF-8 by U+FFFD."""
    try:
        data.tobytes().decode("utf-8")
        if not len(data) or ((data[(np.cumsum(lengths) - lengths)[lengths > 0]] & 0xC0) != 0x80).all():
            return data, lengths
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    for n in lengths.tolist():
        raw, at = data[at : at + n].tobytes(), at + n
        text = raw.decode("utf-8", "surrogateescape")
        out.append(re.sub("[\udc80-\udcff]", "�", text).encode())
    return np.frombuffer(b"".join(out), np.uint8), np.array([len(x) for x in out], np.int64)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def _table(path: str) -> dict[str, bytes]:
    return {}


def _decoded(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of the ids, some hundred thousand ids (or one text) at once."""
    ends, row, parts = np.cumsum(counts), 0, []
    while row < len(counts):
        before = int(ends[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + IDS, "right")))
        parts.append(text_array(*_well_formed(*vocab.decode(ids[before : ends[stop - 1]], counts[row:stop]))))
        row = stop
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids", back: str | None = None) -> DataFrame:
    """``df`` with the ids of the whole text, and in column ``back`` what these ids decode to, if that is asked
    for. ``model`` is the model file's path on every executor."""

    def make(column: pa.Array) -> list[pa.Array]:
        values, counts = vocabulary(model).encode(column, _table(model))
        made = [list_array(values, counts, pa.int32())]
        return [*made, _decoded(vocabulary(model), values, counts)] if back else made

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    return appended(df, text, fields + ([T.StructField(back, T.StringType())] if back else []), make, TEXT_BYTES)


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text that the ids stand for."""
    fields = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*fields, T.StructField(text, T.StringType())])
    names = [f.name for f in fields]

    def run(batches):
        for batch in batches:
            column = batch.column(names.index(ids))
            sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            texts = _decoded(vocabulary(model), column.flatten().to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*names, text])

    return df.select(*[f"`{n}`" for n in names]).mapInArrow(run, schema)


def differing(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Rows whose ids differ from those of the sentencepiece library, which encodes each Arrow batch anew."""
    given = df.select(text, ids)

    def run(batches):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            expected = processor.encode([t or "" for t in batch.column(0).to_pylist()], num_threads=1)
            wrong = [i for i, (a, b) in enumerate(zip(batch.column(1).to_pylist(), expected)) if a != b]
            if wrong:
                yield batch.take(pa.array(wrong))

    return given.mapInArrow(run, given.schema)
