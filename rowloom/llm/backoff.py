"""Language-model scores by a weighted backoff automaton.

The model is an n-gram distribution of a given order, each smoothed towards the next shorter one (Dirichlet prior
of strength m): P(w | h) = (c(h, w) + m * P(w | h')) / (c(h) + m), where h' is h without its first word, down to
P(w) = (c(w) + 1/2) / (N + (V + 1) / 2). As an automaton: every context of up to order - 1 words that training has
seen is a state, the empty one the root; an n-gram seen in training is an arc of its context's state; every other
state has a failure arc to the state of the shorter context, of weight m / (c(h) + m). The root has an arc for every
word, and for unknown ones. A text is read from left to right, once: the state is carried from word to word, its
arcs are tried first, then failure arcs are followed until an arc is found, and the arc leads to the longest
context that the read words end in.

The automaton of a large corpus fits no task, so each task gets the part that its texts can reach:

1. Texts are cut into chunks of about CHUNK_BYTES (written, so that chunks stay what they are).
2. Every chunk sends the hashes of its distinct n-grams with their training counts, packed and sorted, to buckets
   of the hash range; buckets add the counts up (64 bits) and answer each chunk in its own order. Buckets are as
   many as the corpus needs, and a frequent word is one entry per chunk, so none is hot.
3. Every chunk meets the answers, builds its automaton and traverses its texts, many at a time.

N and V come back to the driver as one row; nothing is capped or pruned. The strength m is the one among
STRENGTHS with the largest leave-one-out likelihood of all training texts; scores for every strength are taken
from the same traversal.

A null text counts as empty and has one token, the end. Words are runs other than white space, with A to Z
lower-cased; they go by hashes, n-grams by a mixture of hashes, 64 bits each. Repeated rows are repeated texts (and
count as often in training); an id may be null (then its ``train`` flag decides as given). Without training texts
every count is zero. Of strengths with equal likelihood the larger one is taken. Long texts are read in segments
whose first state is found from the words before. Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.arrowtext import LOWER, SPACED, blocks, mixed, span_hashes, spans, text_bytes
from rowloom.session import scratch_path, stored

CHUNK_BYTES = 8 << 20
#: Entries that meet in one bucket, about.
BUCKET_ENTRIES = 1 << 21
STRENGTHS = (3.0, 30.0, 300.0, 3e3, 1e6)
#: Words per n-gram, unless another order is asked for.
ORDER = 3
#: Words of a text that are read one after the other; the segments of all texts are read side by side.
SEGMENT = 1024
#: Words of more bytes are hashed one by one.
LONG = 64

_END, _BEGIN = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0xB0E0B0E0B0E0B0E1)
_CHUNK = "chunk long, n_tokens long, ids array<long>, train array<boolean>, texts array<string>"
_REQUEST = "kind int, bucket int, chunk long, keys binary, counts binary"
_ANSWER = "kind int, bucket int, chunk long, counts binary, total long, distinct long"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, scores array<double>, left_out array<double>"


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, equal places together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, train, text) to rows of many documents, at most CHUNK_BYTES of text or a single text each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = number = 0
        partition = TaskContext.get().partitionId()

        def row() -> pa.RecordBatch:
            nonlocal number
            number += 1
            table = pa.Table.from_batches(held).combine_chunks()
            data, offsets = text_bytes(table.column("text"))
            tokens = len(spans(data, offsets, SPACED)[0]) + table.num_rows
            lists = [pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), table.column(c).chunk(0)) for c in ("doc_id", "train", "text")]
            return pa.RecordBatch.from_arrays([pa.array([(partition << 32) | number]), pa.array([tokens]), *lists], names=["chunk", "n_tokens", "ids", "train", "texts"])

        for block in blocks(batches):
            more = pc.sum(pc.binary_length(block.column("text"))).as_py() or 0
            if held and size + more > CHUNK_BYTES:
                yield row()
                held, size = [], 0
            held.append(block)
            size += more
        if held:
            yield row()

    return docs.select("doc_id", F.coalesce("train", F.lit(False)).alias("train"), "text").mapInArrow(run, _CHUNK)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: a mixed polynomial, and XXH3 for words of over LONG bytes, where polynomials modulo a
    power of two have known clashes."""
    out = span_hashes(data, starts, ends)
    long = np.flatnonzero(ends - starts > LONG)
    if len(long):
        raw = data.tobytes()
        out[long] = [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(starts[long].tolist(), ends[long].tolist())]
    return out


class Chunk:
    """The tokens of a chunk and their n-grams as indexes into sorted distinct keys.

    Level k - 1 has the k-grams that end at each token: ``keys``, ``gram`` (-1 where the text has fewer tokens up to
    there) and ``counts`` in the chunk's training texts. Level 0 holds the end and begin marks too; the begin mark
    stands before the first word of a text.
    """

    def __init__(self, texts: pa.Array, train: np.ndarray, order: int = ORDER, places: bool = True):
        data, offsets = text_bytes(texts)
        data = LOWER[data]
        starts, ends, bounds = spans(data, offsets, SPACED)
        n = np.diff(bounds)
        self.order = order
        self.first = bounds[:-1] + np.arange(len(n))
        self.size = n + 1
        total = len(starts) + len(n)
        token = np.empty(total, np.uint64)
        last = self.first + n
        inner = np.ones(total, bool)
        inner[last] = False
        hashes = np.empty(len(starts), np.uint64)
        low = 0
        while low < len(n):  # some megabytes at once
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + (2 << 20), "right")) - 1)
            a, b = bounds[low], bounds[high]
            hashes[a:b] = word_hashes(data[offsets[low] : offsets[high]], starts[a:b] - offsets[low], ends[a:b] - offsets[low])
            low = high
        token[inner], token[last] = hashes, _END
        text = np.repeat(np.arange(len(n)), n + 1)
        self.counted = train[text]
        self.place = np.arange(total) - self.first[text]
        self.keys, self.counts = [], []
        if places:
            self.gram = []
        before = np.empty_like(token)  # key of the context of each token
        for k in range(1, order + 1):
            some = np.flatnonzero(self.place >= k - 2) if k > 2 else np.arange(total)
            key = token if k == 1 else np.zeros(total, np.uint64)
            if k > 1:
                key[some] = mixed(mixed(before[some]) + token[some])
            own = np.append(key, _BEGIN) if k == 1 else key[some]
            distinct, found = np.unique(own, return_inverse=True) if places else (_distinct(own), None)
            counted = np.sort(key[some][self.counted[some]])
            counts = np.zeros(len(distinct), np.uint64)
            ends = np.flatnonzero(np.append(counted[1:] != counted[:-1], True)[: len(counted)])
            counts[np.searchsorted(distinct, counted[ends])] = np.diff(ends, prepend=-1)
            self.keys.append(distinct)
            self.counts.append(counts)
            if places:
                gram = np.full(total, -1, np.int64)
                gram[some] = found[: len(some)]
                self.gram.append(gram)
            before = np.empty_like(token)
            before[1:] = key[:-1]
            if k == 1:
                before[self.first] = _BEGIN
        self.begin = int(np.searchsorted(self.keys[0], _BEGIN))
        self.counts[0][self.begin] = int(train.sum())
        if places:
            self.word = self.gram[0]

    def context(self, k: int) -> np.ndarray:
        """Index of the k words before each token at level k - 1; -1 where the text has fewer."""
        out = np.full(len(self.word), -1, np.int64)
        out[1:] = self.gram[k - 1][:-1]
        out[self.first] = self.begin if k == 1 else -1
        return out


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]


def _chunk(texts: pa.Array, train: pa.Array, order: int, places: bool = True) -> Chunk:
    return Chunk(texts, train.to_numpy(zero_copy_only=False).astype(bool), order, places)


def _cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of the hash range begins in sorted keys, with the end last."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def requests(chunked: DataFrame, bits: int, order: int = ORDER) -> DataFrame:
    """The distinct k-grams (kind k) of every chunk, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _chunk(batch.column("texts")[i].values, batch.column("train")[i].values, order, places=False)
                for kind, (keys, counts) in enumerate(zip(chunk.keys, chunk.counts), 1):
                    cut = _cuts(keys, bits)
                    rows = [(b, packed(np.diff(keys[x:y], prepend=np.uint64(0))), packed(counts[x:y])) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
                    if not rows:
                        continue
                    number, key, count = zip(*rows)
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * n, pa.int32()), pa.array(number, pa.int32()), pa.array([batch.column("chunk")[i].as_py()] * n, pa.int64()), pa.array(key, pa.binary()), pa.array(count, pa.binary())],
                        names=["kind", "bucket", "chunk", "keys", "counts"],
                    )

    return chunked.select("chunk", "train", "texts").mapInArrow(run, _REQUEST)


def _answer(table: pa.Table) -> pa.Table:
    """Add up one bucket's counts and give each chunk the sums in the order it asked."""
    keys = [np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64) for raw in table.column("keys").to_pylist()]
    counts = [unpacked(raw, np.uint64) for raw in table.column("counts").to_pylist()]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, place, np.concatenate(counts))
    ends = np.cumsum([len(k) for k in keys])
    own = distinct != _BEGIN
    kind = table.column("kind")[0].as_py()
    sums, seen = [0] * len(keys), [0] * len(keys)
    if kind == 1:  # the bucket's share of N and V
        sums[0], seen[0] = int(total[own].sum(dtype=np.int64)), int((total[own] > 0).sum())
    answers = [packed(total[place[e - len(k) : e]]) for k, e in zip(keys, ends)]
    return pa.table({"kind": table.column("kind"), "bucket": table.column("bucket"), "chunk": table.column("chunk"), "counts": pa.array(answers, pa.binary()), "total": pa.array(sums, pa.int64()), "distinct": pa.array(seen, pa.int64())})


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log(x) * (1 / np.log(10))


class Automaton:
    """States, arcs and failure arcs for the texts of a chunk.

    State 0 is the root; the k-gram g of level k - 1 is state ``offset[k] + g`` if training has seen it. Arcs are
    sorted by state and word.
    """

    def __init__(self, chunk: Chunk, counts: list[np.ndarray], total: int, distinct: int):
        self.chunk, self.order = chunk, chunk.order
        self.counts = [c.astype(np.float64) for c in counts]
        self.total, self.space = float(total), distinct + 1.0
        sizes = [len(k) for k in chunk.keys]
        self.offset = [0, *(1 + np.cumsum([0, *sizes[: self.order - 2]])).tolist()] if self.order > 1 else [0]
        states = 1 + sum(sizes[: self.order - 1])
        self.failure = np.zeros(states, np.int64)
        self.seen_after = np.zeros(states)  # c(h) of each state
        self.seen_after[0] = self.total
        # One place where each k-gram stands tells its context, its last word and its shorter end.
        self.at = []
        for g, size in zip(chunk.gram, sizes):
            at = np.zeros(size, np.int64)
            some = np.flatnonzero(g >= 0)
            at[g[some]] = some
            self.at.append(at)
        for k in range(1, self.order):
            own = slice(self.offset[k], self.offset[k] + sizes[k - 1])
            self.seen_after[own] = self.counts[k - 1]
            if k > 1:
                self.failure[own] = self.offset[k - 1] + chunk.gram[k - 2][self.at[k - 1]]
        width = sizes[0]
        codes, target, self.arc_gram = [], [], []
        for k in range(1, self.order + 1):
            gram = np.arange(sizes[k - 1]) if k == 1 else np.flatnonzero(self.counts[k - 1] > 0)
            at = self.at[k - 1][gram]
            source = np.zeros(len(gram), np.int64) if k == 1 else self.offset[k - 1] + chunk.context(k - 1)[at]
            word = gram if k == 1 else chunk.word[at]
            codes.append(source * width + word)
            reached = min(k, self.order - 1)  # words of the context that the read words end in
            end = np.zeros(len(gram), np.int64)
            if reached:
                end = gram if reached == k else chunk.gram[reached - 1][at]
                end = np.where(self.counts[reached - 1][end] > 0, self.offset[reached] + end, 0)
            target.append(end)
            self.arc_gram.append(gram)
        self.arc_level = np.repeat(np.arange(self.order), [len(c) for c in codes])
        order = np.argsort(np.concatenate(codes))
        self.codes, self.target, self.width = np.concatenate(codes)[order], np.concatenate(target)[order], width
        self.sorted = order

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arc that each state takes for its word, and how many failure arcs come first."""
        state, fails = state.copy(), np.zeros(len(state), np.int8)
        arc = np.searchsorted(self.codes, state * self.width + word)
        while True:
            lost = np.flatnonzero(self.codes[np.minimum(arc, len(self.codes) - 1)] != state * self.width + word)
            if not len(lost):
                return arc, fails
            state[lost] = self.failure[state[lost]]
            fails[lost] += 1
            arc[lost] = np.searchsorted(self.codes, state[lost] * self.width + word[lost])

    def traverse(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every token the state in which it is read, its arc, and the number of failure arcs before that."""
        chunk, n = self.chunk, len(self.chunk.word)
        pieces_ = -(-chunk.size // SEGMENT)
        text = np.repeat(np.arange(len(pieces_)), pieces_)
        begin = chunk.first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(pieces_) - pieces_, pieces_)) * SEGMENT
        end = np.minimum(begin + SEGMENT, chunk.first[text] + chunk.size[text])
        # The first state: that of the begin mark, or what the last order - 1 words lead to.
        state = np.zeros(len(text), np.int64)
        if self.order > 1:
            opening = begin == chunk.first[text]
            state[opening] = self.offset[1] + chunk.begin if self.counts[0][chunk.begin] > 0 else 0
            later = np.flatnonzero(~opening)
            for back in range(self.order - 1, 0, -1):
                arc, _ = self.step(state[later], chunk.word[begin[later] - back])
                state[later] = self.target[arc]
        order = np.argsort(begin - end, kind="stable")  # the longest first
        begin, state, length = begin[order], state[order], (end - begin)[order]
        read, arcs, fails = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int8)
        going = len(begin)
        for t in range(int(length.max(initial=0))):
            while length[going - 1] <= t:
                going -= 1
            at = begin[:going] + t
            read[at] = state[:going]
            arcs[at], fails[at] = self.step(state[:going], chunk.word[at])
            state[:going] = self.target[arcs[at]]
        return read, arcs, fails

    @cached_property
    def of_grams(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For the levels from pairs on: the count of each gram's context, and its shorter end."""
        out = []
        for k in range(2, self.order + 1):
            at = self.at[k - 1]
            out.append((self.counts[k - 2][self.chunk.context(k - 1)[at]], self.chunk.gram[k - 2][at]))
        return out

    def weights(self, strength: float) -> tuple[np.ndarray, np.ndarray]:
        """log10 of all arcs, in their order, and of all failure arcs."""
        chance = [(self.counts[0] + 0.5) / (self.total + 0.5 * self.space)]
        for count, (context, end) in zip(self.counts[1:], self.of_grams):
            chance.append((count + strength * chance[-1][end]) / (context + strength))
        arcs = _log10(np.concatenate([c[g] for c, g in zip(chance, self.arc_gram)]))[self.sorted]
        return arcs, _log10(strength / (self.seen_after + strength))

    def scores(self, path: tuple[np.ndarray, np.ndarray, np.ndarray], strength: float) -> np.ndarray:
        """log10 of the probability of every token along its path."""
        state, arc, fails = path
        arcs, failures = self.weights(strength)
        out = arcs[arc]
        for done in range(self.order - 1):
            some = np.flatnonzero(fails > done)
            out[some] += failures[state[some]]
            if done + 2 < self.order:
                state = self.failure[state]
        return out

    @cached_property
    def of_tokens(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For the levels from pairs on: the tokens that have a gram, its count and its context's, less one each."""
        out = []
        for k in range(2, self.order + 1):
            some = np.flatnonzero(self.chunk.gram[k - 1] >= 0)
            less = lambda counts, grams: np.maximum(counts[grams[some]] - 1, 0)
            out.append((some, less(self.counts[k - 1], self.chunk.gram[k - 1]), less(self.counts[k - 2], self.chunk.context(k - 1))))
        return out

    def left_out(self, strength: float) -> np.ndarray:
        """log10 of the probability of every training token when its own occurrence is taken out of all counts."""
        p = np.maximum(self.counts[0][self.chunk.word] - 0.5, 0.5) / (max(self.total - 1, 0) + 0.5 * self.space)
        for some, seen, context in self.of_tokens:
            p[some] = (seen + strength * p[some]) / (context + strength)
        return _log10(p)


def _scores(ids: pa.Array, train: pa.Array, texts: pa.Array, answers: pa.Table, total: int, distinct: int, order: int) -> pa.Table:
    chunk = _chunk(texts, train, order)
    turn = np.lexsort((answers.column("bucket").to_numpy(), answers.column("kind").to_numpy()))
    kinds = answers.column("kind").to_numpy()[turn]
    parts = [unpacked(answers.column("counts")[int(i)].as_py(), np.uint64) for i in turn]
    counts = [np.concatenate([np.zeros(0, np.uint64), *(p for p, own in zip(parts, kinds) if own == k)]) for k in range(1, order + 1)]
    if any(len(c) != len(k) for c, k in zip(counts, chunk.keys)):
        raise ValueError("the answers do not fit the chunk")
    model = Automaton(chunk, counts, total, distinct)
    path = model.traverse()
    first, own = chunk.first, train.to_numpy(zero_copy_only=False).astype(bool)
    sums, left_out = [], []
    for strength in STRENGTHS:
        sums.append(np.add.reduceat(model.scores(path, strength), first))
        left_out.append(np.where(own, np.add.reduceat(model.left_out(strength), first), 0.0))
    root = _log10((model.counts[0] + 0.5) / (model.total + 0.5 * model.space))
    wide = pa.list_(pa.float64())
    shape = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * len(STRENGTHS)), pa.array(np.column_stack(x).ravel())).cast(wide)
    return pa.table(
        {
            "doc_id": ids,
            "held_out": pa.array(~own),
            "n_tokens": pa.array(chunk.size.astype(np.int64)),
            "n_known": pa.array(np.add.reduceat((counts[0] > 0)[chunk.word].astype(np.int64), first)),
            "base_score": pa.array(np.add.reduceat(root[chunk.word], first)),
            "scores": shape(sums),
            "left_out": shape(left_out),
        }
    )


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Scores by n-grams of up to ``order`` words. (doc_id, train, text) to (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, strength)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "chunks")
    chunks(docs).write.option("compression", "zstd").parquet(path)
    chunked = spark.read.schema(_CHUNK).parquet(path)
    tokens, number = chunked.agg(F.sum("n_tokens"), F.count("*")).first()
    if not tokens:
        return spark.createDataFrame([], "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, strength double")
    bits = max(0, int(tokens - 1).bit_length() - BUCKET_ENTRIES.bit_length() + 1)
    answers = stored(requests(chunked, bits, order).groupBy("kind", "bucket").applyInArrow(_answer, _ANSWER), "answers")
    total, distinct = answers.agg(F.sum("total"), F.sum("distinct")).first()

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        rows = [_scores(texts.column("ids")[i].values, texts.column("train")[i].values, texts.column("texts")[i].values, found, total, distinct, order) for i in range(texts.num_rows)]
        return pa.concat_tables(rows)

    # As many tasks as the chunks need, whatever the session's setting.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-number // 4))
    sides = [t.repartition(tasks, "chunk").groupBy("chunk") for t in (chunked.select("chunk", "ids", "train", "texts"), answers.select("chunk", "kind", "bucket", "counts"))]
    both = sides[0].cogroup(sides[1])
    result = stored(both.applyInArrow(score, _SCORES), "scores")
    likelihood = result.agg(*[F.sum(F.col("left_out")[i]) for i in range(len(STRENGTHS))]).first()
    best = max(range(len(STRENGTHS)), key=lambda i: (likelihood[i] or 0.0, i))
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", F.col("scores")[best].alias("score"), F.lit(STRENGTHS[best]).alias("strength"))
