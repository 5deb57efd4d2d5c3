"""Personal data by base patterns and a skip-chain conditional random field (CRF).

Base: email, ip, card and phone patterns, leftmost and non-overlapping per kind; matches that fail their check (parts
of an address, Luhn sum, number of digits) are dropped without another try. Base spans always stay.

The CRF labels tokens (runs other than white space) with a kind or none. A token without a digit, @ or + is
clamped to none, so messages pass only among the others, the candidates, and the clamped ones enter as constants.
Potentials: the token's shape; neighbours in the text (a chain); and skip edges between tokens of one document
that are the same but for case and outer marks, or similar (the same seven digits or more, or the same part before
@). Each occurrence is linked to the next one, so a token repeated n times has n - 1 edges, and evidence for one
occurrence reaches all others. Inference is loopy sum-product with ROUNDS synchronous rounds: exact within that
many steps on chains; a document's labels do not depend on the documents beside it.

Weights are fitted by pseudo-likelihood (Newton steps with a ridge) to the base labels of at most about SAMPLE
documents, chosen by hash; Spark counts alike situations (shape, labels of neighbours and of skip neighbours), and
only these counts reach the driver. A kind that never occurs there is never added.

A candidate outside all base spans whose kind has a marginal of LEAST or more is added: phone tokens that stand
side by side as one span, others one by one, without outer marks. So a card number written twice in a row, which
no pattern takes, is found twice.

Offsets are code points, ends exclusive. A null or empty text has no spans; whole texts are read, in time linear in
their length. Repeated rows give repeated results; equal marginals go to the kind that is listed first; a null id
is like any other. Extra columns stay, except ``spans``; an empty table gives an empty table, and without any
labels the model adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.arrowtext import SPACED, appended, blocks, byte_class, code_point_starts, spans, text_bytes

KINDS = ("email", "ip", "card", "phone")
#: Documents whose base labels the weights are fitted to, about.
SAMPLE = 20_000
ROUNDS = 12
LEAST = 0.9
RIDGE = 0.1

_LOCAL = ~byte_class(*((ord(c), ord(c)) for c in "._%+-"), (48, 57), (65, 90), (97, 122))
_MAYBE = ~byte_class((48, 57), (ord("@"), ord("@")), (ord("+"), ord("+")))
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_OUTER = re.compile(rb"\A[\x00-\x2a\x2c-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]*(.*?)[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]*\Z", re.S)
_NOT_DIGIT = bytes(x for x in range(256) if not 48 <= x <= 57)


def luhn(digits: bytes) -> bool:
    total = sum(digits[-1::-2]) - 48 * len(digits[-1::-2])
    for d in digits[-2::-2]:
        total += (d - 48) * 2 - 9 * (d > 52)
    return total % 10 == 0


def _quad(raw: bytes) -> bool:
    return all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip(b"0") or b"0" for p in raw.split(b".")))


def base_spans(raw: bytes, other: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns in a text. ``other``: the places that no part before @ goes over."""
    found, free = [], 0
    at = raw.find(b"@")
    while at >= 0:
        k = int(np.searchsorted(other, at))
        begin = max(free, int(other[k - 1]) + 1 if k else 0)
        m = _DOMAIN.match(raw, at + 1) if begin < at else None
        if m:
            found.append((0, begin, m.end()))
            free = m.end()
        at = raw.find(b"@", at + 1)
    found += [(1, m.start(), m.end()) for m in _IP.finditer(raw) if _quad(m[0])]
    for m in _CARD.finditer(raw):
        digits = m[0].translate(None, _NOT_DIGIT)
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(raw) if 8 <= len(m[0].translate(None, _NOT_DIGIT)) <= 15]
    return found


#: What a token's shape can tell: a name and a test of (token, inner part, digits).
SHAPES = {
    "any": lambda t, c, d: True,
    "at": lambda t, c, d: b"@" in c,
    "address": lambda t, c, d: b"@" in c and _DOMAIN.search(c, c.index(b"@") + 1) is not None,
    "quad": lambda t, c, d: bool(_IP.fullmatch(c)) and _quad(c),
    "dots": lambda t, c, d: c.count(b".") >= 3 and len(c.translate(None, b"0123456789.")) == 0,
    "plus": lambda t, c, d: c.startswith(b"+") and 1 <= len(d) <= 3 and len(c) == len(d) + 1,
    "plus_long": lambda t, c, d: c.startswith(b"+") and 8 <= len(d) <= 15,
    "brackets": lambda t, c, d: t.startswith(b"(") and 2 <= len(d) <= 5 and len(c) == len(d),
    "hyphen": lambda t, c, d: b"-" in c and len(c.translate(None, b"0123456789-")) == 0,
    "digits": lambda t, c, d: len(c) == len(d),
    "letters": lambda t, c, d: len(c.translate(None, b"0123456789.+()-")) > 0,
    "luhn": lambda t, c, d: 16 <= len(d) <= 19 and len(c.translate(None, b"0123456789-")) == 0 and luhn(d),
    "0": lambda t, c, d: len(d) == 0,
    "1-2": lambda t, c, d: 1 <= len(d) <= 2,
    "3-5": lambda t, c, d: 3 <= len(d) <= 5,
    "6-7": lambda t, c, d: 6 <= len(d) <= 7,
    "8-15": lambda t, c, d: 8 <= len(d) <= 15,
    "16-19": lambda t, c, d: 16 <= len(d) <= 19,
    "20+": lambda t, c, d: len(d) >= 20,
}


@dataclass
class Graph:
    """The candidates of a block: text, word number, bytes of the inner part, shape as bits, base label, edges."""

    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    label: np.ndarray
    chain: np.ndarray  # pairs of candidates side by side
    skip: np.ndarray  # pairs of the same or similar candidates
    base: list[tuple[int, int, int, int]] = field(default_factory=list)  # text, kind, start, end in bytes


def _next_alike(text: np.ndarray, keys: list[bytes], some: np.ndarray) -> np.ndarray:
    """Pairs of each candidate in ``some`` with the next one of its text that has the same key."""
    names: dict[bytes, int] = {}
    number = np.array([names.setdefault(keys[i], len(names)) for i in some], np.int64)
    order = np.lexsort((some, number, text[some]))
    a, b = order[:-1], order[1:]
    alike = (number[a] == number[b]) & (text[some[a]] == text[some[b]]) if len(some) else np.zeros(0, bool)
    return np.stack((some[a[alike]], some[b[alike]]), axis=1) if len(some) else np.zeros((0, 2), np.int64)


def graph(column: pa.Array) -> tuple[Graph, np.ndarray, np.ndarray]:
    """The candidates of all texts, with the bytes and offsets of the texts."""
    data, offsets = text_bytes(column)
    starts, ends, first = spans(data, offsets, SPACED)
    marks = np.append(0, np.cumsum(_MAYBE[data]))
    word = np.flatnonzero(marks[ends] > marks[starts])
    text = np.searchsorted(first, word, "right") - 1
    raw, base = data.tobytes(), []
    for t in np.unique(text).tolist():
        a, b = int(offsets[t]), int(offsets[t + 1])
        base += [(t, kind, a + x, a + y) for kind, x, y in base_spans(raw[a:b], np.flatnonzero(~_LOCAL[data[a:b]]))]
    begin, end, shape, exact, similar = np.empty(len(word), np.int64), np.empty(len(word), np.int64), np.zeros(len(word), np.int64), [], []
    known: dict[bytes, tuple] = {}
    for k, (a, b) in enumerate(zip(starts[word].tolist(), ends[word].tolist())):
        token = raw[a:b]
        if token not in known:
            inner = _OUTER.match(token)
            core = inner[1] or token
            digits = core.translate(None, _NOT_DIGIT)
            bits = sum(1 << i for i, test in enumerate(SHAPES.values()) if test(token, core, digits))
            alike = core.lower().split(b"@")[0] if b"@" in core else digits if len(digits) >= 7 else b""
            known[token] = (inner.start(1) if inner[1] else 0, len(core), bits, core.lower(), alike)
        skip, size, shape[k], key, like = known[token]
        begin[k], end[k] = a + skip, a + skip + size
        exact.append(key)
        similar.append(like)
    label = np.zeros(len(word), np.int64)
    if base:
        for _, kind, a, b in sorted(base, key=lambda s: -s[1]):  # of two kinds the one listed first
            label[np.searchsorted(end, a, "right") : np.searchsorted(begin, b, "left")] = kind + 1
    beside = np.flatnonzero((np.diff(word) == 1) & (text[1:] == text[:-1])) if len(word) else word
    pairs = np.concatenate((_next_alike(text, exact, np.arange(len(word))), _next_alike(text, similar, np.flatnonzero([bool(s) for s in similar]))))
    skips = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    return Graph(text, begin, end, shape, label, np.stack((beside, beside + 1), axis=1), skips, base), data, offsets


@dataclass
class Model:
    """Log potentials: shape by label, label by next label, label by skip label (symmetric)."""

    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


N = len(KINDS) + 1


def situations(column: pa.Array) -> dict[tuple, int]:
    """How often each (shape, label before, label behind, numbers of skip labels, label) occurs; none is label 0."""
    g, _, _ = graph(column)
    before, behind = np.zeros(len(g.label), np.int64), np.zeros(len(g.label), np.int64)
    before[g.chain[:, 1]], behind[g.chain[:, 0]] = g.label[g.chain[:, 0]], g.label[g.chain[:, 1]]
    near = np.zeros((len(g.label), N), np.int64)
    np.add.at(near, (g.skip[:, 0], g.label[g.skip[:, 1]]), 1)
    np.add.at(near, (g.skip[:, 1], g.label[g.skip[:, 0]]), 1)
    rows = np.column_stack((g.shape, before, behind, near, g.label))
    distinct, counts = np.unique(rows, axis=0, return_counts=True) if len(rows) else (rows, [])
    return {tuple(int(x) for x in row): int(n) for row, n in zip(distinct, counts)}


def fit_weights(rows: np.ndarray, counts: np.ndarray, ridge: float = RIDGE, rounds: int = 40) -> Model:
    """The weights of the largest penalised pseudo-likelihood of ``rows`` (as ``situations`` gives them)."""
    shapes = len(SHAPES)
    size = shapes * N + N * N + N * (N + 1) // 2
    upper = {pair: k for k, pair in enumerate(zip(*np.triu_indices(N)))}
    feature = np.zeros((len(rows), N, size))
    for r, row in enumerate(rows.tolist()):
        bits = [i for i in range(shapes) if row[0] >> i & 1]
        for y in range(N):
            feature[r, y, [i * N + y for i in bits]] = 1
            feature[r, y, shapes * N + row[1] * N + y] += 1
            feature[r, y, shapes * N + y * N + row[2]] += 1
            for z in range(N):
                feature[r, y, shapes * N + N * N + upper[min(y, z), max(y, z)]] += row[3 + z]
    own = feature[np.arange(len(rows)), rows[:, -1]] if len(rows) else np.zeros((0, size))
    w = np.zeros(size)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        score = feature @ w
        top = score.max(axis=1, initial=-1e300)
        p = np.exp(score - top[:, None])
        total = p.sum(axis=1)
        return float((counts * (np.log(total) + top - own @ w)).sum() + ridge / 2 * (w @ w)), p / total[:, None]

    value, p = loss(w)
    for _ in range(rounds):
        mean = np.einsum("ry,ryk->rk", p, feature)
        gradient = ((mean - own) * counts[:, None]).sum(axis=0) + ridge * w
        hessian = np.einsum("ry,ryk,ryl->kl", p * counts[:, None], feature, feature, optimize=True) - (mean * counts[:, None]).T @ mean
        step = np.linalg.solve(hessian + ridge * np.eye(size), gradient)
        scale = 1.0
        while scale > 1e-6 and loss(w - scale * step)[0] > value - 1e-4 * scale * (gradient @ step):
            scale /= 2
        w = w - scale * step
        value, p = loss(w)
        if np.abs(scale * step).max() < 1e-6:
            break
    skip = np.zeros((N, N))
    for (y, z), k in upper.items():
        skip[y, z] = skip[z, y] = w[shapes * N + N * N + k]
    return Model(w[: shapes * N].reshape(shapes, N), w[shapes * N : shapes * N + N * N].reshape(N, N), skip)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Weights from the base labels of about ``sample`` documents with the smallest hashes."""
    share = sample / max(docs.count(), 1)
    chosen = docs.select(F.col(text).alias("text")).where(F.pmod(F.xxhash64(key, text), F.lit(1 << 31)) < F.lit(min(share, 1.0) * (1 << 31)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = situations(block.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in found], pa.list_(pa.int64())), pa.array(list(found.values()), pa.int64())], names=["row", "n"])

    rows = chosen.mapInArrow(run, "row array<long>, n long").groupBy("row").agg(F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: r["row"])
    width = N + 4
    return fit_weights(np.array([r["row"] for r in rows], np.int64).reshape(len(rows), width), np.array([r["n"] for r in rows], np.float64))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def marginals(g: Graph, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Probability of every label of every candidate, by loopy messages along chain and skip edges."""
    bits = (g.shape[:, None] >> np.arange(len(SHAPES))) & 1
    own = bits @ model.shape
    alone = np.ones((len(own), 2), bool)  # clamped neighbours and the ends of the text count as none
    alone[g.chain[:, 1], 0] = alone[g.chain[:, 0], 1] = False
    own = own + alone[:, :1] * model.chain[0] + alone[:, 1:] * model.chain[:, 0]
    edges = np.concatenate((g.chain, g.skip))
    source = np.concatenate((edges[:, 0], edges[:, 1]))
    target = np.concatenate((edges[:, 1], edges[:, 0]))
    back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
    weight = np.concatenate([np.broadcast_to(m, (k, N, N)) for m, k in ((model.chain, len(g.chain)), (model.skip, len(g.skip)), (model.chain.T, len(g.chain)), (model.skip.T, len(g.skip)))])
    message = np.zeros((len(source), N))
    belief = own
    for _ in range(rounds if len(source) else 0):
        new = _log_sum((belief[source] - message[back])[:, :, None] + weight, axis=1)
        message = (message + new - new.max(axis=1, keepdims=True)) / 2
        message -= message.max(axis=1, keepdims=True)
        belief = own.copy()
        np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(axis=1, keepdims=True)) if len(belief) else belief
    return p / p.sum(axis=1, keepdims=True)


def added_spans(g: Graph, model: Model, raw: bytes, least: float = LEAST) -> list[tuple[int, int, int, int]]:
    """(text, kind, start, end) in bytes of what the model finds outside the base spans."""
    if not len(g.label):
        return []
    p = marginals(g, model)
    kind = p.argmax(axis=1)
    sure = (kind > 0) & (p[np.arange(len(p)), kind] >= least)
    if g.base:
        a, b = np.array([s[2:] for s in g.base]).T
        order = np.argsort(a)
        reach = np.maximum.accumulate(b[order])
        k = np.searchsorted(a[order], g.end) - 1  # the last base span that begins before the token's end
        sure &= ~((k >= 0) & (reach[np.maximum(k, 0)] > g.begin))
    side = np.zeros(len(g.label), bool)
    side[g.chain[:, 1]] = True
    out: list[tuple[int, int, int, int]] = []
    phone, last = KINDS.index("phone"), -2
    for i in np.flatnonzero(sure).tolist():
        k = int(kind[i]) - 1
        if k == phone and last == i - 1 and side[i] and out[-1][1] == phone:
            out[-1] = (*out[-1][:3], int(g.end[i]))
        else:
            out.append((int(g.text[i]), k, int(g.begin[i]), int(g.end[i])))
        last = i
    return out


SPAN = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False), T.StructField("base", T.BooleanType(), False)])


def tagged(docs: DataFrame, model: Model, text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with ``spans``: kind, start and end (code points) and whether it is a base span, by kind as listed,
    then start."""

    def make(column: pa.Array) -> list[pa.Array]:
        g, data, offsets = graph(column)
        raw = data.tobytes()
        rows = sorted([(t, k, a, b, True) for t, k, a, b in g.base] + [(t, k, a, b, False) for t, k, a, b in added_spans(g, model, raw, least)])
        point = np.append(0, np.cumsum(code_point_starts(data)))
        t, k, a, b = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        zero = point[offsets[t]]
        values = [pa.array(np.array(KINDS, object)[k], pa.string()), pa.array(point[a] - zero), pa.array(point[b] - zero), pa.array([r[4] for r in rows], pa.bool_())]
        ends = np.append(0, np.cumsum(np.bincount(t, minlength=len(column)))).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(values, names=SPAN.names))]

    return appended(docs, text, [T.StructField("spans", T.ArrayType(SPAN, False), False)], make)
